"""Slowly changing dimension history, type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.contracts import UNTRACKED_COLUMNS
from tidelake.operators.hotkeys import MAX_ROWS, SEGMENT, carry, segment_by_rank

START, END = "__START_AT", "__END_AT"


def history(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    exclude: Sequence[str] = UNTRACKED_COLUMNS,
    track: Sequence[str] | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per key version from an append-only change log.

    A version opens when the tracked columns differ from the row before it in ``sequence`` order
    and ends where the next version of the key starts; ``__END_AT`` is NULL on the current one.
    Arrival order does not matter and repeated deliveries open no version. Several different rows
    with one sequence value are ordered by their content.

    By default every column but the keys, the sequence and ``exclude`` is tracked. The sequence
    column is carried along; name it in ``track`` to open a version on every delivery.

    Keys are counted when this is called, as those above ``max_rows`` rows are cut into segments.
    """
    carried = [c for c in log.columns if c not in exclude]
    tracked = list(track) if track is not None else [
        c for c in carried if c not in keys and c != sequence
    ]
    others = [c for c in carried if c not in keys and c not in tracked and c != sequence]

    rows = log.select(*carried, F.struct(*tracked).alias("__content"))
    rows = segment_by_rank(rows, keys, [sequence, "__content", *others], max_rows)
    within = W.partitionBy(*keys, SEGMENT).orderBy(sequence, "__content", *others)

    rows = rows.withColumn("__before", F.lag("__content").over(within))
    latest = F.max(F.struct(F.col(sequence), F.col("__content")))
    rows = carry(rows, keys, latest, "__earlier")
    before = F.coalesce("__before", F.col("__earlier.__content"))
    opened = rows.filter(before.isNull() | ~before.eqNullSafe(F.col("__content")))
    opened = opened.drop("__before", "__earlier")

    opened = opened.withColumn("__next", F.lead(sequence).over(within))
    opened = carry(opened, keys, F.min(sequence), "__later", backwards=True)
    return opened.select(
        *carried,
        F.col(sequence).alias(START),
        F.coalesce("__next", "__later").alias(END),
    )


def current(versions: DataFrame) -> DataFrame:
    """Open versions only."""
    return versions.filter(F.col(END).isNull())


def changed_keys(versions: DataFrame, key: str) -> DataFrame:
    """All versions of the keys that have more than one."""
    repeated = versions.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key)
    return versions.join(repeated, key, "left_semi")


def sequence_ties(log: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Keys whose log holds differing rows under one sequence value."""
    content = F.struct(*[c for c in log.columns if c not in (*keys, *UNTRACKED_COLUMNS)])
    distinct = log.select(*keys, sequence, content.alias("content")).distinct()
    return distinct.groupBy(*keys, sequence).agg(F.count("*").alias("variants")).filter(
        "variants > 1"
    )
