"""Point-in-time lookup of a versioned dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.operators.hotkeys import MAX_ROWS, SEGMENT, attach, carry, segment_by_rank
from tidelake.operators.scd2 import END, START


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    moment: str,
    attributes: Sequence[str],
    open_first: bool = True,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Left join each fact to the version of ``key`` valid at ``moment``.

    Facts and versions go into one timeline per key, on which every fact takes over the last version before it; the
    versions of a key must not overlap, as those of a history do not. No row is repeated, however long a version is
    valid, and each moves once. Timelines above ``max_rows`` rows are cut into segments, and one row for each segment carries
    the last version on.

    Ingestion stamps usually start after the facts do. ``open_first`` therefore lets a key's first
    version reach back without limit; it is taken from the timeline too. What facts hold of key and moment moves once,
    as the timeline's own columns.
    """
    held = F.struct(F.col(START).alias("start"), F.col(END).alias("end"), *[F.col(a).alias(f"a{i}") for i, a in enumerate(attributes)])
    homes = {
        name: F.col(own) for name, own, other in ((key, "__key", key), (moment, "__at", START))
        if facts.schema[name].dataType == versions.schema[other].dataType
    }
    carried = [c for c in facts.columns if c not in homes]
    fact = F.struct(*carried) if carried else F.struct(F.lit(True).alias("__present"))
    kinds = {"__fact": facts.select(fact).schema[0].dataType, "__version": versions.select(held).schema[0].dataType}
    # a version counts from its very start: at equal times it goes first
    dated = versions.select(
        F.col(key).alias("__key"), F.col(START).alias("__at"), F.lit(0).alias("__kind"),
        held.alias("__version"), F.lit(None).cast(kinds["__fact"]).alias("__fact"),
    )
    stamped = facts.select(
        F.col(key).alias("__key"), F.col(moment).alias("__at"), F.lit(1).alias("__kind"),
        F.lit(None).cast(kinds["__version"]).alias("__version"), fact.alias("__fact"),
    ).withColumn("__row", F.monotonically_increasing_id())
    line = dated.withColumn("__row", F.lit(-1).cast("bigint")).unionByName(stamped)
    line = segment_by_rank(line, ["__key"], ["__at", "__kind", "__row"], max_rows)
    until = W.partitionBy("__key", SEGMENT).orderBy("__at", "__kind", "__row").rowsBetween(W.unboundedPreceding, 0)
    dated_version = F.when(F.col("__at").isNotNull(), F.col("__version"))
    # both frames are one window over rows that moved once
    line = line.withColumns({
        "__last": F.last("__version", ignorenulls=True).over(until),
        "__opening": F.first(dated_version, ignorenulls=True).over(until.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
    })
    newest = F.max_by("__version", F.when(F.col("__kind") == 0, F.struct("__at", "__row")))
    line = carry(line, ["__key"], newest, "__earlier", fill=True)
    current = F.coalesce("__last", "__earlier")
    found = line.filter("__kind = 1")
    if open_first:
        # a segment does not hold all versions of its key
        heavy = line.filter(F.col(SEGMENT).isNotNull() & (F.col("__kind") == 0))
        first = heavy.groupBy("__key").agg(F.min_by("__version", "__at").alias("__first"))
        found = attach(found, first, ["__key"])
        current = F.coalesce(current, F.when(F.col(SEGMENT).isNull(), F.col("__opening")), "__first")
    found = found.withColumn("__found", current)
    # the first version reaches back, so a start after the moment is no objection; an end before it always is
    ended = F.col("__found.end").isNotNull() & (F.col("__at") >= F.col("__found.end"))
    valid = F.col("__key").isNotNull() & F.col("__at").isNotNull() & ~ended
    return found.select(
        *[homes.get(c, F.col(f"__fact.{c}")).alias(c) for c in facts.columns],
        *[F.when(valid, F.col(f"__found.a{i}")).alias(a) for i, a in enumerate(attributes)],
        F.when(valid, F.col("__found.start")).alias("version_start"),
    )
