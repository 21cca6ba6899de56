"""Referential, grain and control-total checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name of one or more frames."""
    if not frames:
        raise ValueError("nothing to combine")
    return reduce(lambda a, b: a.unionByName(b), frames)


class Relation(NamedTuple):
    """Keys of ``fact`` that should be found in ``dimension``."""

    name: str
    fact: str
    key: str
    dimension: str
    dimension_key: str


def orphan_report(relations: Sequence[Relation], read: Callable[[str], DataFrame]) -> DataFrame:
    """How many fact rows and distinct keys have no partner, for each relation; NULL keys are counted apart.

    Every table is read once: a fact row becomes one key for each of its relations, a dimension row one for each of
    its key columns, and a single anti join settles them all. Keys are counted before they move, so a hot key
    costs one row for each map task. (A Bloom filter of the dimension would not help: it settles misses, and nearly all keys hit.)
    """
    by_fact: dict[str, list[Relation]] = {}
    columns: dict[str, dict[str, None]] = {}
    for relation in relations:
        by_fact.setdefault(relation.fact, []).append(relation)
        columns.setdefault(relation.dimension, {})[relation.dimension_key] = None

    def named(*values: Column) -> Column:
        return F.struct(*[v.alias(n) for v, n in zip(values, ("relation", "dimension", "key"))])

    sought = [
        read(fact).select(F.inline(F.array(*[
            named(F.lit(r.name), F.lit(f"{r.dimension}.{r.dimension_key}"), F.col(r.key).cast("string")) for r in own
        ])))
        for fact, own in by_fact.items()
    ]
    held = [
        read(dimension).select(F.inline(F.array(*[
            F.struct(F.lit(f"{dimension}.{key}").alias("dimension"), F.col(key).cast("string").alias("key")) for key in keys
        ])))
        for dimension, keys in columns.items()
    ]
    keyed = union_all(sought).groupBy("relation", "dimension", "key").agg(F.count("*").alias("rows"))
    missing = keyed.join(union_all(held), ["dimension", "key"], "left_anti").select("relation", "key", "rows")
    spark = keyed.sparkSession
    every = spark.createDataFrame([(r.name, None, 0) for r in relations], "relation string, key string, rows bigint")
    known = F.col("key").isNotNull()
    return missing.unionByName(every).groupBy("relation").agg(
        F.coalesce(F.sum(F.when(known, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(known).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("null_key_rows"),
    )


def orphan_keys(
    fact: DataFrame, dimension: DataFrame, key: str, relation: str, dimension_key: str | None = None
) -> DataFrame:
    """``orphan_report`` of a single relation between two frames."""
    frames = {"fact": fact, "dimension": dimension}
    return orphan_report([Relation(relation, "fact", key, "dimension", dimension_key or key)], frames.__getitem__)


def grain_report(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, keys that repeat, and rows with a NULL key part."""
    keyed = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return keyed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("rows") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("rows"))), F.lit(0)).alias("null_key_rows"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def reconcile(totals: DataFrame, expected: Mapping[str, object]) -> DataFrame:
    """Compare a one-row frame of control totals with expected values, one row per check."""
    checks = [
        F.struct(
            F.lit(name).alias("check"),
            F.col(name).cast("string").alias("actual"),
            F.lit(value).cast(totals.schema[name].dataType).cast("string").alias("expected"),
            F.col(name).eqNullSafe(F.lit(value).cast(totals.schema[name].dataType)).alias("ok"),
        )
        for name, value in expected.items()
    ]
    return totals.select(F.inline(F.array(*checks)))
