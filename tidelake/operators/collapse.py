"""Many rows to one per key, always through aggregates that combine before the shuffle.

A key that holds a large share of all rows is reduced to one row per map task before anything
moves, so none of these needs a per-key window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, key: str, order: Sequence[str], count_as: str | None = None
) -> DataFrame:
    """The row with the greatest ``order`` columns per key, and optionally the rows per key.

    Ties in ``order`` are settled by the remaining columns, so the outcome is deterministic.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    aggregates = [F.max(F.struct(*order, *rest)).alias("newest")]
    if count_as:
        aggregates.append(F.count("*").alias(count_as))
    counted = [F.col(count_as)] if count_as else []
    return df.groupBy(key).agg(*aggregates).select(
        key, *[F.col(f"newest.{c}").alias(c) for c in df.columns if c != key], *counted
    )


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by its other columns."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("kept")).select(
        key, *[F.col(f"kept.{c}").alias(c) for c in rest]
    )


def centroid_with_mode(
    points: DataFrame, key: str, coordinates: Sequence[str], labels: Sequence[str]
) -> DataFrame:
    """Per key: mean of each coordinate over distinct points, point count, most frequent labels.

    Label ties go to the smallest labels in order. Distinct points are first counted per
    (key, labels); the per-key step then only sees those partial rows, so mean and mode share one
    input and no join is needed.
    """
    partial = points.distinct().groupBy(key, *labels).agg(
        F.count("*").alias("points"),
        *[F.sum(c).alias(f"{c}__sum") for c in coordinates],
        *[F.count(c).alias(f"{c}__n") for c in coordinates],
    )
    per_key = partial.groupBy(key).agg(
        F.sum("points").alias("source_point_count"),
        F.min(F.struct((-F.col("points")).alias("rank"), *labels)).alias("mode"),
        *[
            F.try_divide(F.sum(f"{c}__sum"), F.sum(f"{c}__n")).alias(c) for c in coordinates
        ],
    )
    return per_key.select(
        key, *coordinates, "source_point_count",
        *[F.col(f"mode.{label}").alias(label) for label in labels],
    )
