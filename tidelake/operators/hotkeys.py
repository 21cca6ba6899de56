"""Ordered work inside a key when one key may hold a large share of all rows.

A window per key puts the whole key into one task. Here keys above ``max_rows`` are cut into
ordered segments that are windows of their own, and one small row per segment carries what the
next segment needs to know. Keys below the limit stay whole and have no segment (NULL).

Whether a key can be heavy at all is told first by counting rows in fixed hash buckets, of which a map task sends one small row
each; mostly none is crowded, and rows then move once and meet no helper table.

Both helper tables are small beside the rows: at most ``rows / max_rows`` keys can exceed the limit,
and their segments number at most a small multiple of that. They still grow with the data, so no
broadcast is forced; Spark picks the join by their measured size. The
segment is a window partition column, so "has a segment" is pushed below the window and its
shuffle: without heavy keys the helper branches read nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.session import scratch_folder

MAX_ROWS = 2_000_000
SEGMENT = "__segment"
BUCKETS = 1 << 16


def _prefixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"__of_{c}" for c in columns})


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a bounded helper table on null-safe key equality."""
    helper = _prefixed(small, keys)
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(helper[f"__of_{k}"]) for k in keys])
    return df.join(helper, same, "left").drop(*[f"__of_{k}" for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], max_rows: int, *extra: Column) -> DataFrame:
    """Keys with more than ``max_rows`` rows and the number of segments each needs."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("__rows"), *extra)
    heavy = counted.filter(F.col("__rows") > max_rows)
    segments = F.ceil(F.col("__rows") / max_rows).cast("long")
    return heavy.withColumn("__segments", segments).drop("__rows")


def may_have_heavy_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> bool:
    """False if no key has more than ``max_rows`` rows, as no hash bucket of keys has."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    return not df.groupBy(bucket.alias("bucket")).count().filter(F.col("count") > max_rows).isEmpty()


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    digest_of: Sequence[Column],
    ties: Sequence[str],
    name: str,
    max_rows: int = MAX_ROWS,
    home: Column | None = None,
) -> DataFrame:
    """Dense 1-based number per key, ordered by an MD5 digest and then by ``ties``.

    ``home`` is the key in the form that a later join looks it up by, one value for each key: rows without heavy keys then
    move by it, and the join finds them where they are.

    The digest spreads a heavy key evenly over its segments and keeps their order: segment ``i``
    holds smaller digests than segment ``i + 1``. Without heavy keys rows move by their key alone, and the digest
    is taken where they arrive. Keys are counted when this is called.
    """
    digest = F.md5(F.concat_ws("|", *digest_of))
    if not may_have_heavy_keys(df, keys, max_rows):
        by = list(keys) if home is None else [home]
        place = F.row_number().over(W.partitionBy(*by).orderBy("__digest", *ties))
        moved = df.repartition(*by).withColumn("__digest", digest)
        return moved.withColumn(name, place.cast("int")).select(*df.columns, name)
    digested = df.withColumn("__digest", digest)
    prefix = F.conv(F.substring("__digest", 1, 8), 16, 10).cast("long")
    rows = attach(digested, heavy_keys(df, keys, max_rows), keys).withColumn(
        SEGMENT, F.shiftright(prefix * F.col("__segments"), 32)
    )
    earlier = W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.filter(F.col(SEGMENT).isNotNull())
        .groupBy(*keys, SEGMENT)
        .agg(F.count("*").alias("__size"))
        .withColumn("__offset", F.sum("__size").over(earlier))
        .drop("__size")
    )
    within = W.partitionBy(*keys, SEGMENT).orderBy("__digest", *ties)
    numbered = attach(
        rows.withColumn("__local", F.row_number().over(within)), offsets, [*keys, SEGMENT]
    )
    position = F.col("__local") + F.coalesce("__offset", F.lit(0))
    return numbered.select(*df.columns, position.cast("int").alias(name))


def segment_by_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """Add the segment of each row of a heavy key: consecutive ranks in ``order``, at most half of ``max_rows`` each.

    Spark's range exchange deals the rows of heavy keys to sorted partitions by all order columns at once, so equal time stamps
    are told apart by what follows them; segments are then cut by the place within the partition. How many partitions
    there are follows the session and ``MAX_ROWS`` and not ``max_rows``, so short segments cost no partition, sample or file each.
    Rows equal in all columns are made one before. Sampled limits are no pure function of the data: the cut rows are
    written once, and whatever is computed again reads them. Without heavy keys nothing is written or joined.
    """
    spark = df.sparkSession
    none = F.lit(None).cast("long")
    if not may_have_heavy_keys(df, keys, max_rows):
        return df.withColumn(SEGMENT, none)
    heavy = heavy_keys(df, keys, max_rows, F.count("*").alias("__size"))
    total = heavy.agg(F.sum("__size")).first()[0]
    if not total:
        return df.withColumn(SEGMENT, none)
    marked = attach(df, heavy.drop("__segments"), keys)
    ordinary = marked.filter("__size IS NULL").drop("__size").withColumn(SEGMENT, none)
    ranges = [*keys, *order]
    distinct = marked.filter("__size IS NOT NULL").drop("__size").dropDuplicates()
    needed = -(-2 * total // MAX_ROWS)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.repartitionByRange(needed, *ranges) if needed > usual else distinct.repartitionByRange(*ranges)
    # a row's id is its partition's number above 33 bits of its place in the partition
    row, share = F.monotonically_increasing_id(), max(1, max_rows // 2)
    place = row.bitwiseAND((1 << 33) - 1)
    cut = dealt.sortWithinPartitions(*ranges).withColumn(SEGMENT, row - place + F.floor(place / share))
    path = scratch_folder(spark, "hot-keys")
    cut.write.parquet(path)
    return ordinary.unionByName(spark.read.parquet(path))


def carry(
    rows: DataFrame, keys: Sequence[str], summary: Column, name: str, backwards: bool = False, fill: bool = False
) -> DataFrame:
    """Attach to each segment's rows the summary of the nearest earlier segment of the key.

    With ``backwards`` the nearest later one; with ``fill`` the nearest whose summary is not NULL. Rows of
    ordinary keys get NULL.
    """
    order = F.col(SEGMENT).desc() if backwards else F.col(SEGMENT).asc()
    others = W.partitionBy(*keys).orderBy(order)
    nearest = F.last("__summary", ignorenulls=True).over(others.rowsBetween(W.unboundedPreceding, -1))
    carried = (
        rows.filter(F.col(SEGMENT).isNotNull())
        .groupBy(*keys, SEGMENT)
        .agg(summary.alias("__summary"))
        .withColumn(name, nearest if fill else F.lag("__summary").over(others))
        .drop("__summary")
    )
    return attach(rows, carried, [*keys, SEGMENT])
