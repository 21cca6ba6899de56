"""File layout and statistics of stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from os.path import commonprefix

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.contracts import CLUSTER_COLUMNS
from tidelake.functions.keys import packed_key, unpacked_key

#: Rank buckets of a clustering column are numbered with so many bits.
RANK_BITS = 6


def order_numbers(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """A number for each column's values that keeps their order: times and numbers themselves, of texts
    the six bytes that follow what all of them begin with."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in texts for f in (F.min, F.max)]).first() if texts else None
    found = []
    for c in columns:
        kind = df.schema[c].dataType
        if c in texts:
            shared = len(commonprefix([ends[f"min_{c}"] or "", ends[f"max_{c}"] or ""]))
            head = F.rpad(F.substring(F.encode(F.substring(c, shared + 1, 6), "UTF-8"), 1, 6), 6, F.lit(b"\0"))
            found.append(F.conv(F.hex(head), 16, 10).cast("double"))
        elif isinstance(kind, T.NumericType):
            found.append(F.col(c).cast("double"))
        else:
            found.append(F.unix_micros(F.col(c).cast("timestamp")).cast("double"))
    return found


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column:
    """Place of a row on a Z-shaped curve through the columns' rank buckets.

    Cutting points are quantiles, so each bucket holds about as many rows, however the values spread. The bits of the
    bucket numbers are taken in turns: rows close on the curve are close in every column. Unknown values go first.
    """
    numbers = order_numbers(df, columns)
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    cuts = df.agg(*[F.percentile_approx(n, shares, 2**bits * 16).alias(f"c{i}") for i, n in enumerate(numbers)]).first()
    place = F.lit(0)
    for i, number in enumerate(numbers):
        limits = sorted(set(cuts[f"c{i}"] or []))
        marks = [
            sum((bucket >> bit & 1) << (bit * len(columns) + len(columns) - 1 - i) for bit in range(bits)) for bucket in range(len(limits) + 1)
        ]
        place = place.bitwiseOR(_choose(number, limits, marks))
    return place


def _choose(number: Column, limits: Sequence[float], marks: Sequence[int]) -> Column:
    """The mark of the bucket that a number lies in, by halving: a row costs one comparison for each bit. Unknown numbers lie in the first."""
    if not limits:
        return F.lit(marks[0])
    half = len(limits) // 2
    above = _choose(number, limits[half + 1 :], marks[half + 1 :])
    return F.when(number >= limits[half], above).otherwise(_choose(number, limits[:half], marks[: half + 1]))


def cluster(
    df: DataFrame, columns: Sequence[str], files: int | None = None
) -> DataFrame:
    """Laid out by ``columns``, so that readers skip files and row groups by any of them.

    One column gives ranges; several give stretches of a space-filling curve, as ranges by the first column would leave nothing
    to skip for a filter on the second. Without ``files`` adaptive execution sizes the partitions. A hash of the row is
    the last range column: one value holding a large share of the rows spreads over several files. Surrogate keys move as
    bytes and are texts again in the result.
    """
    digests = [f.name for f in df.schema if f.name.endswith("_sk") and isinstance(f.dataType, T.StringType) and f.name not in columns]
    names = df.columns
    df = df.withColumns({c: packed_key(c) for c in digests}) if digests else df
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(4096))
    if len(columns) > 1:
        numbers = {f"__number{i}": n for i, n in enumerate(order_numbers(df, columns))}
        df = df.withColumns(numbers)  # columns of their own, as a place looks at them several times
        df = df.withColumn("__place", curve_place(df, list(numbers))).drop(*numbers)
    order = ["__place", *columns] if len(columns) > 1 else list(columns)
    ranges = [*[F.col(c) for c in order], spread]
    ranged = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    laid = ranged.sortWithinPartitions(*order)
    return laid.select(*[unpacked_key(c).alias(c) if c in digests else F.col(f"`{c}`") for c in names])


def files_touched(df: DataFrame, column: str, least: Column, most: Column) -> DataFrame:
    """How many of a stored table's files a filter on ``column`` has to open, going by the files' value ranges, and of how many."""
    ranges = df.groupBy(F.input_file_name().alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ranges.agg(F.count_if((F.col("low") <= most) & (F.col("high") >= least)).alias("touched"), F.count("*").alias("files"))


def _attempt(step: Callable[[], object]) -> str:
    try:
        step()
    except PySparkException as error:
        return f"skipped: {error.getCondition() or type(error).__name__}"
    return "done"


def optimise(
    spark: SparkSession,
    replace: Callable[[str, DataFrame], None],
    targets: Mapping[str, Sequence[str]] = CLUSTER_COLUMNS,
    layer: str = "gold",
    files: int | None = None,
) -> DataFrame:
    """Rewrite tables by their clustering columns, compact them on the way, refresh statistics.

    Tables are worked on side by side and every step stands alone: one that fails is reported and
    the rest goes on. ``replace(name, frame)`` stores the rewritten contents.
    """

    def one(target: tuple[str, Sequence[str]]) -> list[tuple[str, str, str]]:
        name, columns = target
        table = f"{layer}.{name}"

        def rewrite() -> None:
            replace(name, cluster(spark.read.table(table), columns, files))

        def analyse() -> None:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")

        return [
            (table, f"cluster and compact by {', '.join(columns)}", _attempt(rewrite)),
            (table, "statistics", _attempt(analyse)),
        ]

    with ThreadPoolExecutor(max(1, len(targets))) as pool:
        results = [row for rows in pool.map(one, targets.items()) for row in rows]
    return spark.createDataFrame(results, "table string, step string, status string")
