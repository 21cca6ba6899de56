"""Helpers of the corpus operators: scratch tables, text hashing, components of a link graph."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake.session import scratch_folder

HELD_OUT_FOLDS = 5


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write to a new folder of the shared scratch location and read it back: lineage ends here."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove what ``keep`` wrote, once nothing that is still to be computed reads it."""
    for df in frames:
        spark = df.sparkSession
        for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What Spark hands to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep the batches for Python workers small: texts may be long, and a worker holds several copies of a batch."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        held = spark.conf.get(key, None)
        now = int(re.sub(r"\D", "", held)) if held else 0
        if not held or now <= 0 or not held.isdigit() or now > most:
            spark.conf.set(key, str(most))


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The work of a task, after which its worker gives free memory back: workers live on and serve later stages."""

    def run(parts):
        yield from work(parts)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return run


#: Ids of eight bytes that are broadcast at most.
BROADCAST_IDS = 500_000


def small(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it is counted to be small enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def held_out(key: str) -> Column:
    """The fold that no learner sees: crc32 of the id as text, modulo five, is zero. A null id is not held out."""
    remainder = F.crc32(F.col(key).cast("string").cast("binary")) % HELD_OUT_FOLDS
    return F.coalesce(remainder == 0, F.lit(False))


def batch(schema: str | StructType, *columns) -> pa.RecordBatch:
    """A record batch of the given Arrow schema."""
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit words so that all bits depend on all bits (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.Table]:
    """Cut a stream sorted by ``key`` into tables of about ``rows`` rows that never split a group.

    Callers bound the size of a group before; memory is one group plus one batch.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for part in batches:
        if not part.num_rows:
            continue
        held.append(part)
        size += part.num_rows
        if size < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        keys = whole.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield whole.slice(0, cut)
            held = whole.slice(cut).combine_chunks().to_batches()
            size = whole.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an undirected link list; component is the smallest node.

    Alternating large-star and small-star rounds: each hangs neighbours on their smallest neighbour, as
    one aggregate and one join, until nothing changes. No round holds the neighbours of a node in
    one place; each round's links are written to the shared scratch folder.
    """
    edges = links.select(F.greatest(left, right).alias("v"), F.least(left, right).alias("u")).filter("u < v").distinct()
    edges = keep(edges, "links")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        older = edges
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = keep(large.filter("u < v").distinct(), "large-star")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(
            least.select("v", F.col("m").alias("u"))
        )
        edges = keep(small.filter("u < v").distinct(), "small-star")
        discard(older, large)
        after = state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return members.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
