"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings every job relies on. The forced skew split lets adaptive execution cut a hot
# join partition even when the aggregate above then needs one more exchange. Shuffle files go when their statement has ended: a
# job of many statements needs disk for the largest of them, not for all.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def spark_session(app: str = "tidelake", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(
    spark: SparkSession,
    input_bytes: int,
    partition_bytes: int = 512 << 20,
    most: int = 100_000,
) -> int:
    """Start shuffles with enough partitions for the input; adaptive execution merges small ones.

    Never lowers what the session is configured for. ``most`` keeps the number of map and reduce
    pairs manageable; at 100 TB a partition then holds about 1 GB and may spill.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    configured = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(configured, min(most, -(-input_bytes // partition_bytes)))
    spark.conf.set(key, str(wanted))
    return wanted


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tidelake-")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint location.

    A machine-local folder is only acceptable when driver and executors are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any store that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
