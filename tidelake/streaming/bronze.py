"""Incremental landing of CSV files into append-only bronze tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelake.contracts import RESCUE_COLUMN
from tidelake.sources.commits import BATCH, ONE_RUN, CommittedTable
from tidelake.sources.drift import read_by_name
from tidelake.sources.landing import FILE_OPTIONS, FILE_SCHEMA, SOURCES, Source, with_audit


def ingest(
    spark: SparkSession,
    landing: str,
    source: Source,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int = 1000,
    learn: Callable[[DataFrame], object] | None = None,
) -> StreamingQuery:
    """Append files not seen before, matching columns by header name. ``learn`` gets each batch's rows before they count.

    The stream carries file paths only; each batch reads its own new files. Rows become visible by the
    batch's manifest, after which running the batch again changes nothing: a crash at any point adds nothing twice,
    neither for readers nor for streams that follow the table.
    """
    table = CommittedTable(spark, target)
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .options(**FILE_OPTIONS, maxFilesPerTrigger=files_per_batch)
        .load(f"{landing}/{source.name}")
        .select("path")
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        if table.has(batch_id):
            return
        rows = read_by_name(batch.sparkSession, source, batch)
        if rows is not None:
            table.write(rows, batch_id)
            if learn is not None:
                learn(rows)
        table.commit(batch_id)

    return (
        files.writeStream.foreachBatch(append)
        .queryName(f"bronze_{source.name}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONE_RUN))
        .start()
    )


def ingest_by_position(
    spark: SparkSession,
    landing: str,
    source: Source,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Plain file stream for sources whose header never changes.

    Columns map by position; surplus fields put the raw line into the rescue column. The file sink
    keeps its own commit log, so rows arrive exactly once for readers of the folder as well.
    """
    schema = ", ".join(f"{c} string" for c in [*source.columns, RESCUE_COLUMN])
    rows = (
        spark.readStream.format("csv")
        .schema(schema)
        .options(**source.csv_options, **FILE_OPTIONS, columnNameOfCorruptRecord=RESCUE_COLUMN)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{landing}/{source.name}")
    )
    return (
        with_audit(rows, source.name)
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName(f"bronze_{source.name}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONE_RUN))
        .start(target)
    )


def read_bronze(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """Batch read of a bronze table under its declared columns."""
    if _by_manifest(spark, source, folder):
        return CommittedTable(spark, folder).read(source.bronze_schema)
    return spark.read.schema(source.bronze_schema).parquet(folder)


def stream_bronze(spark: SparkSession, source: Source, folder: str) -> DataFrame:
    """Stream of the files of a bronze folder, for tables of the positional ingest, whose sink logs its files itself."""
    return spark.readStream.schema(source.bronze_schema).parquet(folder).drop(BATCH)


def follow_bronze(
    spark: SparkSession,
    source: Source,
    folder: str,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Call ``handle(rows, id)`` with what is new in a bronze table: its change feed, as it only ever appends.

    Batches of the by-name ingest are followed by their manifests, so that none is seen twice or in part.
    """
    if _by_manifest(spark, source, folder):
        return CommittedTable(spark, folder).follow(source.bronze_schema, handle, checkpoint, name, trigger)
    writer = stream_bronze(spark, source, folder).writeStream.foreachBatch(handle)
    writer = writer.queryName(name) if name else writer
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONE_RUN)).start()


def _by_manifest(spark: SparkSession, source: Source, folder: str) -> bool:
    """Whether a table has manifests, or nothing yet; files without any come from the positional ingest."""
    if CommittedTable(spark, folder).exists():
        return True
    try:
        return not spark.read.schema(source.bronze_schema).parquet(folder).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return True


def start_all(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoints: str,
    by_position: bool = False,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """One stream per source, side by side.

    ``trigger={"processingTime": "1 minute"}`` keeps them running instead of one triggered run.
    """
    start = ingest_by_position if by_position else ingest
    return [
        start(
            spark, landing, source, f"{bronze}/br_{name}", f"{checkpoints}/br_{name}", trigger
        )
        for name, source in SOURCES.items()
    ]


def ingest_all(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, by_position: bool = False
) -> None:
    """Bring all sources up to date and return."""
    for query in start_all(spark, landing, bronze, checkpoints, by_position):
        query.awaitTermination()
