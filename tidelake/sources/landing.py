"""Landing files: source specs, CSV dialect, listing and the gate."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.contracts import AUDIT_COLUMNS, LANDING_COLUMNS, MULTILINE_SOURCES, RESCUE_COLUMN
from tidelake.operators.integrity import union_all


class Source(NamedTuple):
    """One landing folder and the columns it is declared to have, all read as text."""

    name: str
    columns: tuple[str, ...]
    multiline: bool = False

    @property
    def csv_options(self) -> dict[str, str]:
        return {
            "header": "true",
            "quote": '"',
            "escape": '"',
            "encoding": "UTF-8",
            "multiLine": str(self.multiline).lower(),
            "mode": "PERMISSIVE",
        }

    @property
    def bronze_schema(self) -> str:
        text = [*self.columns, RESCUE_COLUMN]
        audit = {"_ingested_at": "timestamp"}
        fields = [f"`{c}` string" for c in text]
        fields += [f"`{c}` {audit.get(c, 'string')}" for c in AUDIT_COLUMNS]
        return ", ".join(fields)


SOURCES = {
    name: Source(name, columns, name in MULTILINE_SOURCES)
    for name, columns in LANDING_COLUMNS.items()
}
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
# Every file is landed data, whatever its suffix; Spark itself skips names that start with "." or "_".
FILE_OPTIONS = {"recursiveFileLookup": "true"}
# Only the gate asks for the usual suffix.
GATE_OPTIONS = {**FILE_OPTIONS, "pathGlobFilter": "*.csv"}


def with_audit(df: DataFrame, source: str) -> DataFrame:
    """Stamp rows with when, from which file and from which system they came."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_source_system": F.lit(source),
        }
    )


def list_files(spark: SparkSession, landing: str, source: str) -> DataFrame:
    """Paths of a source's CSV files, nested folders included; file contents are not read."""
    files = spark.read.format("binaryFile").options(**GATE_OPTIONS).load(f"{landing}/{source}")
    return files.select("path", "length")


def landing_report(
    spark: SparkSession, landing: str, expected: Iterable[str] = tuple(SOURCES)
) -> DataFrame:
    """Files per expected source: 0 for an empty folder, -1 for a missing one."""
    expected = tuple(expected)
    listed, missing = [], []
    for source in expected:
        try:
            files = list_files(spark, landing, source).select(F.lit(source).alias("source"))
        except AnalysisException:
            missing.append(source)
        else:
            listed.append(files)
    names = spark.createDataFrame(
        [(source, source in missing) for source in expected], "source string, missing boolean"
    )
    if not listed:
        return names.select("source", F.lit(-1).cast("long").alias("files"))
    counts = union_all(listed).groupBy("source").agg(F.count("*").alias("found"))
    files = F.when(F.col("missing"), F.lit(-1)).otherwise(F.coalesce("found", F.lit(0)))
    return names.join(counts, "source", "left").select("source", files.cast("long").alias("files"))


def landed_bytes(spark: SparkSession, landing: str) -> int:
    """Size of all files under the landing folder."""
    files = spark.read.format("binaryFile").options(**FILE_OPTIONS).load(landing)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


class LandingError(RuntimeError):
    """One or more landing sources hold nothing to ingest."""


def require_landing(
    spark: SparkSession, landing: str, expected: Iterable[str] = tuple(SOURCES)
) -> int:
    """Total file count; raises once, naming every empty or missing source."""
    rows = landing_report(spark, landing, expected).collect()  # one row per declared source
    problems = [
        f"{row.source}: {'folder missing' if row.files < 0 else 'no CSV files'}"
        for row in sorted(rows)
        if row.files <= 0
    ]
    if problems:
        raise LandingError("landing is incomplete: " + "; ".join(problems))
    return sum(row.files for row in rows)
