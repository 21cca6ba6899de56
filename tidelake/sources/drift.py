"""CSV files whose headers differ from the declared columns.

Spark maps CSV columns by position, so a reordered header would silently swap values. Files are
therefore grouped by their header line, each group is read under its own header, and columns are
matched by name: missing ones become NULL, unknown ones and unreadable lines go to the rescue
column as JSON.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.contracts import RESCUE_COLUMN
from tidelake.operators.integrity import union_all
from tidelake.sources.landing import Source, with_audit

_RAW_LINE = "__raw_line"
_log = logging.getLogger(__name__)


def headers(files: DataFrame, chunk: int = 64 * 1024) -> DataFrame:
    """Files with their header line, read inside the tasks that own the paths.

    The header is the first line that is not blank, as for Spark's own reader; no more of a file is
    read than that takes, and compressed files are read through. The function carries everything it needs,
    so executors do not have to have this package installed.
    """

    def read_headers(batches):
        from urllib.parse import urlsplit

        from pyarrow import fs

        def header_line(path):
            parts = urlsplit(path)
            if parts.scheme in ("", "file"):
                filesystem, inner = fs.LocalFileSystem(), path.removeprefix("file:")
            else:
                # Hadoop's names for S3 are not known outside of it.
                address = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
                filesystem, inner = fs.FileSystem.from_uri(address)
            rest = b""
            with filesystem.open_input_stream(inner) as stream:
                while block := stream.read(chunk):
                    *lines, rest = (rest + block).split(b"\n")
                    for line in lines:
                        if text := line.decode("utf-8-sig").strip():
                            return text
            return rest.decode("utf-8-sig").strip()

        for batch in batches:
            yield batch.assign(header=[header_line(path) for path in batch["path"]])

    return files.select("path").mapInPandas(read_headers, "path string, header string")


def _named(header: str, source: Source) -> tuple[list[str], dict[str, str]]:
    """Physical column names of a header, and the declared name each one stands for."""
    given = [name.strip() for name in next(csv.reader([header]), [])]
    physical = [f"c{i}" for i in range(len(given))]
    stands_for: dict[str, str] = {}
    for column, name in zip(physical, given):
        if name in source.columns and name not in stands_for.values():
            stands_for[column] = name
    return physical, stands_for


def _read_group(
    spark: SparkSession, source: Source, header: str, paths: Sequence[str]
) -> DataFrame:
    physical, stands_for = _named(header, source)
    given = [name.strip() for name in next(csv.reader([header]), [])]
    schema = ", ".join(f"{c} string" for c in [*physical, _RAW_LINE])
    raw = (
        spark.read.format("csv")
        .options(**source.csv_options, columnNameOfCorruptRecord=_RAW_LINE)
        .schema(schema)
        .load(list(paths))
    )
    found = {name: column for column, name in stands_for.items()}
    surplus = [(c, name or c) for c, name in zip(physical, given) if c not in stands_for]
    extras = [
        F.col(c).alias(name if [n for _, n in surplus].count(name) == 1 else f"{name}_{c}")
        for c, name in surplus
    ]
    rescued = F.to_json(F.struct(*extras, F.col(_RAW_LINE).alias("_raw_line")))
    stamped = with_audit(raw, source.name)
    return stamped.select(
        *[
            (F.col(found[c]) if c in found else F.lit(None).cast("string")).alias(c)
            for c in source.columns
        ],
        F.nullif(rescued, F.lit("{}")).alias(RESCUE_COLUMN),
        "_ingested_at",
        "_source_file",
        "_source_system",
    )


def read_by_name(spark: SparkSession, source: Source, files: DataFrame) -> DataFrame | None:
    """Rows of the given files (column ``path``) under the declared columns, plus audit columns.

    Only the paths of one batch reach the driver, as they do for any file listing, and ``files_per_batch``
    bounds them; the number of groups is the number of distinct header lines. Files without any line
    that is not blank hold nothing and are logged.
    """
    groups = (
        headers(files)
        .groupBy("header")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy("header")
        .collect()
    )
    for group in groups:
        if not group.header:
            _log.warning("%s: no line in %d file(s): %s", source.name, len(group.paths), group.paths)
    read = [_read_group(spark, source, g.header, g.paths) for g in groups if g.header]
    return union_all(read) if read else None
