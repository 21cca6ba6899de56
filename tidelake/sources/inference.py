"""Column types of text files, inferred over all files and kept beside the checkpoint.

What a column's values allow is a set of types; over several files it is the intersection, so it is an aggregate that
combines in any order, and new files only ever narrow it. The narrowest type left is the column's. Every change is a new
version, in a file that appears by a rename; a schema that was inferred once is thus found again, and a later
file that does not fit widens it instead of failing or losing its values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: From narrow to wide. A text is whole, decimal, a number, a day, a time, or just a text.
LADDER = ("boolean", "bigint", "decimal(38,9)", "double", "date", "timestamp")
VERSION = "version bigint, types map<string, array<string>>"
_WHOLE, _DECIMAL = r"^\s*[+-]?[0-9]{1,18}\s*$", r"^\s*[+-]?[0-9]{1,29}(\.[0-9]{1,9})?\s*$"


def allows(value: Column, kind: str) -> Column:
    """Whether a text can be read as a type without loss; nothing at all fits every type."""
    fits = {
        "boolean": F.lower(F.trim(value)).isin("true", "false"),
        "bigint": value.rlike(_WHOLE),
        "decimal(38,9)": value.rlike(_DECIMAL),
        "double": value.try_cast("double").isNotNull(),
        "date": value.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$") & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}") & value.try_cast("timestamp").isNotNull(),
    }[kind]
    return value.isNull() | fits


def possible(rows: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The types that all values of each column allow, in one pass."""
    found = rows.agg(*[F.bool_and(allows(F.col(c), kind)).alias(f"{c}|{kind}") for c in columns for kind in LADDER]).first()
    return {c: [kind for kind in LADDER if found[f"{c}|{kind}"] is not False] for c in columns}


class InferredSchema:
    """The stored schema of one source, version by version."""

    def __init__(self, spark: SparkSession, folder: str, columns: Sequence[str]):
        self.spark, self.folder, self.columns = spark, folder.rstrip("/"), list(columns)

    def history(self) -> DataFrame:
        return self.spark.read.schema(VERSION).option("recursiveFileLookup", True).json(self.folder)

    def _newest(self) -> tuple[int, dict[str, list[str]]]:
        try:
            row = self.history().orderBy(F.desc("version")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        return (row.version, row.types) if row else (0, {})

    def learn(self, rows: DataFrame) -> int:
        """Take new rows into account; the number of the version that then holds. Rows seen before change nothing."""
        number, stored = self._newest()
        seen = possible(rows, self.columns)
        merged = {c: [kind for kind in stored.get(c, LADDER) if kind in seen[c]] for c in self.columns}
        if merged != stored:
            number += 1
            entry = self.spark.createDataFrame([(number, merged)], VERSION).coalesce(1)
            entry.write.mode("overwrite").json(f"{self.folder}/{number}")
        return number

    def types(self) -> dict[str, str]:
        """The narrowest type that every column still allows."""
        stored = self._newest()[1]
        return {c: next(iter(stored.get(c, ())), "string") for c in self.columns}

    def typed(self, rows: DataFrame) -> DataFrame:
        """Text rows under their inferred types; other columns as they are."""
        types = self.types()
        return rows.select(*[F.trim(F.col(c)).cast(types[c]).alias(c) if types.get(c, "string") != "string" else F.col(c) for c in rows.columns])
