"""Typed projection of raw columns by contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.contracts import Field
from tidelake.functions.cleaning import can_fail, cleaned

MALFORMED = "_malformed"


def conform(
    df: DataFrame, fields: Sequence[Field], *extra: Column, tolerant: bool = False
) -> DataFrame:
    """One projection from raw to typed columns, plus ``extra`` raw expressions.

    Strict by default: a malformed number or timestamp fails the job. With ``tolerant`` it becomes
    NULL and ``_malformed`` names the raw columns that could not be read (see ``split_malformed``).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        cleaned(f.kind, F.col(f.source), types[f.source], tolerant).alias(f.name) for f in fields
    ]
    if tolerant:
        suspects = [
            F.when(
                F.col(f.source).isNotNull()
                & cleaned(f.kind, F.col(f.source), types[f.source], True).isNull(),
                F.lit(f.source),
            )
            for f in fields
            if can_fail(f.kind, types[f.source])
        ]
        found = F.array_compact(F.array(*suspects)) if suspects else F.array().cast("array<string>")
        columns.append(found.alias(MALFORMED))
    return df.select(*columns, *extra)


def split_malformed(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and rows to quarantine with the list of unreadable columns."""
    unreadable = F.size(MALFORMED) > 0
    return conformed.filter(~unreadable).drop(MALFORMED), conformed.filter(unreadable)
