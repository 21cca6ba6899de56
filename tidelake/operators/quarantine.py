"""Rows set aside for audit, with the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "_quarantine_reason"


def quarantine(df: DataFrame, reasons: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows meeting at least one predicate, tagged with the first reason in the given order."""
    hits = [F.when(F.expr(predicate), F.lit(reason)) for reason, predicate in reasons]
    return df.withColumn(REASON, F.coalesce(*hits)).filter(F.col(REASON).isNotNull())
