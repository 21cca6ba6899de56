"""Masks for readers without clearance, each defined once as an SQL function.

Frames call them as columns, SQL and catalog views by name. ``define`` puts them into a schema of the catalog, where
readers without any Python can use them; sessions get them as temporary functions when a column is built.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidelake.contracts import ID_MASK_SUFFIX, TEXT_MASK

#: Name -> parameter, result type, body, description.
MASKS = {
    "mask_id": ("id STRING", "STRING", f"concat(left(id, 4), '{ID_MASK_SUFFIX}')", "First four characters and a redaction mark"),
    "mask_coordinate": ("degrees DOUBLE", "DOUBLE", "round(degrees, 1)", "About eleven kilometres of precision"),
    "mask_text": ("words STRING", "STRING", f"CASE WHEN words IS NOT NULL THEN '{TEXT_MASK}' END", "Whether there was a text, not which"),
}


def define(spark: SparkSession, schema: str | None = None) -> None:
    """Create or renew the masks, in a schema of the catalog or for the session."""
    for name, (parameter, result, body, about) in MASKS.items():
        target = f"FUNCTION {schema}.{name}" if schema else f"TEMPORARY FUNCTION {name}"
        spark.sql(f"CREATE OR REPLACE {target}({parameter}) RETURNS {result} COMMENT '{about}' RETURN {body}")


def _masked(name: str, column: Column) -> Column:
    define(SparkSession.active())
    return F.call_function(name, column)


def mask_customer_id(identifier: Column) -> Column:
    """First four characters followed by the redaction mark; NULL stays NULL."""
    return _masked("mask_id", identifier)


def mask_coordinate(degrees: Column) -> Column:
    """About eleven kilometres of precision."""
    return _masked("mask_coordinate", degrees)


def mask_free_text(text: Column) -> Column:
    """Hide the content but keep whether there was any."""
    return _masked("mask_text", text)
