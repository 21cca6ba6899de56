"""Date parts that do not depend on the session time zone when the input has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def month_label(moment: Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.substring(F.to_date(moment).cast("string"), 1, 7)


def month_number(moment: Column) -> Column:
    """Months since year zero, an order-preserving bucket."""
    return F.year(moment) * 12 + F.month(moment)


def clock_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since the epoch, order-preserving for both timestamp types and dates."""
    moment = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_seconds(moment)
    midnight = F.unix_date(F.to_date(moment)).cast("long") * 86400
    if isinstance(df.schema[column].dataType, T.DateType):
        return midnight
    return midnight + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
