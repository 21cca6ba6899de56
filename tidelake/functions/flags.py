"""Flags and ratios. Comparisons stay three-valued: unknown in, unknown out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def late_by_calendar(delay_days: Column) -> Column:
    """Late when the calendar day of delivery is after the promised day; NULL when undelivered."""
    return delay_days > 0


def late_by_clock(delivered: Column, promised: Column) -> Column:
    """Late when the delivery instant is after the promised instant.

    NULL only when undelivered; a delivery without a promise counts as on time. An order delivered
    later on the promised day is late here and on time in ``late_by_calendar``.
    """
    return F.when(delivered.isNotNull(), F.coalesce(delivered > promised, F.lit(False)))


def freight_share(freight: Column, price: Column) -> Column:
    """Freight over price to four places; NULL unless the price is positive."""
    return F.when(price > 0, F.round(freight / price, 4).cast("double"))


def mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count, NULL over nothing (as ``avg``)."""
    return F.try_divide(total.cast("double"), count)


def percentage(hits: Column, count: Column) -> Column:
    """Share of ``count`` in percent, in double arithmetic."""
    return F.lit(100) * mean(hits, count)
