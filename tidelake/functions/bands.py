"""Ordered label bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelake.contracts import DELAY_BANDS, SEGMENT_BANDS, SIZE_BANDS


def banded(
    value: str, bands: Sequence[tuple[str, str]], above: str, missing: str | None = None
) -> Column:
    """Label of the first band whose test holds, e.g. ``("< 500", "small")``.

    ``above`` labels whatever no band takes. NULL gets ``missing`` when given, else ``above``.
    """
    hits = [F.when(F.expr(f"`{value}` {test}"), F.lit(label)) for test, label in bands]
    if missing is not None:
        hits.insert(0, F.when(F.col(value).isNull(), F.lit(missing)))
    return F.coalesce(*hits, F.lit(above))


def size_bucket(weight: str = "weight_g") -> Column:
    return banded(weight, SIZE_BANDS, above="oversized", missing="unknown")


def delay_bucket(delay: str = "delivery_delay_days") -> Column:
    return banded(delay, DELAY_BANDS, above="15+ days late")


def customer_segment(orders: str = "lifetime_order_count") -> Column:
    return banded(orders, SEGMENT_BANDS, above="frequent", missing="one_time")
