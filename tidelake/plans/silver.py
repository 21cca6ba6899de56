"""Silver: typed, cleaned, deduplicated. Every function takes bronze frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.contracts import SILVER_FIELDS
from tidelake.functions.keys import surrogate_key
from tidelake.operators.collapse import centroid_with_mode, latest_by_key
from tidelake.operators.conform import conform
from tidelake.operators.expectations import drop_failing, rules_for
from tidelake.operators.quarantine import quarantine
from tidelake.operators.scd2 import history
from tidelake.plans.rules import QUARANTINE_REASONS


def typed_orders(bronze: DataFrame) -> DataFrame:
    return conform(bronze, SILVER_FIELDS["sv_orders"])


def typed_order_items(bronze: DataFrame) -> DataFrame:
    lines = conform(bronze, SILVER_FIELDS["sv_order_items"])
    return lines.withColumn("order_item_sk", surrogate_key("order_id", "order_item_id"))


def typed_payments(bronze: DataFrame) -> DataFrame:
    """Doubtful payments are flagged and kept; an unknown type or value is not doubtful."""
    doubtful = F.expr("payment_type = 'not_defined' OR payment_value <= 0")
    paid = conform(bronze, SILVER_FIELDS["sv_payments"])
    return paid.withColumn("is_suspect", F.coalesce(doubtful, F.lit(False)))


def typed_reviews(bronze: DataFrame) -> DataFrame:
    """Grain is review and order together: one review may cover several orders."""
    reviews = conform(bronze, SILVER_FIELDS["sv_reviews"])
    return reviews.withColumn("review_sk", surrogate_key("review_id", "order_id"))


def typed_customer_keys(bronze: DataFrame) -> DataFrame:
    return conform(bronze, SILVER_FIELDS["sv_customer_keys"])


# Row-wise tables: the same function serves a batch frame and a stream.
ROW_WISE = {
    "sv_orders": typed_orders,
    "sv_order_items": typed_order_items,
    "sv_payments": typed_payments,
    "sv_reviews": typed_reviews,
    "sv_customer_keys": typed_customer_keys,
}


def row_wise(dataset: str, bronze: DataFrame) -> DataFrame:
    """Typed rows of a row-wise table after its drop rules."""
    return drop_failing(ROW_WISE[dataset](bronze), rules_for(dataset))


def newest_orders(orders: DataFrame) -> DataFrame:
    """Optional repair for re-delivered orders: the last delivered version of each order."""
    return latest_by_key(orders, "order_id", ["_ingested_at"]).select(*orders.columns)


def quarantined_orders(bronze: DataFrame) -> DataFrame:
    """Orders with impossible dates. They also stay in the clean table."""
    return quarantine(conform(bronze, SILVER_FIELDS["sv_quarantine_orders"]), QUARANTINE_REASONS)


def customers(bronze: DataFrame) -> DataFrame:
    """One row per person: newest address and number of order-level records."""
    records = conform(bronze, SILVER_FIELDS["sv_customers"]).filter(
        "customer_unique_id IS NOT NULL"
    )
    people = latest_by_key(
        records, "customer_unique_id", ["_ingested_at", "customer_id"], "lifetime_order_count"
    )
    return people.drop("customer_id").withColumn(
        "is_repeat_customer", F.col("lifetime_order_count") > 1
    )


def category_translation(bronze: DataFrame) -> DataFrame:
    pairs = conform(bronze, SILVER_FIELDS["sv_category_translation"])
    return pairs.filter("category_pt IS NOT NULL")


def geolocation(bronze: DataFrame) -> DataFrame:
    """One centroid, modal city and modal state per zip prefix, over distinct points."""
    points = conform(bronze, SILVER_FIELDS["sv_geolocation"]).filter("zip_code_prefix IS NOT NULL")
    return centroid_with_mode(
        points, "zip_code_prefix", ["latitude", "longitude"], ["city", "state"]
    )


def sellers_history(bronze: DataFrame) -> DataFrame:
    return history(bronze, ["seller_id"], "_ingested_at")


def products_history(bronze: DataFrame) -> DataFrame:
    return history(bronze, ["product_id"], "_ingested_at")
