"""Gold: dimensions, bridge and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.contracts import (
    CALENDAR_RANGE,
    GOLD_COLUMNS,
    ORDER_STATUS_ROWS,
    PRODUCT_FIELDS,
    SELLER_FIELDS,
)
from tidelake.functions.bands import customer_segment, size_bucket
from tidelake.functions.flags import freight_share, late_by_calendar, late_by_clock
from tidelake.functions.keys import surrogate_key
from tidelake.operators.collapse import first_by_key
from tidelake.operators.conform import conform
from tidelake.operators.scd2 import current


def dim_order_status(spark: SparkSession) -> DataFrame:
    schema = (
        "order_status string, status_order int, is_terminal boolean, status_description string"
    )
    return spark.createDataFrame(ORDER_STATUS_ROWS, schema)


def dim_date(spark: SparkSession, calendar: tuple[str, str] = CALENDAR_RANGE) -> DataFrame:
    """The calendar of a fixed range of days."""
    first, last = (F.lit(day).cast("date") for day in calendar)
    return calendar_days(spark.range(1).select(first.alias("first"), last.alias("last")))


def calendar_days(span: DataFrame) -> DataFrame:
    """Every day of a one-row span (first, last) with its parts; weeks are ISO, day 1 is Sunday."""
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    day = F.col("date_key")
    return days.select(
        "date_key",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def _with_centroid(df: DataFrame, geolocation: DataFrame, prefix: str) -> DataFrame:
    """Left join of the zip centroid; places without one stay with ``has_geo`` false."""
    centroids = geolocation.select(
        "zip_code_prefix",
        F.col("latitude").alias(f"{prefix}_latitude"),
        F.col("longitude").alias(f"{prefix}_longitude"),
    )
    return df.join(centroids, "zip_code_prefix", "left").withColumn(
        "has_geo", F.col(f"{prefix}_latitude").isNotNull()
    )


def dim_seller(versions: DataFrame, geolocation: DataFrame) -> DataFrame:
    sellers = conform(current(versions), SELLER_FIELDS, surrogate_key("seller_id").alias("seller_sk"))
    return _with_centroid(sellers, geolocation, "seller").select(*GOLD_COLUMNS["dim_seller"])


def dim_product(versions: DataFrame, translation: DataFrame) -> DataFrame:
    """Current products. Untranslated categories fall back to the source name, then 'unknown'."""
    products = conform(
        current(versions), PRODUCT_FIELDS, surrogate_key("product_id").alias("product_sk")
    )
    names = translation.select(
        F.col("category_pt").alias("category_raw"), F.col("category_en").alias("translated")
    )
    described = products.join(names, "category_raw", "left").withColumns(
        {
            "category_pt": F.expr("coalesce(category_raw, 'unknown')"),
            "category_en": F.expr("coalesce(translated, category_raw, 'unknown')"),
            "volume_cm3": F.expr("round(length_cm * height_cm * width_cm, 2)"),
            "size_bucket": size_bucket("weight_g"),
        }
    )
    return described.select(*GOLD_COLUMNS["dim_product"])


def dim_customer(people: DataFrame, geolocation: DataFrame) -> DataFrame:
    """People, keyed by the person and not by the per-order customer id."""
    named = people.select(
        surrogate_key("customer_unique_id").alias("customer_sk"),
        "customer_unique_id",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        "zip_code_prefix",
        "lifetime_order_count",
        "is_repeat_customer",
        customer_segment("lifetime_order_count").alias("customer_segment"),
    )
    return _with_centroid(named, geolocation, "customer").select(*GOLD_COLUMNS["dim_customer"])


def bridge_customer_order(customer_keys: DataFrame) -> DataFrame:
    """Per-order customer id to person, one row per customer id."""
    pairs = customer_keys.select("customer_id", "customer_unique_id")
    return first_by_key(pairs, "customer_id").withColumn(
        "customer_sk", surrogate_key("customer_unique_id")
    )


def order_spine(orders: DataFrame, bridge: DataFrame) -> DataFrame:
    """Orders with the person's id: the side all three facts look up.

    Resolving the bridge here, at order grain, keeps the much longer fact tables to one shuffle. Facts make the person's
    key from the id after their join, as a digest moves as 64 characters.
    """
    people = bridge.select("customer_id", "customer_unique_id")
    return orders.drop("_ingested_at", "_source_file").join(people, "customer_id", "left")


def fct_order_items(items: DataFrame, spine: DataFrame) -> DataFrame:
    """Order lines. A line without an order is left out; one without a person is kept."""
    purchased, delivered, promised = (
        F.col("order_purchase_timestamp"),
        F.col("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date"),
    )
    delay = F.datediff(delivered, promised)
    lines = items.drop("_ingested_at", "order_item_sk").join(spine, "order_id", "inner")
    derived = {
        # made where it is needed: before the join its digest would move with every line
        "order_item_sk": surrogate_key("order_id", "order_item_id"),
        "customer_sk": surrogate_key("customer_unique_id"),
        "seller_sk": surrogate_key("seller_id"),
        "product_sk": surrogate_key("product_id"),
        "order_date_key": F.to_date(purchased),
        "gross_revenue": F.expr("price + freight_value"),
        "freight_ratio": freight_share(F.col("freight_value"), F.col("price")),
        "delivery_days": F.datediff(delivered, purchased),
        "delivery_delay_days": delay,
        "is_late_delivery": late_by_calendar(delay),
        "is_delivered": F.expr("order_status = 'delivered'"),
    }
    return lines.withColumns(derived).select(*GOLD_COLUMNS["fct_order_items"])


def fct_payments(payments: DataFrame, spine: DataFrame) -> DataFrame:
    """Payment rows; one without an order is kept and flagged."""
    known = spine.select("order_id", "customer_unique_id", "order_purchase_timestamp", "order_status")
    derived = {
        "customer_sk": surrogate_key("customer_unique_id"),
        "payment_sk": surrogate_key("order_id", "payment_sequential"),
        "order_date_key": F.to_date("order_purchase_timestamp"),
        "is_installment": F.expr("payment_installments > 1"),
        "has_order": F.expr("order_purchase_timestamp IS NOT NULL"),
    }
    joined = payments.join(known, "order_id", "left").withColumns(derived)
    return joined.select(*GOLD_COLUMNS["fct_payments"])


def fct_reviews(reviews: DataFrame, spine: DataFrame) -> DataFrame:
    """Review and order pairs with their own, clock-based lateness."""
    known = spine.select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "order_delivered_customer_date",
        "order_estimated_delivery_date", "order_status",
    )
    derived = {
        "customer_sk": surrogate_key("customer_unique_id"),
        "order_date_key": F.to_date("order_purchase_timestamp"),
        "is_negative": F.expr("review_score <= 2"),
        "is_positive": F.expr("review_score >= 4"),
        "has_comment": F.expr("review_comment_message IS NOT NULL"),
        "is_late_delivery": late_by_clock(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        ),
    }
    joined = reviews.join(known, "order_id", "left").withColumns(derived)
    return joined.select(*GOLD_COLUMNS["fct_reviews"])
