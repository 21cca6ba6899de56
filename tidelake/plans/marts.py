"""Marts.

Line-level joins to reviews are many-to-many: an order with several lines and several reviews
contributes every pair. The numbers over those pairs are sums of products, so no pair is ever
formed: reviews are reduced to one row per order, lines to one row per order and group, and the
two meet one-to-one with the other side's count as weight. The first reduction combines before the
shuffle, which also tames an order that holds a large share of all lines.

Distinct orders are counted without expanding or moving order rows once more: while rows still lie together by order, one
row of each (order, group) is flagged, and the flags add up like any other total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.functions.flags import mean, percentage
from tidelake.functions.keys import surrogate_key
from tidelake.functions.times import month_label

MONEY = "decimal(22,2)"


def line_rollup(lines: DataFrame, *keys: str | Column) -> DataFrame:
    """Lines to one row per order and ``keys``, holding every total the reports need."""
    return lines.groupBy("order_id", *keys).agg(
        F.count("*").alias("lines"),
        F.sum("gross_revenue").alias("gross"),
        F.sum("price").alias("price"),
        F.count("price").alias("priced"),
        F.sum("freight_value").alias("freight"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("timed"),
        F.sum("delivery_delay_days").alias("delay"),
        F.count("delivery_delay_days").alias("compared"),
        F.count_if("is_late_delivery").alias("late"),
    )


def _first_of(*group: str) -> Column:
    """1 on one row of each group, which must be fine enough to fit a task: an order within something."""
    return (F.row_number().over(W.partitionBy(*group).orderBy(F.lit(0))) == 1).cast("int")


def review_totals(reviews: DataFrame) -> DataFrame:
    """Reviews to one row per order."""
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"),
        F.sum("review_score").alias("score"),
        F.count("review_score").alias("scored"),
    )


def _money(total: Column) -> Column:
    return F.round(total, 2).cast(MONEY)


def _weight(fanout_safe: bool) -> Column:
    """How often an order's lines count: once per review, at least once."""
    return F.lit(1) if fanout_safe else F.coalesce("reviews", F.lit(1))


def _review_score(fanout_safe: bool) -> Column:
    """Mean score over line and review pairs, or over the reviews of distinct orders."""
    copies = F.lit(1) if fanout_safe else F.col("lines")
    return F.round(mean(F.sum(F.col("score") * copies), F.sum(F.col("scored") * copies)), 2)


def delivery_performance(
    lines: DataFrame, customers: DataFrame, reviews: DataFrame, fanout_safe: bool = False
) -> DataFrame:
    """Delivered lines by customer state and month.

    Lines of an order with several reviews count once per review. ``fanout_safe`` counts each line
    once and takes the review score over orders instead.
    """
    month = month_label(F.col("order_purchase_timestamp")).alias("year_month")
    orders = line_rollup(lines.filter("is_delivered"), "customer_sk", month)
    states = customers.select("customer_sk", "customer_state")
    # the join by order comes last, so that its partitioning serves the flag
    joined = (
        orders.join(states, "customer_sk", "left")
        .join(review_totals(reviews), "order_id", "left")
        .withColumns({"weight": _weight(fanout_safe), "first": _first_of("order_id", "customer_state", "year_month")})
    )

    def weighted(column: str) -> Column:
        return F.sum(F.col(column) * F.col("weight"))

    return joined.groupBy("customer_state", "year_month").agg(
        weighted("lines").alias("line_items"),
        F.sum("first").alias("orders"),
        _money(weighted("gross")).alias("gmv"),
        F.round(mean(weighted("days"), weighted("timed")), 1).alias("avg_delivery_days"),
        F.round(mean(weighted("delay"), weighted("compared")), 1).alias("avg_delay_days"),
        F.round(percentage(weighted("late"), weighted("lines")), 2).alias("late_pct"),
        _review_score(fanout_safe).alias("avg_review_score"),
    )


def seller_scorecard(
    lines: DataFrame,
    sellers: DataFrame,
    reviews: DataFrame,
    min_lines: int = 20,
    fanout_safe: bool = False,
) -> DataFrame:
    """Per current seller with at least ``min_lines`` lines; fan-out as in the delivery mart.

    Lines are reduced per (order, seller, product) once, look up their order's review totals, and roll up to
    (seller, product) and seller, so distinct orders and products are plain sums. They are grouped by the short natural
    key; the surrogate key is formed per seller afterwards, when one row per seller meets the dimension.
    """
    parts = line_rollup(lines, "seller_id", "product_id").join(review_totals(reviews), "order_id", "left")
    parts = parts.withColumns({"weight": _weight(fanout_safe), "first": _first_of("order_id", "seller_id")})
    score = F.try_divide("score", "scored") if fanout_safe else F.col("score")
    scored = score.isNotNull().cast("int") if fanout_safe else F.col("scored")

    totals = ("lines", "gross", "price", "priced", "days", "timed", "late")
    products = parts.groupBy("seller_id", "product_id").agg(
        *[F.sum(F.col(c) * F.col("weight")).alias(c) for c in totals],
        F.sum("first").alias("orders"),
        F.sum(score * F.col("lines")).alias("score"),
        F.sum(scored * F.col("lines")).alias("scored"),
    )
    item_price = (F.sum("price") / F.nullif(F.sum("priced"), F.lit(0))).cast("decimal(14,6)")
    scores = products.groupBy("seller_id").agg(
        F.sum("lines").alias("line_items"),
        F.sum("orders").alias("orders"),
        F.count("product_id").alias("distinct_products"),
        _money(F.sum("gross")).alias("gmv"),
        F.round(item_price, 2).cast("decimal(11,2)").alias("avg_item_price"),
        F.round(mean(F.sum("days"), F.sum("timed")), 1).alias("avg_delivery_days"),
        F.round(percentage(F.sum("late"), F.sum("lines")), 2).alias("late_pct"),
        F.round(mean(F.sum("score"), F.sum("scored")), 2).alias("avg_review_score"),
    )
    keyed = scores.filter(F.col("line_items") >= min_lines).withColumn("seller_sk", surrogate_key("seller_id"))
    described = sellers.select("seller_sk", "seller_id", "seller_city", "seller_state")
    return described.join(keyed.drop("seller_id"), "seller_sk").select(
        *described.columns, "line_items", "orders", "distinct_products", "gmv", "avg_item_price",
        "avg_delivery_days", "late_pct", "avg_review_score",
    )


def monthly_revenue(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Per month: volume, revenue, share of lines bought by repeat customers, order value."""
    month = month_label(F.col("order_purchase_timestamp")).alias("year_month")
    orders = line_rollup(lines, "customer_sk", month).withColumn("first", _first_of("order_id", "year_month"))
    people = (
        orders.join(customers.select("customer_sk", "is_repeat_customer"), "customer_sk", "left")
        .groupBy("customer_sk", "year_month", "is_repeat_customer")
        .agg(*[F.sum(c).alias(c) for c in ("lines", "gross", "price", "freight", "first")])
    )
    repeat_lines = F.sum(F.when(F.col("is_repeat_customer"), F.col("lines")).otherwise(0))
    totals = people.groupBy("year_month").agg(
        F.sum("first").alias("orders"),
        F.count("customer_sk").alias("customers"),
        F.sum("lines").alias("line_items"),
        _money(F.sum("gross")).alias("gmv"),
        _money(F.sum("price")).alias("product_revenue"),
        _money(F.sum("freight")).alias("freight_revenue"),
        F.round(percentage(repeat_lines, F.sum("lines")), 2).alias("repeat_customer_pct"),
    )
    order_value = F.round(F.col("gmv") / F.col("orders"), 2).cast("decimal(23,2)")
    return totals.withColumn("avg_order_value", order_value)
