"""Business questions, dashboard tiles and control totals over the gold layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.bands import delay_bucket
from tidelake.functions.flags import mean
from tidelake.functions.keys import packed_key
from tidelake.operators.scd2 import END, START, changed_keys
from tidelake.plans.marts import MONEY, line_rollup, review_totals


def _mean_of_rounded(column: str, digits: int) -> Column:
    """Unweighted mean of already rounded doubles, taken in decimal so that it is exact."""
    exact = F.col(column).cast(f"decimal(18,{digits})")
    return F.round(F.avg(exact), digits).cast("double").alias(column)


def _share(predicate: str, when_true: str = "1.0", when_false: str = "0.0") -> Column:
    """Percentage of rows with one decimal, in decimal arithmetic."""
    return F.expr(
        f"round(100.0 * avg(CASE WHEN {predicate} THEN {when_true} ELSE {when_false} END), 1)"
    )


def monthly_report(mart: DataFrame, min_orders: int = 100) -> DataFrame:
    """Months with enough orders, in order."""
    wanted = ("year_month", "orders", "customers", "gmv", "avg_order_value", "repeat_customer_pct")
    return mart.filter(F.col("orders") > min_orders).select(*wanted).orderBy("year_month")


def monthly_tile(mart: DataFrame, min_orders: int = 100) -> DataFrame:
    return monthly_report(mart, min_orders).drop("customers")


def seller_states(scorecard: DataFrame, min_lines: int = 100) -> DataFrame:
    """States by lateness of their sellers: every seller weighs the same."""
    states = scorecard.groupBy("seller_state").agg(
        F.count_distinct("seller_id").alias("sellers"),
        F.sum("line_items").alias("line_items"),
        F.round(F.sum("gmv"), 2).cast(MONEY).alias("gmv"),
        _mean_of_rounded("avg_delivery_days", 1),
        _mean_of_rounded("late_pct", 2),
        _mean_of_rounded("avg_review_score", 2),
    )
    return states.filter(F.col("line_items") >= min_lines).orderBy(
        F.col("late_pct").desc(), "seller_state"
    )


def worst_sellers(scorecard: DataFrame, min_lines: int = 100, top: int = 20) -> DataFrame:
    """The latest-delivering sellers among those with enough lines; ties go by seller id."""
    return (
        scorecard.filter(F.col("line_items") >= min_lines)
        .select(
            "seller_id", "seller_city", "seller_state", "line_items", "orders", "gmv",
            "avg_delivery_days", "late_pct", "avg_review_score",
        )
        .orderBy(F.col("late_pct").desc(), "seller_id")
        .limit(top)
    )


def seller_tile(scorecard: DataFrame, min_lines: int = 100, top: int = 20) -> DataFrame:
    return worst_sellers(scorecard, min_lines, top).drop("orders")


def reviews_by_lateness(reviews: DataFrame) -> DataFrame:
    """Scores of late and punctual orders; undelivered orders are left out."""
    known = reviews.filter("is_late_delivery IS NOT NULL")
    status = F.when(F.col("is_late_delivery"), F.lit("Late")).otherwise(F.lit("On time"))
    return known.groupBy(status.alias("delivery_status")).agg(
        F.count("*").alias("reviews"),
        F.round(F.avg("review_score"), 2).alias("avg_score"),
        _share("is_negative").alias("pct_1_or_2_star"),
        _share("is_positive").alias("pct_4_or_5_star"),
    )


def delay_versus_score(lines: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean score by severity of delay over line and review pairs, with the sort key."""
    orders = line_rollup(
        lines.filter("delivery_delay_days IS NOT NULL"), "delivery_delay_days"
    ).join(review_totals(reviews), "order_id")
    return (
        orders.withColumn("delay_bucket", delay_bucket())
        .groupBy("delay_bucket")
        .agg(
            F.min("delivery_delay_days").alias("sort_key"),
            F.count_distinct("order_id").alias("orders"),
            F.round(
                mean(
                    F.sum(F.col("score") * F.col("lines")), F.sum(F.col("scored") * F.col("lines"))
                ),
                2,
            ).alias("avg_score"),
        )
        .orderBy("sort_key")
    )


def score_by_delay(lines: DataFrame, reviews: DataFrame) -> DataFrame:
    """The same without the sort key, still in its order."""
    return delay_versus_score(lines, reviews).drop("sort_key")


def category_changes(versions: DataFrame, limit: int = 40) -> DataFrame:
    """Versions of products that changed, oldest first."""
    status = F.when(F.col(END).isNull(), F.lit("current")).otherwise(F.lit("superseded"))
    return (
        changed_keys(versions, "product_id")
        .select(
            "product_id",
            "product_category_name",
            F.col(START).alias("valid_from"),
            F.col(END).alias("valid_to"),
            status.alias("version_status"),
        )
        .orderBy("product_id", "valid_from")
        .limit(limit)
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """Failure rate per expectation, most failures first."""
    checked = F.col("total_passed") + F.col("total_failed")
    rate = F.expr("100.0 * total_failed") / F.nullif(checked, F.lit(0))
    return report.select(
        "layer", "dataset", "expectation", "total_passed", "total_failed",
        F.round(rate, 3).alias("failure_pct"),
    ).orderBy(F.col("total_failed").desc(), "layer", "dataset", "expectation")


def revenue_by_state(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, revenue and delivery time by customer state, richest first."""
    states = customers.select("customer_sk", "customer_state")
    return (
        line_rollup(lines, "customer_sk")
        .join(states, "customer_sk")
        .groupBy("customer_state")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.round(F.sum("gross"), 2).cast(MONEY).alias("gmv"),
            F.round(mean(F.sum("days"), F.sum("timed")), 1).alias("avg_delivery_days"),
        )
        .orderBy(F.col("gmv").desc(), "customer_state")
    )


def gmv_total(lines: DataFrame) -> DataFrame:
    return lines.agg(F.round(F.sum("gross_revenue"), 2).cast(MONEY).alias("total_gmv"))


def ontime_rate(lines: DataFrame) -> DataFrame:
    """Share of delivered lines that were not late."""
    known = lines.filter("is_late_delivery IS NOT NULL")
    return known.agg(_share("is_late_delivery", "0.0", "1.0").alias("ontime_pct"))


def widget(
    tile: DataFrame, by: Sequence[str], measures: Mapping[str, str], largest_first: str | None = None
) -> DataFrame:
    """A chart's roll-up of a tile: sums of measures by dimensions, optionally sorted."""
    totals = [F.sum(column).alias(name) for name, column in measures.items()]
    rolled = tile.groupBy(*by).agg(*totals) if by else tile.agg(*totals)
    return rolled.orderBy(F.col(largest_first).desc(), *by) if largest_first else rolled


def resorted(tile: DataFrame, *columns: str) -> DataFrame:
    """A table widget's own order over a tile that is already limited."""
    return tile.orderBy(*columns)


def star_report(
    lines: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Lines by customer state, seller state, category and month; no line is lost.

    No broadcast is forced: dimensions grow with the business, and Spark picks each join by the
    size it finds. Small dimensions then cost no shuffle of lines at all. A line that meets three large dimensions is
    little else than keys: they move as bytes or, where both sides have the id that a key is the digest of, as that id, and
    the one that has no id goes first.
    """
    days = dates.select(F.col("date_key").alias("order_date_key"), "year_month")

    dimensions = (
        ("customer_sk", "customer_unique_id", customers, "customer_state"),
        ("product_sk", "product_id", products, "category_en"),
        ("seller_sk", "seller_id", sellers, "seller_state"),
    )
    keys = {
        key: F.col(natural) if natural in lines.columns and natural in df.columns else packed_key(key)
        for key, natural, df, _ in dimensions
    }
    described = lines.select(*[of.alias(key) for key, of in keys.items()], "order_date_key", "gross_revenue", "delivery_days")
    described = described.join(days, "order_date_key", "left").drop("order_date_key")
    for key, _, df, label in dimensions:
        described = described.join(df.select(keys[key].alias(key), label), key, "left").drop(key)
    return described.groupBy("customer_state", "seller_state", "category_en", "year_month").agg(
        F.count("*").alias("line_items"),
        F.round(F.sum("gross_revenue"), 2).cast(MONEY).alias("gmv"),
        F.round(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
    )


def control_totals(
    lines: DataFrame, customers: DataFrame, seller_versions: DataFrame
) -> DataFrame:
    """One row: revenue, lines, persons, repeat persons, current and all seller versions."""
    revenue = lines.agg(
        F.round(F.sum("gross_revenue"), 2).cast(MONEY).alias("gmv"),
        F.count("*").alias("line_items"),
    )
    people = customers.agg(
        F.count("*").alias("persons"), F.count_if("is_repeat_customer").alias("repeat_persons")
    )
    sellers = seller_versions.agg(
        F.count_if(F.col(END).isNull()).alias("current_sellers"),
        F.count("*").alias("seller_versions"),
    )
    parts = (revenue, people, sellers)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
