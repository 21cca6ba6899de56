"""Every data set, report and operator as a query over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.contracts import GRAINS, SILVER_FIELDS
from tidelake.functions.keys import surrogate_key
from tidelake.functions.text import normalise_city
from tidelake.operators.asof import asof_join
from tidelake.operators.conform import MALFORMED, conform, split_malformed
from tidelake.operators.integrity import Relation, grain_report, orphan_report, union_all
from tidelake.operators.layout import optimise
from tidelake.operators.scd2 import changed_keys, history, sequence_ties
from tidelake.plans import analytics, awkward, dq, security
from tidelake.plans.awkward import as_text
from tidelake.plans.gold import calendar_days
from tidelake.plans.lake import Lake
from tidelake.session import scratch_folder, tune
from tidelake.sources.commits import CommittedTable
from tidelake.sources.driver_tables import CALENDAR, FIRST_BATCH, SECOND_BATCH, DriverTables
from tidelake.sources.eventlog import EventLog
from tidelake.sources.inference import InferredSchema
from tidelake.sources.landing import SOURCES
from tidelake.sources.tables import Tables
from tidelake.streaming.bronze import ingest, ingest_by_position, read_bronze
from tidelake.streaming.history import HistoryTable
from tidelake.streaming.silver import refresh

Query = Callable[[SparkSession, str], DataFrame]
REGION = ("NATION_3", "NATION_7")
RELATIONS = (
    Relation("lines without order", "sv_order_items", "order_id", "sv_orders", "order_id"),
    Relation("lines without customer", "fct_order_items", "customer_sk", "dim_customer", "customer_sk"),
    Relation("lines without seller", "fct_order_items", "seller_sk", "dim_seller", "seller_sk"),
    Relation("lines without product", "fct_order_items", "product_sk", "dim_product", "product_sk"),
    Relation("lines without date", "fct_order_items", "order_date_key", "dim_date", "date_key"),
    Relation("lines without status", "fct_order_items", "order_status", "dim_order_status", "order_status"),
    Relation("payments without order", "sv_payments", "order_id", "sv_orders", "order_id"),
    Relation("reviews without order", "sv_reviews", "order_id", "sv_orders", "order_id"),
    Relation("customers without place", "sv_customers", "zip_code_prefix", "sv_geolocation", "zip_code_prefix"),
    Relation("sellers without place", "dim_seller", "zip_code_prefix", "sv_geolocation", "zip_code_prefix"),
)


def driver_lake(
    spark: SparkSession, folder: str, number_lines: bool = False, fanout_safe: bool = False
) -> Lake:
    """The lake over the driver tables. Only line-level tables need lines numbered."""
    return Lake(
        tune(spark),
        DriverTables(spark, folder, number_lines),
        calendar=CALENDAR,
        min_seller_lines=600,
        fanout_safe=fanout_safe,
    )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which the SQL side returns them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _placed(df: DataFrame) -> DataFrame:
    """Centroids to six places: sums of doubles depend on their order. The shift keeps exact halves,
    which means of few points have, clear of that."""
    coordinates = [c for c in df.columns if c.endswith(("latitude", "longitude"))]
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in coordinates})


def _table(name: str, number_lines: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return plain(_placed(driver_lake(spark, folder, number_lines)[name]))

    return query


def _report(build: Callable[..., DataFrame], *tables: str, **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        lake = driver_lake(spark, folder)
        return plain(build(*[lake[t] for t in tables], **options))

    return query


def _widget(build: Callable[..., DataFrame], tables: tuple[str, ...], *spec, **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        lake = driver_lake(spark, folder)
        return plain(analytics.widget(build(*[lake[t] for t in tables]), *spec, **options))

    return query


def _recorded_lake(spark: SparkSession, folder: str) -> tuple[Lake, EventLog]:
    """Every data set with rules stored once, with its counts in an event log."""
    work = scratch_folder(spark, "recorded")
    log = EventLog(spark, f"{work}/log")
    return dq.recorded(driver_lake(spark, folder, number_lines=True), log, work, undated=CALENDAR[1][:8] + "01"), log


def _expectation_report(spark: SparkSession, folder: str) -> DataFrame:
    _, log = _recorded_lake(spark, folder)
    report = dq.expectation_report({layer: lambda layer=layer: log.read(layer) for layer in ("silver", "gold")})
    seen = F.convert_timezone(None, F.lit("UTC"), F.col("last_seen").cast("timestamp_ntz"))
    return report.withColumn("last_seen", seen)


def _quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return plain(analytics.quality_summary(_expectation_report(spark, folder)))


def _grains(spark: SparkSession, folder: str) -> DataFrame:
    lake = driver_lake(spark, folder, number_lines=True)
    return union_all([grain_report(lake[name], name, keys) for name, keys in GRAINS.items()])


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(RELATIONS, driver_lake(spark, folder).__getitem__)


def _asof_seller(spark: SparkSession, folder: str) -> DataFrame:
    lake = driver_lake(spark, folder, number_lines=True)
    # the ids that a line's key is made of are a quarter of it, and move in its place
    lines = lake["fct_order_items"].select("order_id", "order_item_id", "seller_id", "order_purchase_timestamp")
    joined = asof_join(
        lines, lake["sv_sellers_history"], "seller_id", "order_purchase_timestamp",
        ["seller_city", "seller_state"],
    )
    found = joined.withColumn("order_item_sk", surrogate_key("order_id", "order_item_id"))
    return found.select("order_item_sk", "seller_id", "seller_city", "seller_state", "version_start")


def _order_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The date dimension over the days that orders span."""
    orders = driver_lake(spark, folder)["sv_orders"]
    placed = F.to_date("order_purchase_timestamp")
    return calendar_days(orders.agg(F.min(placed).alias("first"), F.max(placed).alias("last")))


def _event_status(spark: SparkSession, folder: str) -> DataFrame:
    log = DriverTables(tune(spark), folder).table("events").select("user_id", "event_type", "ts")
    return history(log, ["user_id"], "ts")


def _sequence_ties(spark: SparkSession, folder: str) -> DataFrame:
    return sequence_ties(
        DriverTables(tune(spark), folder)["br_customers"], ["customer_unique_id"], "_ingested_at"
    )


def _cities(spark: SparkSession, folder: str) -> DataFrame:
    """Customer cities dressed up in the spellings the clean-up has to undo."""
    customers = DriverTables(tune(spark), folder)["br_customers"]
    turn = F.expr("cast(substr(customer_id, 2) as bigint) % 6")
    city, state = F.col("customer_city"), F.col("customer_state")
    spelled = (
        F.when(turn == 0, F.concat(F.lit(" Sao  "), city, F.lit(" SP ")))
        .when(turn == 1, F.concat(city, F.lit(" - sp")))
        .when(turn == 2, F.concat(city, F.lit("/"), state))
        .when(turn == 3, F.concat(F.lit("/"), city))
        .when(turn == 4, F.lit("Porto to"))
    )
    named = customers.select("customer_id", spelled.alias("city"))
    return named.withColumn("clean", normalise_city(F.col("city")))


def _csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """All orders written as CSV, landed by the incremental ingest and read back from bronze."""
    tables = DriverTables(tune(spark), folder)
    work, source = scratch_folder(spark, "csv-ingest"), SOURCES["orders"]
    orders = as_text(tables["br_orders"].select(*source.columns))
    orders.write.option("header", True).csv(f"{work}/landing/orders")
    for _ in range(2):  # the second run finds nothing new
        ingest(
            spark, f"{work}/landing", source, f"{work}/bronze", f"{work}/checkpoint"
        ).awaitTermination()
    return read_bronze(spark, source, f"{work}/bronze").drop("_ingested_at", "_source_file")


def _csv_awkward_files(spark: SparkSession, folder: str) -> DataFrame:
    """Sellers in files that an ingest easily loses: a blank line before the header and no usual
    suffix, compressed, rows cut short, an extra column twice, and a file with a header only."""
    tables = DriverTables(tune(spark), folder)
    work, source = scratch_folder(spark, "csv-awkward"), SOURCES["sellers"]
    target = f"{work}/landing/sellers"
    sellers = as_text(tables["br_sellers"].select(*source.columns))
    number = F.col("seller_id").cast("long") % 4
    header = ",".join(source.columns)

    def under(head):
        def lines(batches):
            started = False
            for batch in batches:
                if not started and len(batch):
                    started = True
                    yield batch.iloc[:1].assign(value=head)
                yield batch

        return lines

    lines = F.to_csv(F.struct(*source.columns), {"escape": '"'}).alias("value")
    blank = sellers.filter(number == 0).select(lines)
    blank.mapInPandas(under(f"\n \n{header}"), "value string").write.text(f"{target}/blank")
    sellers.filter(number == 1).write.options(header=True, escape='"', compression="gzip").csv(f"{target}/zipped")
    short = sellers.filter(number == 2).select(F.col("seller_id").alias("value"))
    short.mapInPandas(under(header), "value string").write.text(f"{target}/short")
    twice = sellers.filter(number == 3).selectExpr("*", "seller_city AS note", "seller_state AS Note2")
    twice.toDF(*source.columns, "note", "note").write.options(header=True, escape='"').csv(f"{target}/twice")
    sellers.limit(0).write.options(header=True).csv(f"{target}/empty")
    ingest(spark, f"{work}/landing", source, f"{work}/bronze", f"{work}/checkpoint").awaitTermination()
    return read_bronze(spark, source, f"{work}/bronze").select(*source.columns, "_rescued_data")


def _csv_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Seller files in three shapes: as declared, reordered with an extra column, one missing."""
    tables = DriverTables(tune(spark), folder)
    work, source = scratch_folder(spark, "csv-drift"), SOURCES["sellers"]
    sellers = as_text(tables["br_sellers"].select(*source.columns))
    number = F.col("seller_id").cast("long")
    shapes = {
        0: sellers,
        1: sellers.select(
            "seller_state", (number % 5).cast("string").alias("seller_rating"), "seller_city",
            "seller_id", "seller_zip_code_prefix",
        ),
        2: sellers.drop("seller_city"),
    }
    for rest, shaped in shapes.items():
        part = shaped.filter(number % 3 == rest)
        part.write.option("header", True).csv(f"{work}/landing/sellers/shape-{rest}")
    ingest(
        spark, f"{work}/landing", source, f"{work}/bronze", f"{work}/checkpoint"
    ).awaitTermination()
    return read_bronze(spark, source, f"{work}/bronze").drop(
        "_ingested_at", "_source_file", "_source_system"
    )


def _csv_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with line breaks and quotes in their text through the positional file stream."""
    tables = DriverTables(tune(spark), folder)
    work, source = scratch_folder(spark, "csv-reviews"), SOURCES["reviews"]
    text = F.concat(F.col("review_comment_message"), F.lit(',\n"second line"'))
    reviews = as_text(tables["br_reviews"].select(*source.columns))
    spread = reviews.withColumn("review_comment_message", text)
    spread.write.options(header=True, quoteAll=True, escape='"').csv(f"{work}/landing/reviews")
    ingest_by_position(
        spark, f"{work}/landing", source, f"{work}/bronze", f"{work}/checkpoint"
    ).awaitTermination()
    stored = read_bronze(spark, source, f"{work}/bronze")
    return stored.select("review_id", "order_id", "review_score", "review_comment_message")


def _csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Payments landed three times, each time with wider values; the types that hold after each landing, and the rows under them."""
    payments = as_text(DriverTables(tune(spark), folder)["br_payments"])
    work, source = scratch_folder(spark, "csv-inferred"), SOURCES["payments"]
    number = F.regexp_replace("order_id", "^x", "").cast("bigint")
    landing = F.when(F.col("order_id").startswith("x"), F.lit(2)).otherwise(number % 3)
    value = F.when(landing == 0, F.col("payment_value").cast("double").cast("bigint").cast("string")).when(
        (landing == 2) & (number % 5 == 0), F.lit("n/a")
    ).otherwise(F.col("payment_value"))
    shaped = payments.withColumns({"landing": landing, "payment_value": value})
    schema = InferredSchema(spark, f"{work}/schema", source.columns)
    found = []
    for part in range(3):
        shaped.filter(F.col("landing") == part).select(*source.columns).write.option("header", True).csv(f"{work}/landing/payments/{part}")
        ingest(
            spark, f"{work}/landing", source, f"{work}/bronze", f"{work}/checkpoint", learn=schema.learn
        ).awaitTermination()
        typed = schema.typed(read_bronze(spark, source, f"{work}/bronze"))
        types = {f.name: f.dataType.simpleString() for f in typed.schema}
        found.append(typed.agg(F.count("*").alias("rows")).select(
            F.lit(part).alias("landing"), F.inline(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("type")) for c in source.columns
            ])), "rows",
        ))
    return union_all(found)


def _malformed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with unreadable dates, set aside with the names of the columns at fault."""
    tables = DriverTables(tune(spark), folder)
    text = as_text(tables["br_orders"])
    key = F.expr("cast(order_id as bigint)")
    spoiled = text.withColumns(
        {
            "order_purchase_timestamp": F.when(key % 50 == 3, F.lit("soon")).otherwise(
                F.col("order_purchase_timestamp")
            ),
            "order_approved_at": F.when(key % 30 == 3, F.lit("1998-13-45")).otherwise(
                F.col("order_approved_at")
            ),
        }
    )
    _, rejected = split_malformed(conform(spoiled, SILVER_FIELDS["sv_orders"], tolerant=True))
    return rejected.select("order_id", F.array_join(MALFORMED, ",").alias("malformed"))


def _newest_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every ninth order delivered again a day later as canceled; the newer one counts."""
    tables = DriverTables(tune(spark), folder)
    first = tables["br_orders"]
    again = first.filter(F.expr("cast(order_id as bigint) % 9 = 0")).withColumns(
        {
            "order_status": F.lit("canceled"),
            "_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    lake = Lake(spark, {"br_orders": first.unionByName(again)}, newest_orders_only=True)
    return lake["sv_orders"]


def _incremental_history(spark: SparkSession, folder: str) -> DataFrame:
    """Product changes applied as streamed batches, the later one first."""
    tables = DriverTables(tune(spark), folder)
    work = scratch_folder(spark, "history")
    log = tables["br_products"].drop("_source_file", "_source_system")
    table = HistoryTable(spark, work, ["product_id"], "_ingested_at")
    for day in (SECOND_BATCH, FIRST_BATCH):
        batch = log.filter(F.col("_ingested_at") == F.lit(day).cast("timestamp_ntz"))
        batch.write.mode("append").parquet(f"{work}/changes")
        feed = spark.readStream.schema(log.schema).parquet(f"{work}/changes")
        table.follow(feed, f"{work}/checkpoint").awaitTermination()
    return table.read()


def _three_batches(spark: SparkSession, folder: str) -> DataFrame:
    """User status from events in three batches by time: in order, reversed, and with the middle one delivered twice."""
    events = DriverTables(tune(spark), folder).table("events").select("user_id", "event_type", "ts")
    clock = F.col("ts").cast("timestamp").cast("double")
    first, last = events.agg(F.min(clock), F.max(clock)).first()
    third = F.least(F.floor((clock - first) * 3 / (last - first)), F.lit(2))

    def arranged(arrangement: str, order: tuple[int, ...]) -> DataFrame:
        table = HistoryTable(spark, scratch_folder(spark, "batches"), ["user_id"], "ts", base_every=2)
        for number, part in enumerate(order):
            batch = events.filter(third == part)
            table.apply(batch, number)
            table.apply(batch, number)  # a replay
        return table.read().select(F.lit(arrangement).alias("arrangement"), "*")

    # three tables that share nothing, so one's short stages fill the gaps of another's
    arrangements = {"in order": (0, 1, 2), "reversed": (2, 1, 0), "delivered twice": (0, 1, 1, 2)}
    with ThreadPoolExecutor(len(arrangements)) as pool:
        return union_all(list(pool.map(arranged, *zip(*arrangements.items()))))


def _hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """User status where a third of all events are one user's, cut into segments."""
    events = DriverTables(tune(spark), folder).table("events")
    user = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return history(events.select(user.alias("user_id"), "event_type", "ts"), ["user_id"], "ts", max_rows=500)


def _spoiled_orders(tables: DriverTables) -> DataFrame:
    """Text orders of which some break each rule that drops rows."""
    key = F.expr("cast(order_id as bigint)")
    status = F.when(key % 90 == 7, F.lit("mystery")).when(key % 95 != 9, F.col("order_status"))
    return as_text(tables["br_orders"]).withColumns(
        {
            "_key": key,
            "customer_id": F.when(key % 70 != 5, F.col("customer_id")),
            "order_status": status,
            "order_id": F.when(key % 110 != 1, F.col("order_id")),
            "_ingested_at": F.col("_ingested_at").cast("timestamp"),
            "_rescued_data": F.lit(None).cast("string"),
        }
    )


def _refreshed_twice(spark: SparkSession, folder: str) -> str:
    """Spoiled orders committed to bronze as two batches, silver refreshed after each; the silver folder."""
    work, source = scratch_folder(spark, "silver-counts"), SOURCES["orders"]
    orders = _spoiled_orders(DriverTables(tune(spark), folder))
    bronze = CommittedTable(spark, f"{work}/bronze/br_orders")
    columns = [f.name for f in T.StructType.fromDDL(source.bronze_schema).fields]
    for number in range(2):
        bronze.append(orders.filter(F.col("_key") % 2 == number).select(*columns), number)
        refresh(spark, "sv_orders", f"{work}/bronze", f"{work}/silver", f"{work}/checkpoint").awaitTermination()
    return f"{work}/silver"


def _stream_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Expectation counts of a silver stream over two runs, as its manifests hold them."""
    counted = CommittedTable(spark, _refreshed_twice(spark, folder)).counts()
    rule, outcome = F.split_part("counter", F.lit("__"), F.lit(1)), F.split_part("counter", F.lit("__"), F.lit(2))
    return counted.groupBy(rule.alias("expectation")).agg(
        F.sum(F.when(outcome == "passed", F.col("n"))).alias("passed"),
        F.sum(F.when(outcome == "failed", F.col("n"))).alias("failed"),
    )


def _stream_spoiled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What the drop rules leave of the spoiled orders."""
    return CommittedTable(spark, _refreshed_twice(spark, folder)).read().select("order_id", "customer_id", "order_status")


def _streamed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders through bronze text columns and the streaming silver transform."""
    tables = DriverTables(tune(spark), folder)
    work, source = scratch_folder(spark, "silver-stream"), SOURCES["orders"]
    audit = ("_ingested_at", "_source_file", "_source_system")
    rows = tables["br_orders"].select(
        *[F.col(c).cast("string").alias(c) for c in source.columns],
        F.lit(None).cast("string").alias("_rescued_data"),
        F.col("_ingested_at").cast("timestamp"), *audit[1:],
    )
    rows.write.parquet(f"{work}/bronze/br_orders")
    refresh(
        spark, "sv_orders", f"{work}/bronze", f"{work}/silver", f"{work}/checkpoint"
    ).awaitTermination()
    stored = CommittedTable(spark, f"{work}/silver").read().drop("_source_file")
    return stored.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in stored.schema.fields
        ]
    )


LAYOUT_TABLES = ("fct_order_items", "fct_payments", "fct_reviews")


def _layout(spark: SparkSession, folder: str) -> DataFrame:
    """The three fact tables published, rewritten by their clustering columns and analysed, in a
    namespace of their own; with the rows of each table after the step."""
    lake = driver_lake(spark, folder, number_lines=True)
    root = scratch_folder(spark, "layout")
    tables = Tables(spark, root, f"layout_{uuid.uuid4().hex}")
    for name in LAYOUT_TABLES:
        tables.publish("gold", name, lake[name])
    replace = partial(tables.replace, "gold", keep_previous=False)  # nobody else reads this namespace
    steps = optimise(spark, replace, layer=tables.schema("gold")).collect()
    rows = {name: tables.read("gold", name).count() for name in LAYOUT_TABLES}
    tables.drop()
    named = [(s.table.split(".")[1], s.step, s.status, rows[s.table.split(".")[1]]) for s in steps]
    return spark.createDataFrame(named, "table string, step string, status string, rows bigint")


def _over_lake(build: Callable[[SparkSession, str, Lake], DataFrame], number_lines: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return build(spark, folder, driver_lake(spark, folder, number_lines))

    return query


def _regional(spark: SparkSession, folder: str) -> DataFrame:
    lake = driver_lake(spark, folder)
    return _placed(security.customer_regional(lake["dim_customer"], REGION))


def _fanout_safe(spark: SparkSession, folder: str) -> DataFrame:
    return plain(driver_lake(spark, folder, fanout_safe=True)["mart_delivery_performance"])


_LINES_AND_REVIEWS = ("fct_order_items", "fct_reviews")
_LINES_AND_CUSTOMERS = ("fct_order_items", "dim_customer")

QUERIES: dict[str, Query] = {
    **{
        name: _table(name)
        for name in (
            "sv_orders", "sv_payments", "sv_reviews", "sv_quarantine_orders", "sv_customer_keys",
            "sv_customers", "sv_category_translation", "sv_geolocation", "sv_sellers_history",
            "sv_products_history", "dim_seller", "dim_product", "dim_customer",
            "bridge_customer_order", "fct_payments", "fct_reviews", "mart_delivery_performance",
            "mart_seller_scorecard", "mart_monthly_revenue", "v_dim_customer_secure",
            "v_fct_reviews_secure",
        )
    },
    "sv_order_items": _table("sv_order_items", number_lines=True),
    "fct_order_items": _table("fct_order_items", number_lines=True),
    "dim_date": _order_calendar,
    "q01_monthly_report": _report(analytics.monthly_report, "mart_monthly_revenue"),
    "q02_seller_states": _report(analytics.seller_states, "mart_seller_scorecard"),
    "q03_worst_sellers": _report(analytics.worst_sellers, "mart_seller_scorecard"),
    "q04_reviews_by_lateness": _report(analytics.reviews_by_lateness, "fct_reviews"),
    "q05_score_by_delay": _report(analytics.score_by_delay, *_LINES_AND_REVIEWS),
    "q06_category_changes": _report(analytics.category_changes, "sv_products_history"),
    "q07_quality_summary": _quality_summary,
    "q08_revenue_by_state": _report(analytics.revenue_by_state, *_LINES_AND_CUSTOMERS),
    "q09_gmv_total": _report(analytics.gmv_total, "fct_order_items"),
    "q10_ontime_rate": _report(analytics.ontime_rate, "fct_order_items"),
    "q11_monthly_tile": _report(analytics.monthly_tile, "mart_monthly_revenue"),
    "q12_delay_versus_score": _report(analytics.delay_versus_score, *_LINES_AND_REVIEWS),
    "q13_revenue_by_state_tile": _report(analytics.revenue_by_state, *_LINES_AND_CUSTOMERS),
    "q14_seller_tile": _report(analytics.seller_tile, "mart_seller_scorecard"),
    "q15_widget_total_gmv": _widget(
        analytics.gmv_total, ("fct_order_items",), [], {"sum(total_gmv)": "total_gmv"}
    ),
    "q15_widget_ontime": _widget(
        analytics.ontime_rate, ("fct_order_items",), [], {"sum(ontime_pct)": "ontime_pct"}
    ),
    "q15_widget_monthly_gmv": _widget(
        analytics.monthly_tile, ("mart_monthly_revenue",), ["year_month"], {"sum(gmv)": "gmv"}
    ),
    "q15_widget_score_by_delay": _widget(
        analytics.delay_versus_score, _LINES_AND_REVIEWS, ["delay_bucket"],
        {"sum(avg_score)": "avg_score"},
    ),
    "q15_widget_state_gmv": _widget(
        analytics.revenue_by_state, _LINES_AND_CUSTOMERS, ["customer_state"],
        {"sum(gmv)": "gmv"}, largest_first="sum(gmv)",
    ),
    "q15_widget_seller_table": _report(
        lambda scorecard: analytics.resorted(
            analytics.seller_tile(scorecard), "avg_delivery_days", "avg_review_score"
        ),
        "mart_seller_scorecard",
    ),
    "q16_star_report": _report(
        analytics.star_report,
        "fct_order_items", "dim_customer", "dim_seller", "dim_product", "dim_date",
    ),
    "q17_control_totals": _report(
        analytics.control_totals, "fct_order_items", "dim_customer", "sv_sellers_history"
    ),
    "dq_expectation_report": _expectation_report,
    "grain_report": _grains,
    "orphan_keys": _orphans,
    "asof_seller": _asof_seller,
    "scd2_event_status": _event_status,
    "scd2_changed_keys": _report(
        lambda versions: changed_keys(versions, "seller_id"), "sv_sellers_history"
    ),
    "scd2_sequence_ties": _sequence_ties,
    "scd2_incremental": _incremental_history,
    "scd2_three_batches": _three_batches,
    "scd2_hot_key": _hot_key,
    "normalise_city": _cities,
    "v_dim_customer_regional": _regional,
    "review_text_masked": _report(security.review_text_masked, "sv_reviews"),
    "mart_delivery_fanout_safe": _fanout_safe,
    "csv_ingest": _csv_ingest,
    "csv_drift": _csv_drift,
    "csv_inferred": _csv_inferred,
    "csv_awkward_files": _csv_awkward_files,
    "csv_reviews": _csv_reviews,
    "malformed_orders": _malformed_orders,
    "newest_orders": _newest_orders,
    "stream_silver_orders": _streamed_orders,
    "stream_rule_counts": _stream_rule_counts,
    "stream_spoiled_orders": _stream_spoiled_orders,
    "layout_report": _layout,
    **{f.__name__: f for f in (
        awkward.csv_all_sources, awkward.csv_audit, awkward.landing_gate, awkward.null_keys, awkward.stream_quarantine, awkward.asof_hot_key,
    )},
    **{f.__name__: _over_lake(f, True) for f in (awkward.drop_rules, awkward.fail_rules, awkward.layout_skipping)},
    **{f.__name__: _over_lake(f, False) for f in (awkward.report_order, awkward.sql_views)},
}
