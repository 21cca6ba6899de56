"""Queries over rows that break rules, files that are odd, and orders that matter."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.functions.masks import define
from tidelake.operators.asof import asof_join
from tidelake.operators.expectations import drop_failing, guard, rules_for
from tidelake.operators.integrity import union_all
from tidelake.operators.layout import cluster, files_touched
from tidelake.operators.scd2 import history
from tidelake.plans import analytics, silver
from tidelake.plans.lake import Lake
from tidelake.session import scratch_folder, tune
from tidelake.sources.commits import CommittedTable
from tidelake.sources.driver_tables import DriverTables
from tidelake.sources.landing import SOURCES, landing_report
from tidelake.sources.tables import Tables
from tidelake.streaming.bronze import ingest, ingest_all, read_bronze
from tidelake.streaming.silver import refresh


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _digest(df: DataFrame, name: str) -> DataFrame:
    """Rows and a sum over the rows' digests, which neither order nor partitioning changes."""
    whole = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("~")) for c in df.columns])
    return df.agg(F.count("*").alias("rows"), F.sum(_number(F.md5(whole))).alias("digest")).select(F.lit(name).alias("source"), "*")


def _land(tables: DriverTables, folder: str) -> None:
    """All nine sources as CSV folders, written side by side."""

    def write(source) -> None:
        text = as_text(tables[f"br_{source.name}"].select(*source.columns))
        text.write.options(header=True, escape='"').csv(f"{folder}/{source.name}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, SOURCES.values()))


def csv_all_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All nine sources landed as CSV and ingested side by side: rows and digest of each bronze table."""
    work = scratch_folder(spark, "csv-all")
    _land(DriverTables(tune(spark), folder), f"{work}/landing")
    ingest_all(spark, f"{work}/landing", f"{work}/bronze", f"{work}/checkpoints")
    return union_all([
        _digest(read_bronze(spark, source, f"{work}/bronze/br_{name}").select(*source.columns), name) for name, source in SOURCES.items()
    ])


def csv_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audit columns of an ingest: every row has its time, its file and its system."""
    work, source = scratch_folder(spark, "csv-audit"), SOURCES["sellers"]
    sellers = as_text(DriverTables(tune(spark), folder)["br_sellers"].select(*source.columns))
    began = spark.range(1).select(F.current_timestamp()).first()[0]
    sellers.write.options(header=True, escape='"').csv(f"{work}/landing/sellers")
    ingest(spark, f"{work}/landing", source, f"{work}/bronze", f"{work}/checkpoint").awaitTermination()
    stored = read_bronze(spark, source, f"{work}/bronze")
    return stored.groupBy("_source_system").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("_source_file").contains(f"{work.rsplit('/', 1)[1]}/landing/sellers/part-")).alias("with_file"),
        F.count_if(F.col("_ingested_at") >= F.lit(began)).alias("with_time"),
    )


def landing_gate(spark: SparkSession, folder: str) -> DataFrame:
    """What the gate counts: files in nested folders, an empty folder, one without CSV files, one that is missing."""
    tables, work = DriverTables(tune(spark), folder), scratch_folder(spark, "landing-gate")
    orders = as_text(tables["br_orders"].select("order_id", "order_status"))
    for status, files in (("delivered", 3), ("shipped", 2)):
        part = orders.filter(F.col("order_status") == status).repartition(files)
        part.write.option("header", True).csv(f"{work}/orders/{status}")
    as_text(tables["br_sellers"].select("seller_id")).coalesce(1).write.text(f"{work}/sellers")
    return landing_report(spark, work, ("orders", "sellers", "products"))


def _spoiled(lake: Lake, name: str, column: str, every: int) -> DataFrame:
    """A data set before its rules, a column of it unknown in about one of ``every`` rows."""
    frame = lake.before_rules(name)
    hit = _number(F.md5(F.col(column).cast("string"))) % every == 0
    return frame.withColumn(column, F.when(~hit, F.col(column)))


DROPS = (
    ("sv_order_items", "order_id"), ("sv_order_items", "order_item_id"), ("sv_payments", "order_id"), ("sv_reviews", "review_id"),
    ("sv_reviews", "order_id"), ("sv_customer_keys", "customer_id"), ("sv_customer_keys", "customer_unique_id"),
)
FAILS = (
    ("dim_seller", "seller_id"), ("dim_product", "product_id"), ("dim_customer", "customer_unique_id"), ("fct_order_items", "order_item_sk"),
    ("fct_payments", "payment_sk"), ("fct_reviews", "review_sk"),
)


def drop_rules(spark: SparkSession, folder: str, lake: Lake) -> DataFrame:
    """Every rule that drops, on rows that break it: what is left of them, and how many of those have no key."""
    found = []
    for name, column in DROPS:
        kept = drop_failing(_spoiled(lake, name, column, 50), rules_for(name))
        found.append(kept.agg(F.count("*").alias("kept"), F.count_if(F.col(column).isNull()).alias("without")).select(
            F.lit(name).alias("dataset"), F.lit(column).alias("column_name"), "*"
        ))
    return union_all(found)


def fail_rules(spark: SparkSession, folder: str, lake: Lake) -> DataFrame:
    """Every rule that fails an update: a table with sound rows, then an update with broken ones, then what the table holds."""
    work = scratch_folder(spark, "fail-rules")
    tables = Tables(spark, work, f"fails_{uuid.uuid4().hex}")

    def attempt(target: tuple[str, str]) -> tuple[str, str, str, int]:
        name, column = target
        key = lake.before_rules(name).select(column)
        tables.publish("gold", name, key, [r for r in rules_for(name) if r.severity == "fail"])
        try:
            hit = _number(F.md5(F.col(column))) % 5 == 0
            stored = tables.read("gold", name)  # the sound rows, which need not be built again
            broken = guard(stored.withColumn(column, F.when(~hit, F.col(column))), rules_for(name)[:1], name)
            tables.replace("gold", name, broken)
            outcome = "stored"
        except PySparkException as error:
            outcome = "refused" if rules_for(name)[0].name in str(error) else "another error"
        return name, rules_for(name)[0].name, outcome, tables.read("gold", name).count()

    with ThreadPoolExecutor(len(FAILS)) as pool:
        rows = list(pool.map(attempt, FAILS))
    tables.drop()
    return spark.createDataFrame(rows, "dataset string, expectation string, outcome string, rows bigint")


def null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Data sets that leave out rows without a business key, on sources in which some keys are missing."""
    tables = DriverTables(tune(spark), folder)

    def holed(name: str, column: str) -> DataFrame:
        hit = _number(F.md5(F.col(column).cast("string"))) % 4 == 0
        return tables[name].withColumn(column, F.when(~hit, F.col(column)))

    built = {
        "sv_category_translation": silver.category_translation(holed("br_category_translation", "product_category_name")),
        "sv_geolocation": silver.geolocation(holed("br_geolocation", "geolocation_zip_code_prefix")),
        "sv_customers": silver.customers(holed("br_customers", "customer_unique_id")),
    }
    return union_all([df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n, df in built.items()])


def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Clean orders and quarantine as two streams of one feed: rows by table and reason."""
    work, source = scratch_folder(spark, "two-streams"), SOURCES["orders"]
    text = as_text(DriverTables(tune(spark), folder)["br_orders"]).withColumns(
        {"_ingested_at": F.col("_ingested_at").cast("timestamp"), "_rescued_data": F.lit(None).cast("string")}
    )
    names = [f.split(" ")[0].strip("`") for f in source.bronze_schema.split(", ")]
    CommittedTable(spark, f"{work}/bronze/br_orders").append(text.select(*names), 0)
    found = []
    for name in ("sv_orders", "sv_quarantine_orders"):
        refresh(spark, name, f"{work}/bronze", f"{work}/{name}", f"{work}/checkpoints/{name}").awaitTermination()
        stored = CommittedTable(spark, f"{work}/{name}").read()
        reason = F.col("_quarantine_reason") if "_quarantine_reason" in stored.columns else F.lit("clean")
        found.append(stored.groupBy(reason.alias("reason")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "*"))
    return union_all(found)


def _positions(report: DataFrame, name: str, key: str) -> DataFrame:
    """Rows of a small ordered report with their place in it."""
    placed = report.select(F.col(key).cast("string").alias("key"), F.monotonically_increasing_id().alias("at"))
    return placed.select(F.lit(name).alias("report"), F.row_number().over(W.orderBy("at")).alias("position"), "key")


def report_order(spark: SparkSession, folder: str, lake: Lake) -> DataFrame:
    """The order in which the reports and tiles come."""
    lines, reviews, people = lake["fct_order_items"], lake["fct_reviews"], lake["dim_customer"]
    scorecard = lake["mart_seller_scorecard"]
    by_state = analytics.revenue_by_state(lines, people)
    return union_all([
        _positions(analytics.monthly_report(lake["mart_monthly_revenue"]), "months", "year_month"),
        _positions(analytics.score_by_delay(lines, reviews), "delays", "delay_bucket"),
        _positions(by_state, "states", "customer_state"),
        _positions(analytics.widget(by_state, ["customer_state"], {"sum(gmv)": "gmv"}, largest_first="sum(gmv)"), "state tile", "customer_state"),
        _positions(analytics.worst_sellers(scorecard), "worst sellers", "seller_id"),
        _positions(analytics.resorted(analytics.seller_tile(scorecard), "avg_delivery_days", "avg_review_score", "seller_id"), "seller table", "seller_id"),
        _positions(analytics.category_changes(lake["sv_products_history"]).withColumn("key", F.concat_ws("@", "product_id", F.to_date("valid_from"))),
                   "changes", "key"),
    ])


def layout_skipping(spark: SparkSession, folder: str, lake: Lake) -> DataFrame:
    """Order lines laid out by time ranges alone and along a curve through time and seller: does a filter on either skip files?"""
    lines = lake["fct_order_items"].select("order_item_sk", "order_purchase_timestamp", "seller_id", "gross_revenue")
    work = scratch_folder(spark, "skipping")
    lines.write.parquet(f"{work}/plain")
    plain = spark.read.parquet(f"{work}/plain")
    found = []
    for layout, columns in (("ranges", ["order_purchase_timestamp"]), ("curve", ["order_purchase_timestamp", "seller_id"])):
        cluster(plain, columns, files=32).write.parquet(f"{work}/{layout}")
        stored = spark.read.parquet(f"{work}/{layout}")
        month = [F.lit(f"1996-{m}-01").cast(stored.schema["order_purchase_timestamp"].dataType) for m in ("03", "04")]
        for kind, column, least, most in (("month", "order_purchase_timestamp", *month), ("seller", "seller_id", F.lit("7"), F.lit("7"))):
            files = files_touched(stored, column, least, most).first()
            rows = stored.agg(F.count_if(F.col(column).between(least, most)).alias("rows"))
            skips = F.lit(files.touched < files.files).alias("skips_files")
            found.append(rows.select(F.lit(layout).alias("layout"), F.lit(kind).alias("filter"), skips, "rows"))
    return union_all(found)


def sql_views(spark: SparkSession, folder: str, lake: Lake) -> DataFrame:
    """A statement over the lake's named views that calls the masks by name."""
    define(spark)
    return lake.sql("""
        SELECT c.customer_state, mask_id(min(c.customer_unique_id)) AS first_person, count(DISTINCT f.order_id) AS orders
        FROM fct_order_items f JOIN dim_customer c ON c.customer_sk = f.customer_sk GROUP BY c.customer_state""")


def asof_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """Each event's status of the day before, by its user's own history, where a third of all events are one user's."""
    events = DriverTables(tune(spark), folder).table("events")
    user = F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    log = events.select(user.alias("user_id"), "event_type", "ts", "event_id")
    versions = history(log.select("user_id", "event_type", "ts"), ["user_id"], "ts", max_rows=500)
    asked = log.select("event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("asked_at"))
    return asof_join(asked, versions, "user_id", "asked_at", ["event_type"], open_first=False, max_rows=500)
