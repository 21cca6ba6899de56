"""Order, line, customer and event tables re-shaped into the nine landing sources.

Every frame is a projection (plus the joins named below) of the given parquet tables, so its work
grows with them. Time stamps keep the tables' zone-less type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.hotkeys import number_rows
from tidelake.session import size_shuffles

# Mapping of the tables' codes to the sources' enumerations.
STATUS_CODES = {"F": "delivered", "O": "shipped"}
PAYMENT_TYPES = {
    "purchase": "credit_card", "click": "boleto", "view": "voucher", "signup": "debit_card",
    "error": "not_defined",
}
FIRST_BATCH, SECOND_BATCH = "1995-01-01", "1998-06-01"
CALENDAR = ("1995-01-01", "2001-12-31")
#: The tables that grow, and how much of them a shuffle partition takes: a row in memory is about ten times as long as its columnar form.
LARGE, PARTITION_BYTES = ("customer", "orders", "lineitem", "events"), 8 << 20


def _days(count: Column | int, hours: Column | int = 0) -> Column:
    as_column = [F.lit(v) if isinstance(v, int) else v.cast("int") for v in (count, hours)]
    return F.make_dt_interval(*as_column)


def _recode(codes: dict[str, str], code: Column, other: str | None = None) -> Column:
    hits = [F.when(code == given, F.lit(wanted)) for given, wanted in codes.items()]
    return F.coalesce(*hits, F.lit(other))


def _batch(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


class DriverTables:
    """Landing sources by name, e.g. ``DriverTables(spark, folder)["br_orders"]``.

    ``number_lines=False`` leaves order lines with their own line number, which repeats within an
    order; reports that never look at the line number save the numbering pass. Shuffles start with partitions for the
    tables' size, so that a task's memory does not grow with them.
    """

    def __init__(self, spark: SparkSession, folder: str, number_lines: bool = True):
        self.number_lines = number_lines
        self.spark = spark
        self.folder = folder
        paths = [f"{folder}/{name}.parquet" for name in LARGE]
        stored = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0]
        size_shuffles(spark, stored or 0, PARTITION_BYTES)
        self.sources: dict[str, Callable[[], DataFrame]] = {
            "br_orders": self.orders,
            "br_order_items": self.order_items,
            "br_customers": self.customers,
            "br_geolocation": self.geolocation,
            "br_sellers": self.sellers,
            "br_products": self.products,
            "br_category_translation": self.category_translation,
            "br_payments": self.payments,
            "br_reviews": self.reviews,
        }

    def __getitem__(self, name: str) -> DataFrame:
        return self.sources[name]()

    def __contains__(self, name: str) -> bool:
        return name in self.sources

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _audited(self, df: DataFrame, ingested: Column, table: str, *columns: Column) -> DataFrame:
        return df.select(
            *columns,
            ingested.alias("_ingested_at"),
            F.lit(f"{table}.parquet").alias("_source_file"),
            F.lit(table).alias("_source_system"),
        )

    def orders(self) -> DataFrame:
        key, placed = F.col("o_orderkey"), F.col("o_orderdate")
        filled = F.col("o_orderstatus") == "F"
        arrived = (filled & (key % 20 != 0)) | (~filled & (key % 10 == 0))
        return self._audited(
            self.table("orders"), placed, "orders",
            key.cast("string").alias("order_id"),
            F.concat(F.lit("c"), key.cast("string")).alias("customer_id"),
            _recode(STATUS_CODES, F.col("o_orderstatus"), "processing").alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            (placed + _days(1)).alias("order_approved_at"),
            F.when(key % 3 == 0, placed + _days(key % 5)).alias("order_delivered_carrier_date"),
            F.when(arrived, placed + _days((key * 7) % 61 - 2, key % 24)).alias(
                "order_delivered_customer_date"
            ),
            (placed + _days(30)).alias("order_estimated_delivery_date"),
        )

    def order_items(self) -> DataFrame:
        lines = self.table("lineitem")
        if self.number_lines:
            digest = [
                F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                F.col("l_linenumber").cast("string"), F.to_date("l_shipdate").cast("string"),
            ]
            ties = [c for c in lines.columns if c != "l_orderkey"]
            # silver looks orders up by the trimmed text of the key
            order = F.trim(F.col("l_orderkey").cast("string"))
            lines = number_rows(lines, ["l_orderkey"], digest, ties, "line_id", home=order)
        else:
            lines = lines.withColumn("line_id", F.col("l_linenumber"))
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        return self._audited(
            lines, F.col("l_shipdate"), "lineitem",
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("line_id").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)").alias(
                "freight_value"
            ),
        )

    def customers(self) -> DataFrame:
        """Orders joined to their customer; the 25 nations follow by key."""
        joined = self.table("orders").join(
            self.table("customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        zone = ((F.col("c_nationkey") + F.expr("o_orderkey div 8") % 2) % 25).cast("int")
        placed = joined.withColumn("zone", zone).join(
            self.table("nation"), F.col("zone") == F.col("n_nationkey")
        )
        person = F.concat_ws(
            "-", F.col("o_custkey").cast("string"), (F.col("o_orderkey") % 8).cast("string")
        )
        return self._audited(
            placed, F.col("o_orderdate"), "customer",
            F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("customer_id"),
            person.alias("customer_unique_id"),
            F.col("zone").alias("customer_zip_code_prefix"),
            F.lower("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    def geolocation(self) -> DataFrame:
        placed = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return self._audited(
            placed, _batch(FIRST_BATCH), "customer",
            # two nations under other prefixes, so that some places stay unknown
            F.when(F.col("c_nationkey") < 23, F.col("c_nationkey"))
            .otherwise(F.col("c_nationkey") + 900)
            .alias("geolocation_zip_code_prefix"),
            (F.round("c_acctbal") / 100).alias("geolocation_lat"),
            (F.col("c_custkey") % 180).cast("double").alias("geolocation_lng"),
            F.lower("c_mktsegment").alias("geolocation_city"),
            F.col("r_name").alias("geolocation_state"),
        )

    def _two_batches(self, df: DataFrame, moved: Column) -> DataFrame:
        """Every row in the first batch, the ``moved`` ones again in the second."""
        batches = F.when(moved, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return df.withColumn("batch", F.explode(batches))

    def sellers(self) -> DataFrame:
        joined = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        log = self._two_batches(joined, F.col("s_suppkey") % 25 == 0)
        second = F.col("batch") == 2
        nation = F.col("s_nationkey").cast("string")
        return self._audited(
            log, F.when(second, _batch(SECOND_BATCH)).otherwise(_batch(FIRST_BATCH)), "supplier",
            F.col("s_suppkey").cast("string").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.concat(F.when(second, F.lit("moved ")).otherwise(F.lit("city ")), nation).alias(
                "seller_city"
            ),
            F.col("n_name").alias("seller_state"),
        )

    def products(self) -> DataFrame:
        log = self._two_batches(self.table("part"), F.col("p_partkey") % 50 == 0)
        second, key, size = F.col("batch") == 2, F.col("p_partkey"), F.col("p_size")
        category = F.when(second, F.lit("recategorised")).otherwise(
            F.when(key % 40 != 1, F.lower("p_type"))
        )
        return self._audited(
            log, F.when(second, _batch(SECOND_BATCH)).otherwise(_batch(FIRST_BATCH)), "part",
            key.cast("string").alias("product_id"),
            category.alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_type").alias("product_description_lenght"),
            (size % 6 + 1).alias("product_photos_qty"),
            F.when(key % 97 != 0, size * 250).alias("product_weight_g"),
            size.alias("product_length_cm"),
            (size % 7 + 1).alias("product_height_cm"),
            (size % 11 + 1).alias("product_width_cm"),
        )

    def category_translation(self) -> DataFrame:
        types = self.table("part").select("p_type").distinct()
        return self._audited(
            types, _batch(FIRST_BATCH), "part",
            # one category under another name, so that its products find no translation
            F.when(F.col("p_type") == "PROMO", "x_PROMO")
            .otherwise(F.col("p_type"))
            .alias("product_category_name"),
            F.concat(F.lit("en_"), F.lower("p_type")).alias("product_category_name_english"),
        )

    def payments(self) -> DataFrame:
        key = F.col("event_id")
        text = key.cast("string")
        k = F.get_json_object("props", "$.k").cast("int")
        return self._audited(
            self.table("events"), F.col("ts"), "events",
            F.when(key % 1000 == 7, F.concat(F.lit("x"), text)).otherwise(text).alias("order_id"),
            (F.col("user_id") % 3 + 1).cast("int").alias("payment_sequential"),
            _recode(PAYMENT_TYPES, F.col("event_type")).alias("payment_type"),
            (k % 12 + 1).alias("payment_installments"),
            F.when(key % 500 == 0, F.lit(0)).otherwise(F.col("value")).cast("decimal(10,2)").alias(
                "payment_value"
            ),
        )

    def reviews(self) -> DataFrame:
        key = F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("int")
        return self._audited(
            self.table("events"), F.col("ts"), "events",
            F.concat(F.lit("r"), (key % 500).cast("string")).alias("review_id"),
            (key - key % 3).cast("string").alias("order_id"),
            (k % 5 + 1).alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.when(key % 4 != 0, F.col("event_type")).alias("review_comment_message"),
            F.col("ts").alias("review_creation_date"),
            F.col("ts").alias("review_answer_timestamp"),
        )
