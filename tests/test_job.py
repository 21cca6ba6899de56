"""Two landings of a small, awkward shop through the whole job."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelake.plans import analytics
from tidelake.plans.lake import GOLD, Lake
from tidelake.plans.job import Job
from tidelake.sources.landing import SOURCES

FIRST = {
    "orders": [
        "o1,c1,delivered,2018-01-05 10:00:00,2018-01-05 11:00:00,2018-01-06 00:00:00,2018-01-10 09:00:00,2018-01-10 00:00:00",
        "o2,c2,delivered,2018-02-05 10:00:00,2018-02-05 11:00:00,2018-02-06 00:00:00,2018-02-20 00:00:00,2018-02-10 00:00:00",
        "o3,c3,shipped,2018-02-07 10:00:00,2018-02-07 11:00:00,2018-02-08 00:00:00,,2018-02-20 00:00:00",
        "o4,c4,canceled,2018-02-08 10:00:00,,,,2018-02-20 00:00:00",
    ],
    "order_items": [
        "o1,1,p1,s1,2018-01-08 00:00:00,100.00,10.00",
        "o1,2,p2,s2,2018-01-08 00:00:00,50.00,0.00",
        "o2,1,p1,s1,2018-02-08 00:00:00,100.00,20.00",
        "o3,1,p3,s1,2018-02-10 00:00:00,0.00,5.00",
    ],
    "customers": [
        "c1,ann,1000,Sao Paulo SP,sp", "c2,ann,1000,sao paulo/sp,SP", "c3,ann,2000,rio,RJ",
        "c4,bob,9999,nowhere,MG",
    ],
    "sellers": ["s1,1000,sao paulo,SP", "s2,3000,curitiba,PR"],
    "products": [
        "p1,moveis,10,20,1,400,10,10,10", "p2,pc_gamer,10,20,1,12000,2,2,2", "p3,,,,,,,,",
    ],
    "payments": [
        "o1,1,credit_card,3,160.00", "o2,1,voucher,1,0.00", "o3,1,not_defined,1,5.00",
        "gone,1,boleto,1,7.00",
    ],
    "reviews": [
        'r1,o1,5,,"great\nstuff",2018-01-11 00:00:00,2018-01-12 00:00:00',
        "r2,o1,3,,,2018-01-11 00:00:00,2018-01-12 00:00:00",
        "r3,o2,1,bad,late,2018-02-21 00:00:00,2018-02-22 00:00:00",
        "r3,o3,1,bad,late,2018-02-21 00:00:00,2018-02-22 00:00:00",
    ],
    "geolocation": [
        "1000,-23.5,-46.5,sao paulo,SP", "1000,-23.5,-46.5,sao paulo,SP",
        "1000,-23.7,-46.7,Sao Paulo,sp", "2000,-22.9,-43.2,rio,RJ",
    ],
    "category_translation": ["moveis,furniture"],
}
SECOND = {
    "orders": [
        "o5,c5,delivered,2018-03-01 10:00:00,2018-03-01 11:00:00,2018-03-02 00:00:00,2018-03-03 00:00:00,2018-03-10 00:00:00",
    ],
    "order_items": ["o5,1,p2,s2,2018-03-03 00:00:00,30.00,3.00"],
    "customers": ["c5,bob,1000,sao paulo,SP"],
    "sellers": ["s1,2000,rio,RJ", "s2,3000,curitiba,PR"],
    "products": ["p1,recategorised,10,20,1,400,10,10,10"],
}


def land(folder, batch, name):
    for source, lines in batch.items():
        path = folder / source / name
        path.mkdir(parents=True, exist_ok=True)
        header = ",".join(SOURCES[source].columns)
        (path / "data.csv").write_text("\n".join([header, *lines]) + "\n")


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    job = Job(spark, str(root / "landing"), str(root / "lake"))
    land(root / "landing", FIRST, "batch1")
    files = job.run()
    gmv = job.tables.read("gold", "fct_order_items").agg(F.sum("gross_revenue")).first()[0]
    land(root / "landing", SECOND, "batch2")
    job.run()
    return job, files, gmv


def read(shop, layer, name):
    return shop[0].tables.read(layer, name)


def test_first_run(shop):
    assert shop[1] == 9
    assert shop[2] == Decimal("285.00")


def test_second_run_adds_only_what_is_new(shop, rows):
    assert read(shop, "bronze", "br_orders").count() == 5
    assert read(shop, "silver", "sv_orders").count() == 5
    assert rows(read(shop, "gold", "fct_order_items"), "order_id", "order_item_id") == [
        ("o1", 1), ("o1", 2), ("o2", 1), ("o3", 1), ("o5", 1),
    ]


def test_history_of_sellers_and_products(shop, rows):
    sellers = read(shop, "silver", "sv_sellers_history").withColumn("open", F.expr("__END_AT IS NULL"))
    assert rows(sellers, "seller_id", "seller_city", "open") == [
        ("s1", "rio", True), ("s1", "sao paulo", False), ("s2", "curitiba", True),
    ]
    assert rows(read(shop, "gold", "dim_seller"), "seller_id", "seller_city", "has_geo") == [
        ("s1", "rio", True), ("s2", "curitiba", False),
    ]
    changes = analytics.category_changes(read(shop, "silver", "sv_products_history"))
    assert [(r.product_id, r.product_category_name, r.version_status) for r in changes.collect()] == [
        ("p1", "moveis", "superseded"), ("p1", "recategorised", "current"),
    ]


def test_products_fall_back_to_the_source_category(shop, rows):
    assert rows(read(shop, "gold", "dim_product"), "product_id", "category_pt", "category_en", "size_bucket") == [
        ("p1", "recategorised", "recategorised", "small"),
        ("p2", "pc_gamer", "pc_gamer", "oversized"), ("p3", "unknown", "unknown", "unknown"),
    ]


def test_people_not_order_keys(shop, rows):
    customers = read(shop, "gold", "dim_customer")
    assert rows(customers, "customer_unique_id", "lifetime_order_count", "customer_segment", "customer_city") == [
        ("ann", 3, "frequent", "rio"), ("bob", 2, "returning", "sao paulo"),
    ]
    assert read(shop, "gold", "bridge_customer_order").count() == 5


def test_two_kinds_of_late(shop, rows):
    lines = read(shop, "gold", "fct_order_items").select("order_id", "is_late_delivery").distinct()
    assert rows(lines) == [("o1", False), ("o2", True), ("o3", None), ("o5", False)]
    reviews = read(shop, "gold", "fct_reviews").select("order_id", "is_late_delivery").distinct()
    assert rows(reviews) == [("o1", True), ("o2", True), ("o3", None)]


def test_payments_keep_orphans_and_suspects(shop, rows):
    assert rows(read(shop, "gold", "fct_payments"), "order_id", "is_suspect", "has_order", "is_installment") == [
        ("gone", False, False, False), ("o1", False, True, True), ("o2", True, True, False),
        ("o3", True, True, False),
    ]


def test_text_over_several_lines_survives(shop, rows):
    texts = read(shop, "silver", "sv_reviews").filter("review_id = 'r1'")
    assert rows(texts, "review_comment_message") == [("great\nstuff",)]


def test_marts_count_a_line_once_per_review(shop, rows):
    mart = read(shop, "gold", "mart_delivery_performance")
    assert rows(mart.filter("year_month = '2018-01'"), "line_items", "orders", "gmv", "avg_review_score") == [
        (4, 1, Decimal("320.00"), 4.0)
    ]
    stored = {n: read(shop, "gold", n) for n in ("fct_order_items", "dim_customer", "fct_reviews")}
    safe = Lake(shop[0].spark, stored, fanout_safe=True)["mart_delivery_performance"]
    assert rows(safe.filter("year_month = '2018-01'"), "line_items", "orders", "gmv", "avg_review_score") == [
        (2, 1, Decimal("160.00"), 4.0)
    ]


def test_monthly_revenue(shop, rows):
    got = read(shop, "gold", "mart_monthly_revenue")
    assert rows(got, "year_month", "orders", "customers", "line_items", "gmv", "avg_order_value") == [
        ("2018-01", 1, 1, 2, Decimal("160.00"), Decimal("160.00")),
        ("2018-02", 2, 1, 2, Decimal("125.00"), Decimal("62.50")),
        ("2018-03", 1, 1, 1, Decimal("33.00"), Decimal("33.00")),
    ]


def test_money_types(shop):
    types = {f.name: f.dataType.simpleString() for f in read(shop, "gold", "fct_order_items").schema}
    assert types["gross_revenue"] == "decimal(11,2)" and types["freight_ratio"] == "double"
    assert types["order_purchase_timestamp"] == "timestamp" and types["delivery_days"] == "int"
    mart = {f.name: f.dataType.simpleString() for f in read(shop, "gold", "mart_seller_scorecard").schema}
    assert mart["gmv"] == "decimal(22,2)" and mart["avg_item_price"] == "decimal(11,2)"


def test_expectation_report_adds_up_over_runs(shop):
    report = {(r.dataset, r.expectation): r for r in read(shop, "ops", "dq_expectation_report").collect()}
    assert len(report) == 28
    assert report[("sv_payments", "known_payment_type")].total_failed == 1
    assert report[("sv_orders", "valid_order_id")].total_passed == 5
    # Recomputed tables are counted on every run.
    assert report[("dim_seller", "unique_seller")].total_passed == 4


def test_sql_over_stored_tables_and_views(shop):
    spark = shop[0].spark
    text = """SELECT c.customer_state, COUNT(DISTINCT f.order_id) AS orders, SUM(f.gross_revenue) AS gmv
              FROM {f} f JOIN {c} c ON f.customer_sk = c.customer_sk GROUP BY 1 ORDER BY gmv DESC"""
    stored = spark.sql(text.format(f="gold.fct_order_items", c="gold.dim_customer")).collect()
    lake = Lake(spark, {n: read(shop, "gold", n) for n in GOLD} | {
        n: read(shop, "silver", n) for n in
        ("sv_orders", "sv_order_items", "sv_payments", "sv_reviews", "sv_quarantine_orders",
         "sv_customer_keys", "sv_customers", "sv_geolocation", "sv_category_translation",
         "sv_sellers_history", "sv_products_history")
    })
    assert lake.sql(text.format(f="fct_order_items", c="dim_customer")).collect() == stored
    built = analytics.revenue_by_state(lake["fct_order_items"], lake["dim_customer"]).collect()
    assert [(r.customer_state, r.orders, r.gmv) for r in built] == [tuple(r) for r in stored]


def test_secure_views(shop, rows):
    spark = shop[0].spark
    masked = spark.sql("SELECT * FROM security.v_dim_customer_secure")
    assert rows(masked, "customer_unique_id") == [("ann***REDACTED***",), ("bob***REDACTED***",)]
    assert "review_comment_message" not in spark.table("security.v_fct_reviews_secure").columns
    assert spark.table("security.v_dim_customer_regional").count() == 1


def test_redelivered_orders_fan_out_unless_asked(spark, shop, rows):
    bronze = read(shop, "bronze", "br_orders").drop("batch_id")
    again = bronze.filter("order_id = 'o3'").withColumns(
        {"order_status": F.lit("delivered"),
         "_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 1 DAY")}
    )
    tables = {
        "br_orders": bronze.unionByName(again),
        "sv_order_items": read(shop, "silver", "sv_order_items"),
        "bridge_customer_order": read(shop, "gold", "bridge_customer_order"),
    }
    plain = Lake(spark, tables)["fct_order_items"].filter("order_id = 'o3'")
    newest = Lake(spark, tables, newest_orders_only=True)["fct_order_items"].filter("order_id = 'o3'")
    assert rows(plain, "order_status") == [("delivered",), ("shipped",)]
    assert rows(newest, "order_status") == [("delivered",)]
