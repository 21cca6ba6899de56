from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelake.functions.bands import customer_segment, delay_bucket, size_bucket
from tidelake.functions.flags import freight_share, late_by_calendar, late_by_clock
from tidelake.functions.keys import packed_key, surrogate_key, unpacked_key
from tidelake.operators.layout import cluster
from tidelake.functions.masks import mask_coordinate, mask_customer_id, mask_free_text
from tidelake.functions.text import normalise_city
from tidelake.functions.times import clock_seconds, month_label
from tidelake.plans.analytics import star_report


def one(spark, schema, values, column):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(column).collect()]


def test_city_spellings(spark):
    given = [
        "Sao Paulo SP", "sao paulo - sp", "maua/sao paulo", "porto to", "sp", "/x", None,
        "  Rio   de  Janeiro ", "Mogi-Mirim", "sao paulop",
    ]
    wanted = [
        "sao paulo", "sao paulo", "maua", "porto", "sp", "", None, "rio de janeiro",
        "mogi-mirim", "sao paulop",
    ]
    assert one(spark, "c string", given, normalise_city(F.col("c"))) == wanted


def test_size_bands(spark):
    given = [None, 0.0, 499.9, 500.0, 1999.0, 2000.0, 9999.0, 10000.0]
    wanted = ["unknown", "small", "small", "medium", "medium", "large", "large", "oversized"]
    assert one(spark, "w double", given, size_bucket("w")) == wanted


def test_delay_bands(spark):
    given = [-8, -7, -6, -1, 0, 1, 7, 8, 14, 15]
    wanted = [
        "7+ days early", "7+ days early", "Early", "Early", "On the day", "1-7 days late",
        "1-7 days late", "8-14 days late", "8-14 days late", "15+ days late",
    ]
    assert one(spark, "d int", given, delay_bucket("d")) == wanted


def test_segments(spark):
    wanted = ["one_time", "one_time", "returning", "frequent", "frequent"]
    assert one(spark, "n long", [None, 1, 2, 3, 9], customer_segment("n")) == wanted


def test_lateness_has_two_definitions(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (TIMESTAMP'2018-01-10 15:00:00', TIMESTAMP'2018-01-10 00:00:00'),
        (TIMESTAMP'2018-01-11 00:00:00', TIMESTAMP'2018-01-10 00:00:00'),
        (TIMESTAMP'2018-01-09 00:00:00', TIMESTAMP'2018-01-10 00:00:00'),
        (CAST(NULL AS TIMESTAMP), TIMESTAMP'2018-01-10 00:00:00'),
        (TIMESTAMP'2018-01-09 00:00:00', CAST(NULL AS TIMESTAMP)) AS t(delivered, promised)"""
    )
    got = df.select(
        late_by_calendar(F.datediff("delivered", "promised")),
        late_by_clock(F.col("delivered"), F.col("promised")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (False, True), (True, True), (False, False), (None, None), (None, False),
    ]


def test_freight_share_needs_a_positive_price(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("3.00")), (Decimal("1.00"), Decimal("0.00")), (None, None)],
        "freight decimal(10,2), price decimal(10,2)",
    )
    share = df.select(freight_share(F.col("freight"), F.col("price")).alias("s"))
    assert [r.s for r in share.collect()] == [0.3333, None, None]
    assert share.schema["s"].dataType.simpleString() == "double"


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", None), (None, None)], "x string, y string")
    single = [r[0] for r in df.select(surrogate_key("x")).collect()]
    double = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert single[0] == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    assert single[2] is None
    assert all(len(key) == 64 for key in double)  # never NULL: parts are skipped


def test_masks(spark):
    df = spark.createDataFrame([("abcdefgh", -23.5678, "text"), (None, None, None)],
                               "i string, d double, t string")
    got = df.select(
        mask_customer_id(F.col("i")), mask_coordinate(F.col("d")), mask_free_text(F.col("t"))
    ).collect()
    assert tuple(got[0]) == ("abcd***REDACTED***", -23.6, "[REDACTED]")
    assert tuple(got[1]) == (None, None, None)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_helpers_for_both_stamp_types(spark, kind):
    df = spark.sql(f"SELECT CAST('2018-03-05 01:02:03.5' AS {kind}) AS ts")
    got = df.select(month_label(F.col("ts")), clock_seconds(df, "ts")).first()
    assert tuple(got) == ("2018-03", 1520211723)


def test_packed_keys_are_short_and_tell_all_keys_apart(spark):
    sk = "SELECT sha2('a', 256) AS k UNION ALL SELECT sha2('b', 256)"
    odd = "VALUES ('7'), (''), (upper(sha2('a', 256))), ('0g'), ('ab'), (repeat('x', 32)), (repeat('é', 32)), (CAST(NULL AS STRING))"
    keys = spark.sql(f"{sk} UNION ALL {odd}").select("k", packed_key("k").alias("packed")).collect()
    assert all((r.k is None) == (r.packed is None) for r in keys)
    assert len({bytes(r.packed) for r in keys if r.k is not None}) == len(keys) - 1
    assert [len(r.packed) for r in keys[:2]] == [32, 32]


def test_star_report_moves_keys_as_bytes(spark):
    """The dimensions meet the lines by packed keys, and keys that are no digests still meet."""
    lines = spark.sql("SELECT sha2('s', 256) AS seller_sk, 'p' AS product_sk, CAST(NULL AS STRING) AS customer_sk, date'2020-01-02' AS order_date_key,"
                      " CAST(3 AS DECIMAL(10,2)) AS gross_revenue, 4 AS delivery_days")
    report = star_report(
        lines, spark.sql("SELECT 'c' AS customer_sk, 'SP' AS customer_state"), spark.sql("SELECT sha2('s', 256) AS seller_sk, 'RJ' AS seller_state"),
        spark.sql("SELECT 'p' AS product_sk, 'toys' AS category_en"), spark.sql("SELECT date'2020-01-02' AS date_key, '2020-01' AS year_month"),
    )
    assert [tuple(r)[:5] for r in report.collect()] == [(None, "RJ", "toys", "2020-01", 1)]
    assert report._jdf.queryExecution().analyzed().toString().count("unhex(") >= 6


def test_star_report_moves_ids_in_place_of_their_digests(spark):
    lines = spark.sql("""SELECT sha2(s, 256) AS seller_sk, sha2(p, 256) AS product_sk, sha2('c', 256) AS customer_sk, s AS seller_id, p AS product_id,
        date'2020-01-02' AS order_date_key, CAST(3 AS DECIMAL(10,2)) AS gross_revenue, 4 AS delivery_days FROM VALUES ('s', 'p'), (NULL, 'p'), ('t', NULL) AS v(s, p)""")
    report = star_report(
        lines, spark.sql("SELECT sha2('c', 256) AS customer_sk, 'SP' AS customer_state"), spark.sql("SELECT sha2('s', 256) AS seller_sk, 's' AS seller_id, 'RJ' AS seller_state"),
        spark.sql("SELECT sha2('p', 256) AS product_sk, 'p' AS product_id, 'toys' AS category_en"), spark.sql("SELECT date'2020-01-02' AS date_key, '2020-01' AS year_month"),
    )
    assert sorted((tuple(r)[:5] for r in report.collect()), key=repr) == sorted([("SP", "RJ", "toys", "2020-01", 1), ("SP", None, "toys", "2020-01", 1), ("SP", None, None, "2020-01", 1)], key=repr)
    assert "unhex(seller_sk" not in (plan := report._jdf.queryExecution().analyzed().toString()) and "unhex(product_sk" not in plan and "unhex(customer_sk" in plan


def test_unpacked_keys_are_the_texts_that_were_packed(spark):
    odd = "VALUES (sha2('a', 256)), ('7'), (''), (upper(sha2('a', 256))), ('0g'), (repeat('x', 32)), (repeat('é', 32)), (CAST(NULL AS STRING))"
    assert all(r.k == r.again for r in spark.sql(odd).toDF("k").select("k", unpacked_key(packed_key("k")).alias("again")).collect())


def test_layout_moves_surrogate_keys_as_bytes(spark):
    df = spark.sql("SELECT sha2(cast(id AS string), 256) AS line_sk, date_add(date'2020-01-01', cast(id % 7 AS int)) AS day FROM range(20)")
    laid = cluster(df, ["day"])
    assert sorted(laid.collect()) == sorted(df.collect()) and laid.schema == df.schema
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "unhex(" in plan[plan.index("Exchange rangepartitioning") :]
