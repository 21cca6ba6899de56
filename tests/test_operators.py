import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelake.contracts import SILVER_FIELDS
from tidelake.operators.asof import asof_join
from tidelake.operators.collapse import centroid_with_mode, first_by_key, latest_by_key
from tidelake.operators.conform import conform, split_malformed
from tidelake.operators.expectations import Rule, drop_failing, guard, rules_for, tally
from tidelake.operators.hotkeys import number_rows
from tidelake.operators.integrity import grain_report, orphan_keys, reconcile, union_all
from tidelake.operators.quarantine import quarantine
from tidelake.operators.scd2 import changed_keys, current, history, sequence_ties
from tidelake.plans.rules import QUARANTINE_REASONS

DAY = datetime(2018, 1, 1)


def day(n):
    return DAY + timedelta(days=n)


def test_latest_row_and_count(spark, rows):
    df = spark.createDataFrame(
        [("p", day(1), "c1", 1), ("p", day(2), "c2", 2), ("p", day(2), "c3", 3),
         ("q", None, "c4", 4), ("q", day(0), "c0", 5)],
        "k string, at timestamp, id string, zip int",
    )
    got = latest_by_key(df, "k", ["at", "id"], "n")
    assert rows(got, "k", "id", "zip", "n") == [("p", "c3", 3, 3), ("q", "c0", 5, 2)]


def test_first_by_key_is_deterministic(spark, rows):
    df = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "k string, v string")
    assert rows(first_by_key(df, "k")) == [("a", "1"), ("b", "3")]


def test_centroid_counts_distinct_points_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, 1.0, 10.0, "b", "X"), (1, 1.0, 10.0, "b", "X"), (1, 3.0, 20.0, "a", "Y"),
         (1, None, 30.0, "a", "X"), (1, 4.0, 40.0, "b", "X"), (2, None, None, "c", "Z")],
        "zip int, lat double, lng double, city string, state string",
    )
    got = centroid_with_mode(df, "zip", ["lat", "lng"], ["city", "state"])
    assert rows(got, "zip", "lat", "lng", "source_point_count", "city", "state") == [
        (1, 8.0 / 3, 25.0, 4, "b", "X"), (2, None, None, 1, "c", "Z"),
    ]


def brute_history(log):
    """Independent reading of the rules, for one tracked column."""
    out = []
    for key in {k for k, _, _ in log}:
        kept = []
        for _, at, value in sorted(
            (r for r in log if r[0] == key), key=lambda r: (r[1], r[2] is not None, r[2] or "")
        ):
            if not kept or kept[-1][1] != value:
                kept.append((at, value))
        ends = [at for at, _ in kept[1:]] + [None]
        out += [(key, value, at, end) for (at, value), end in zip(kept, ends)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_rows", [10**6, 7, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_history_matches_brute_force_with_hot_keys(spark, rows, max_rows, seed):
    rng = random.Random(seed)
    log = [
        ("hot" if rng.random() < 0.5 else f"k{rng.randrange(8)}", day(rng.randrange(60)),
         rng.choice(["a", "b", None]))
        for _ in range(200)
    ]
    log += log[:20]  # repeated deliveries
    df = spark.createDataFrame(log, "k string, at timestamp, v string")
    got = history(df, ["k"], "at", max_rows=max_rows)
    assert rows(got, "k", "v", "__START_AT", "__END_AT") == brute_history(log)


def test_history_handles_null_keys_and_values(spark, rows):
    log = spark.createDataFrame(
        [(None, day(1), None), (None, day(2), "x"), (None, day(3), None)],
        "k string, at timestamp, v string",
    )
    for max_rows in (1, 100):
        assert len(history(log, ["k"], "at", max_rows=max_rows).collect()) == 3


def test_history_carries_but_does_not_track_the_sequence(spark, rows):
    log = spark.createDataFrame(
        [("s", day(1), "x", "f1"), ("s", day(2), "x", "f2")],
        "k string, at timestamp, v string, _source_file string",
    )
    assert history(log, ["k"], "at").columns == ["k", "at", "v", "__START_AT", "__END_AT"]
    assert history(log, ["k"], "at").count() == 1
    assert history(log, ["k"], "at", track=["v", "at"]).count() == 2


def test_intervals_are_disjoint_with_one_open_version(spark):
    log = spark.createDataFrame(
        [(f"k{i % 3}", day(i), f"v{i % 4}") for i in range(40)], "k string, at timestamp, v string"
    )
    versions = history(log, ["k"], "at")
    assert current(versions).groupBy("k").count().filter("count <> 1").count() == 0
    assert versions.filter("__END_AT <= __START_AT").count() == 0
    assert changed_keys(versions, "k").count() == versions.count()


def test_sequence_ties_are_reported(spark, rows):
    log = spark.createDataFrame(
        [("a", day(1), "x"), ("a", day(1), "x"), ("b", day(1), "x"), ("b", day(1), "y")],
        "k string, at timestamp, v string",
    )
    assert rows(sequence_ties(log, ["k"], "at"), "k", "variants") == [("b", 2)]


def test_rows_without_heavy_keys_are_numbered_in_one_move(spark, capsys):
    df = spark.range(100).selectExpr("id % 30 AS k", "id AS v")
    number_rows(df, ["k"], [F.col("v").cast("string")], ["v"], "n").explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_row_numbers_do_not_depend_on_segmentation(spark, rows):
    data = [("hot" if i % 3 else f"k{i % 5}", i) for i in range(300)] + [(None, i) for i in range(9)]
    df = spark.createDataFrame(data, "k string, v int")
    digest = [F.col("v").cast("string")]
    whole = rows(number_rows(df, ["k"], digest, ["v"], "n", max_rows=10**6))
    for max_rows in (50, 3):
        assert rows(number_rows(df, ["k"], digest, ["v"], "n", max_rows=max_rows)) == whole
    per_key = {}
    for key, _, number in whole:
        per_key.setdefault(key, []).append(number)
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in per_key.values())


@pytest.mark.parametrize("max_rows", [10**6, 40, 5])
@pytest.mark.parametrize("open_first", [True, False])
def test_asof_matches_brute_force(spark, max_rows, open_first):
    rng = random.Random(3)
    versions = []
    for key in ("a", "b"):
        starts = sorted(rng.sample(range(0, 700), 5))
        versions += [
            (key, f"{key}{i}", day(s), day(e) if e is not None else None)
            for i, (s, e) in enumerate(zip(starts, [*starts[1:], None]))
        ]
    facts = [(i, rng.choice("abc"), day(rng.randrange(-50, 800))) for i in range(150)]
    first = {k: min(v[2] for v in versions if v[0] == k) for k in "ab"}

    def expected(key, at):
        for k, name, start, end in versions:
            reaches = open_first and start == first[k]
            if k == key and (reaches or at >= start) and (end is None or at < end):
                return name
        return None

    got = asof_join(
        spark.createDataFrame(facts, "i int, k string, at timestamp"),
        spark.createDataFrame(
            versions, "k string, name string, __START_AT timestamp, __END_AT timestamp"
        ),
        "k", "at", ["name"], open_first, max_rows,
    )
    assert sorted((r.i, r.name) for r in got.collect()) == [
        (i, expected(k, at)) for i, k, at in facts
    ]


def raw_orders(spark, *orders):
    from tidelake.contracts import LANDING_COLUMNS

    schema = ", ".join(f"{c} string" for c in LANDING_COLUMNS["orders"])
    df = spark.createDataFrame(list(orders), schema)
    return df.withColumns({"_ingested_at": F.lit(DAY), "_source_file": F.lit("f")})


GOOD = ("o1", "c1", " Delivered ", "2018-01-01 10:00:00", "2018-01-01 11:00:00",
        "2018-01-02 00:00:00", "2018-01-05 00:00:00", "2018-01-10 00:00:00")


def changed(**at):
    names = ("order_id", "customer_id", "status", "bought", "approved", "carrier", "delivered",
             "promised")
    return tuple(at.get(n, v) for n, v in zip(names, GOOD))


def test_conform_is_strict_by_default(spark):
    bad = raw_orders(spark, GOOD, changed(order_id="o2", bought="soon"))
    with pytest.raises(PySparkException):
        conform(bad, SILVER_FIELDS["sv_orders"]).collect()


def test_malformed_rows_can_be_set_aside(spark):
    df = raw_orders(spark, GOOD, changed(order_id="o2", bought="soon", promised=None))
    clean, rejected = split_malformed(conform(df, SILVER_FIELDS["sv_orders"], tolerant=True))
    assert [r.order_id for r in clean.collect()] == ["o1"]
    assert [(r.order_id, r._malformed) for r in rejected.collect()] == [
        ("o2", ["order_purchase_timestamp"])
    ]
    assert clean.first().order_status == "delivered"


def test_drop_rules_and_counts(spark):
    df = conform(
        raw_orders(
            spark, GOOD, changed(order_id=None), changed(order_id="o3", status="lost"),
            changed(order_id="o4", status=None), changed(order_id="o5", delivered="2017-01-01"),
        ),
        SILVER_FIELDS["sv_orders"],
    )
    rules = rules_for("sv_orders")
    assert sorted(r.order_id for r in drop_failing(df, rules).collect()) == ["o1", "o5"]
    entries = tally(df, rules, "sv_orders", F.lit(DAY)).first().expectations
    found = {e["name"]: (e.passed_records, e.failed_records) for e in entries}
    assert found["valid_order_id"] == (4, 1)
    assert found["known_status"] == (3, 2)  # an unknown result is a failure
    assert found["delivery_after_purchase"] == (4, 1)
    assert found["delivered_has_date"] == (5, 0)


def test_guard_stops_the_job(spark):
    rule = Rule("has_id", "fail", "id IS NOT NULL")
    good = spark.createDataFrame([(1,)], "id int")
    assert guard(good, [rule], "t").count() == 1
    with pytest.raises(PySparkException, match="expectation has_id failed on t"):
        guard(good.union(spark.sql("SELECT CAST(NULL AS INT)")), [rule], "t").collect()


def test_quarantine_takes_the_first_reason(spark, rows):
    df = conform(
        raw_orders(
            spark, GOOD,
            changed(order_id="q1", carrier="2017-12-01 00:00:00", delivered="2017-12-02 00:00:00"),
            changed(order_id="q2", delivered="2017-12-02 00:00:00"),
            changed(order_id="q3", delivered=None),
            changed(order_id="q4", status="shipped"),
            changed(order_id="fine", status="shipped", delivered=None, carrier=None),
        ),
        SILVER_FIELDS["sv_quarantine_orders"],
    )
    assert rows(quarantine(df, QUARANTINE_REASONS), "order_id", "_quarantine_reason") == [
        ("q1", "carrier_before_approval"), ("q2", "delivered_before_purchase"),
        ("q3", "delivered_without_date"), ("q4", "undelivered_with_date"),
    ]


def test_integrity_reports(spark, rows):
    fact = spark.createDataFrame([("a", 1), ("x", 2), ("x", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(orphan_keys(fact, dim, "k", "r")) == [("r", 2, 1, 1)]
    assert rows(grain_report(fact, "fact", ["k"])) == [("fact", 4, 3, 1, 1)]
    totals = fact.agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    assert rows(reconcile(totals, {"total": 10, "n": 5}), "check", "ok") == [
        ("n", False), ("total", True)
    ]
    with pytest.raises(ValueError):
        union_all([])


def test_decimal_types_of_silver(spark):
    from tidelake.contracts import LANDING_COLUMNS
    from tidelake.plans.silver import row_wise

    schema = ", ".join(f"{c} string" for c in LANDING_COLUMNS["order_items"])
    raw = spark.createDataFrame([("o", "1", "p", "s", "2018-01-01", "10.005", "1")], schema)
    line = row_wise("sv_order_items", raw.withColumn("_ingested_at", F.lit(DAY))).first()
    assert (line.price, line.freight_value) == (Decimal("10.01"), Decimal("1.00"))


def test_asof_moves_a_fact_once_and_its_key_and_time_once(spark, rows):
    facts = spark.sql("SELECT id % 3 AS k, timestamp_ntz'2020-01-01' + make_dt_interval(cast(id AS int)) AS at, id AS n FROM range(9)")
    versions = spark.sql("""SELECT * FROM VALUES (0L, timestamp_ntz'2020-01-04', timestamp_ntz'2020-01-06', 'a'), (0L, timestamp_ntz'2020-01-06', NULL, 'b'),
        (1L, NULL, NULL, 'c'), (1L, timestamp_ntz'2020-01-03', NULL, 'd') AS v(k, __START_AT, __END_AT, name)""")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = asof_join(facts, versions, "k", "at", ["name"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert "struct(n, id#" in plan
    assert rows(found, "n", "name") == [(0, "a"), (1, "c"), (2, None), (3, "a"), (4, "d"), (5, None), (6, "b"), (7, "d"), (8, None)]
    assert found.columns == ["k", "at", "n", "name", "version_start"]
