"""Rule operators, masks and log as SQL functions, inferred types, layout, and plans that read once."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidelake.functions import masks
from tidelake.functions.text import normalise_city
from tidelake.operators import rules
from tidelake.operators.expectations import Rule
from tidelake.operators.integrity import Relation, orphan_report
from tidelake.operators.layout import cluster, curve_place, files_touched
from tidelake.plans import dq
from tidelake.plans.catalogue import driver_lake
from tidelake.session import tune
from tidelake.sources import driver_tables
from tidelake.sources.eventlog import EventLog
from tidelake.sources.inference import InferredSchema, possible

SMALL = "/root/testdata/sf0.001"


def verdicts(spark, condition, values, ddl):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], ddl)
    return [r[0] for r in df.select(Rule("r", "warn", condition).holds()).collect()]


def test_rule_operators(spark):
    assert verdicts(spark, rules.present("a"), [1, None], "a int") == [True, False]
    assert verdicts(spark, rules.one_of("a", ["x", "it's"]), ["x", "it's", "y", None], "a string") == [True, True, False, False]
    assert verdicts(spark, rules.within("a", 1, 5), [0, 1, 5, 6, None], "a int") == [False, True, True, False, False]
    assert verdicts(spark, rules.in_order_if_known("a", "b"), [(1, 2), (2, 1), (None, 1), (1, None)], "a int, b int") == [True, False, True, True]
    unless = rules.unless(rules.missing("a"), "a >= b")
    assert verdicts(spark, unless, [(None, 1), (2, 1), (1, 2), (1, None)], "a int, b int") == [True, True, False, False]
    both = rules.all_of(rules.equals("a", "x"), rules.differs("b", "y"))
    assert verdicts(spark, both, [("x", "z"), ("x", "y"), ("w", "z")], "a string, b string") == [True, False, False]
    declared = rules.declare(drop=rules.identified(has_a="a"), warn={"big": rules.above("a", 3)}, fail={"some": rules.at_least("a", 0)})
    assert declared == (("has_a", "drop", "a IS NOT NULL"), ("some", "fail", "a >= 0"), ("big", "warn", "a > 3"))


@pytest.mark.parametrize("given, clean", [
    ("Sao Paulo SP", "sao paulo"), ("sao paulo - sp", "sao paulo"), ("sao paulo-SP", "sao paulo"), ("maua/sao paulo", "maua"),
    ("porto to", "porto"), ("sp", "sp"), ("mato", "mato"), ("/x", ""), ("  belo   horizonte ", "belo horizonte"), ("nao-me-toque", "nao-me-toque"),
    ("- sp", ""), ("", ""), (None, None),
])
def test_city_names(spark, given, clean):
    assert spark.createDataFrame([(given,)], "c string").select(normalise_city(F.col("c"))).first()[0] == clean


def test_masks_are_functions_of_the_catalog(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS masked")
    masks.define(spark, "masked")
    row = spark.sql("SELECT masked.mask_id('abcdefgh'), masked.mask_coordinate(-23.5489D), masked.mask_text('secret'), masked.mask_text(NULL)").first()
    assert tuple(row) == ("abcd***REDACTED***", -23.5, "[REDACTED]", None)
    frame = spark.createDataFrame([("abcdefgh",)], "id string").select(masks.mask_customer_id(F.col("id")).alias("m"))
    assert frame.first().m == row[0] and spark.sql("SELECT mask_id('abcdefgh')").first()[0] == row[0]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "concat" in plan and "UDF" not in plan.upper().replace("SQLFUNCTION", "")


def test_event_log_is_a_table_function(spark, tmp_path):
    log = EventLog(spark, str(tmp_path / "log"))
    log.append("silver", [{"name": "r", "dataset": "d", "passed_records": 1, "failed_records": 0}], name="one")
    log.append("silver", [{"name": "r", "dataset": "d", "passed_records": 2, "failed_records": 0}], name="one")  # recorded again
    log.append("gold", [], name="two")
    spark.sql("CREATE SCHEMA IF NOT EXISTS logged")
    log.define("logged")
    spark.sql("USE logged")
    try:
        found = spark.sql("SELECT * FROM event_log('silver')").collect()
    finally:
        spark.sql("USE default")
    log.define()
    assert spark.sql("SELECT * FROM event_log('silver')").collect() == found
    assert len(found) == 1 and found[0].timestamp is not None
    assert json.loads(found[0].details)["flow_progress"]["data_quality"]["expectations"][0]["passed_records"] == 2


def test_types_are_inferred_over_files_and_kept(spark, tmp_path):
    def rows(*values):
        return spark.createDataFrame([(v, "x") for v in values], "v string, w string")

    schema = InferredSchema(spark, str(tmp_path / "schema"), ["v", "w"])
    assert schema.types() == {"v": "string", "w": "string"}
    for values, wanted, version in (
        (["1", " 20 ", None], "bigint", 1), (["3"], "bigint", 1), (["1.50", "2"], "decimal(38,9)", 2), (["1e300"], "double", 3),
        (["1"], "double", 3), (["n/a"], "string", 4), (["1"], "string", 4),
    ):
        assert schema.learn(rows(*values)) == version
        assert schema.types()["v"] == wanted
    again = InferredSchema(spark, str(tmp_path / "schema"), ["v", "w"])
    assert again.types()["v"] == "string" and again.history().count() == 4
    days = possible(spark.createDataFrame([("2018-01-31", "2018-01-31 10:00:00", "TRUE")], "a string, b string, c string"), ["a", "b", "c"])
    assert [days[c][0] for c in "abc"] == ["date", "timestamp", "boolean"]
    typed = InferredSchema(spark, str(tmp_path / "other"), ["v"])
    typed.learn(rows("1", " 2"))
    assert [r.v for r in typed.typed(rows("1", " 2", None)).collect()] == [1, 2, None]


def test_both_columns_of_a_curve_let_files_be_skipped(spark, tmp_path):
    df = spark.range(20_000).selectExpr(
        "timestamp_seconds(1500000000 + xxhash64(id) % 10000000) AS at", "concat('seller-', pmod(xxhash64(id, 1), 200)) AS seller", "id"
    )
    cluster(df, ["at", "seller"], files=32).write.parquet(str(tmp_path / "curve"))
    stored = spark.read.parquet(str(tmp_path / "curve"))
    assert stored.columns == df.columns and stored.count() == 20_000
    one = files_touched(stored, "seller", F.lit("seller-42"), F.lit("seller-42")).first()
    some = files_touched(stored, "at", F.lit("2017-07-14").cast("timestamp"), F.lit("2017-07-20").cast("timestamp")).first()
    assert one.files == some.files == 32 and one.touched <= 14 and some.touched <= 14
    unknown = spark.createDataFrame([(None, None), (1.0, "b"), (2.0, None)], "x double, y string")
    assert [r[0] for r in unknown.select(curve_place(unknown, ["x", "y"])).collect()][0] == 0
    assert cluster(unknown, ["x", "y"]).count() == 3 and cluster(unknown.limit(0), ["x", "y"]).count() == 0


def test_a_place_on_the_curve_takes_one_comparison_for_each_bit(spark, capsys):
    df = spark.range(5000).selectExpr("CASE WHEN id % 50 > 0 THEN xxhash64(id) % 1000 / 7 END AS x", "pow(id % 300, 3) AS y", "id")
    place = curve_place(df, ["x", "y"])
    shares = [i / 64 for i in range(1, 64)]
    cuts = [sorted(set(c)) for c in df.agg(*[F.percentile_approx(c, shares, 1024) for c in "xy"]).first()]
    for x, y, found in df.select("x", "y", place).collect():
        expected = 0
        for i, (value, limits) in enumerate(zip((x, y), cuts)):
            bucket = 0 if value is None else sum(value >= c for c in limits)
            expected |= sum((bucket >> bit & 1) << (2 * bit + 1 - i) for bit in range(6))
        assert found == expected
    cluster(df, ["x", "y"], files=4).explain("extended")
    plan = capsys.readouterr().out
    assert "lambda" not in plan and "__place" in plan


def test_shuffle_files_go_with_their_statement(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = files.getAllFiles().size()
    df = tune(spark).range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    assert df.agg(F.sum("count")).first()[0] == 10_000 and files.getAllFiles().size() <= before
    assert sorted(df.collect()) == sorted(df.collect()) and len(df.collect()) == 7


def test_shuffles_are_sized_by_the_driver_tables(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(driver_tables, "PARTITION_BYTES", 4096)
    try:
        driver_tables.DriverTables(spark, SMALL)
        assert int(spark.conf.get(key)) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(key)


def test_orphans_of_all_relations_in_one_pass(spark, rows):
    frames = {
        "f": spark.createDataFrame([("a", 1), ("x", 2), ("x", None), (None, 9)], "k string, n int"),
        "g": spark.createDataFrame([("b",)], "k string"),
        "d": spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"),
        "e": spark.createDataFrame([], "k string"),
    }
    reads = []

    def read(name):
        reads.append(name)
        return frames[name]

    relations = [
        Relation("f.k in d", "f", "k", "d", "k"), Relation("f.n in d", "f", "n", "d", "n"), Relation("g in d", "g", "k", "d", "k"),
        Relation("g in e", "g", "k", "e", "k"), Relation("e in d", "e", "k", "d", "k"),
    ]
    found = orphan_report(relations, read)
    assert sorted(reads) == ["d", "e", "e", "f", "g"]  # e is a fact and a dimension
    assert rows(found) == [("e in d", 0, 0, 0), ("f.k in d", 2, 1, 1), ("f.n in d", 1, 1, 1), ("g in d", 0, 0, 0), ("g in e", 1, 1, 0)]


def plan_of(spark, name):
    return contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["mart_delivery_performance", "mart_seller_scorecard", "mart_monthly_revenue"])
def test_marts_count_distinct_without_expanding(spark, name):
    plan = plan_of(spark, name)
    assert "Expand" not in plan and "count(distinct" not in plan.lower()


def test_the_scorecard_groups_lines_once(spark):
    lines = [x for x in plan_of(spark, "mart_seller_scorecard").splitlines() if "FileScan" in x and "l_partkey" in x and "l_tax" in x]
    assert len(lines) == 1


def test_recorded_tables_go_when_they_have_been_read(spark, tmp_path):
    """Counts stay as they are; of the stored data sets only those are left that facts read, and lines are not stored at all."""
    log = EventLog(spark, f"{tmp_path}/log")
    left = dq.recorded(driver_lake(spark, "/root/testdata/sf0.001", number_lines=True), log, f"{tmp_path}/kept", "2001-12-01")
    assert {p.name for p in (tmp_path / "kept").iterdir()} == {"order_spine", "sv_payments", "sv_reviews"}
    assert left["sv_orders"].count() == 1500 and left["fct_order_items"].count() == 6000
