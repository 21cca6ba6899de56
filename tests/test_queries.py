"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract
from checks.compare import TABLES, rows_of
from tidelake.plans.catalogue import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables not present")
RUNS_JOBS = {
    "csv_ingest", "csv_drift", "csv_awkward_files", "csv_reviews", "scd2_incremental", "scd2_three_batches", "scd2_hot_key",
    "stream_silver_orders", "stream_rule_counts", "stream_spoiled_orders", "layout_report", "csv_inferred", "csv_all_sources", "csv_audit",
    "landing_gate", "stream_quarantine", "fail_rules", "layout_skipping", "dq_expectation_report", "q07_quality_summary", "grain_report",
}


@pytest.fixture(scope="module")
def sql():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield db
    db.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 80


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    result = contract.queries()[name](spark, str(FOLDER))
    relation = sql.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(relation.columns)
    assert rows_of(result.columns, result.collect()) == rows_of(
        relation.columns, relation.fetchall()
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS_JOBS))
def test_plan_stays_in_the_jvm_without_cross_joins(spark, name, capsys):
    contract.queries()[name](spark, str(FOLDER)).explain("simple")
    plan = capsys.readouterr().out
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas",
                     "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    "name, table, wanted, unwanted",
    [
        ("mart_monthly_revenue", "l_orderkey", ("l_extendedprice", "l_tax"),
         ("l_partkey", "l_suppkey", "l_shipdate", "l_quantity")),
        ("q09_gmv_total", "l_orderkey", ("l_extendedprice",), ("l_partkey", "l_suppkey")),
        ("q04_reviews_by_lateness", "event_id", ("props",), ("user_id", "value", "ts:")),
    ],
)
def test_scans_read_only_needed_columns(spark, capsys, name, table, wanted, unwanted):
    contract.queries()[name](spark, str(FOLDER)).explain("formatted")
    schemas = [
        line for line in capsys.readouterr().out.splitlines()
        if line.startswith("ReadSchema") and table in line
    ]
    assert schemas
    for schema in schemas:
        assert all(column in schema for column in wanted)
        assert not any(column in schema for column in unwanted)


def test_filters_reach_the_scan(spark, capsys):
    contract.queries()["q10_ontime_rate"](spark, str(FOLDER)).explain("formatted")
    assert "PushedFilters: [IsNotNull(l_linenumber)]" in capsys.readouterr().out


def test_lines_move_once_and_without_digests(spark):
    """Numbering leaves lines where the join with orders looks for them, and keys are made of what has arrived."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = contract.queries()["fct_order_items"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    lines = plan.split("FileScan parquet [l_")[0]
    assert lines.count("Exchange ") == 1 and "sha2(" in lines
    assert "sha2(" not in plan[plan.index("Exchange ") :]
