import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from tidelake.contracts import AUDIT_COLUMNS
from tidelake.operators.expectations import Rule, guard
from tidelake.operators.layout import optimise
from tidelake.plans.dq import expectation_report
from tidelake.session import scratch_folder, size_shuffles
from tidelake.sources.eventlog import EventLog
from tidelake.sources.landing import SOURCES, LandingError, Source, landing_report, require_landing
from tidelake.sources.tables import Tables
from tidelake.streaming.bronze import ingest, ingest_by_position, read_bronze, stream_bronze
from tidelake.streaming.history import HistoryTable
from tidelake.streaming.silver import counts, refresh


def put(folder: Path, name: str, text: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def land(spark, root: Path, name: str, start=ingest):
    start(
        spark, str(root / "landing"), SOURCES[name], str(root / "bronze"), str(root / "checkpoint")
    ).awaitTermination()
    return read_bronze(spark, SOURCES[name], str(root / "bronze"))


def test_landing_gate(spark, tmp_path, rows):
    put(tmp_path / "orders" / "2018" / "01", "a.csv", "x\n1\n")
    put(tmp_path / "orders", "b.csv", "x\n1\n")
    put(tmp_path / "sellers", "readme.txt", "no data")
    wanted = ("orders", "sellers", "products")
    report = landing_report(spark, str(tmp_path), wanted)
    assert rows(report) == [("orders", 2), ("products", -1), ("sellers", 0)]
    with pytest.raises(LandingError, match="products: folder missing; sellers: no CSV files"):
        require_landing(spark, str(tmp_path), wanted)
    assert require_landing(spark, str(tmp_path), ("orders",)) == 2


@pytest.mark.parametrize("start", [ingest, ingest_by_position])
def test_only_new_files_are_taken(spark, tmp_path, rows, start):
    folder = tmp_path / "landing" / "category_translation"
    header = "product_category_name,product_category_name_english\n"
    put(folder, "a.csv", header + "moveis,furniture\n")
    assert land(spark, tmp_path, "category_translation", start).count() == 1
    assert land(spark, tmp_path, "category_translation", start).count() == 1
    put(folder / "later", "b.csv", header + '"a ""b"", c",x\n')
    bronze = land(spark, tmp_path, "category_translation", start)
    assert rows(bronze, "product_category_name", "product_category_name_english") == [
        ('a "b", c', "x"), ("moveis", "furniture"),
    ]
    audit = bronze.select(*AUDIT_COLUMNS).filter("product_category_name_english = 'x'").first()
    assert audit._source_file.endswith("b.csv") and audit._source_system == "category_translation"
    assert audit._ingested_at is not None


def test_crash_between_write_and_commit_adds_nothing_twice(spark, tmp_path, rows):
    header = "product_category_name,product_category_name_english\n"
    put(tmp_path / "landing" / "category_translation", "a.csv", header + "a,1\nb,2\n")
    land(spark, tmp_path, "category_translation")
    # Without its commit entry the batch is run again on restart.
    for entry in (tmp_path / "checkpoint" / "commits").iterdir():
        entry.unlink()
    put(tmp_path / "landing" / "category_translation", "b.csv", header + "c,3\n")
    bronze = land(spark, tmp_path, "category_translation")
    assert rows(bronze, "product_category_name") == [("a",), ("b",), ("c",)]


def test_headers_are_matched_by_name(spark, tmp_path, rows):
    folder = tmp_path / "landing" / "sellers"
    put(folder, "a.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,SP\n")
    put(folder, "b.csv", "seller_state,seller_id,rating,seller_city,seller_zip_code_prefix\n"
                         "RJ,s2,5,y,2\nRJ,s3,,z,3\n")
    put(folder, "c.csv", "﻿seller_id,seller_state\r\ns4,MG\r\n")
    put(folder, "d.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns5,5,w,BA,extra\n")
    put(folder, "e.csv", "")
    bronze = land(spark, tmp_path, "sellers")
    columns = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
    assert rows(bronze, *columns) == [
        ("s1", "1", "x", "SP"), ("s2", "2", "y", "RJ"), ("s3", "3", "z", "RJ"),
        ("s4", None, None, "MG"), ("s5", "5", "w", "BA"),
    ]
    rescued = {r.seller_id: r._rescued_data for r in bronze.collect()}
    assert json.loads(rescued["s2"]) == {"rating": "5"}
    assert json.loads(rescued["s5"]) == {"_raw_line": "s5,5,w,BA,extra"}
    assert rescued["s1"] is rescued["s3"] is rescued["s4"] is None


def test_reviews_span_lines(spark, tmp_path, rows):
    header = ",".join(SOURCES["reviews"].columns)
    put(
        tmp_path / "landing" / "reviews", "a.csv",
        f'{header}\nr1,o1,5,,"first\nsecond ""quoted""",2018-01-01,2018-01-02\n'
        "r2,o2,1,t,m,2018-01-01,2018-01-02\n",
    )
    bronze = land(spark, tmp_path, "reviews")
    assert rows(bronze, "review_id", "review_comment_message") == [
        ("r1", 'first\nsecond "quoted"'), ("r2", "m"),
    ]


def test_replayed_batch_adds_nothing(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path), ["k"], "at")
    first = spark.sql("SELECT 'a' AS k, TIMESTAMP'2018-01-01' AS at, 'x' AS v")
    second = spark.sql("SELECT 'a' AS k, TIMESTAMP'2018-02-01' AS at, 'y' AS v")
    for batch, number in ((second, 0), (first, 1), (first, 1), (second, 0)):
        table.apply(batch, number)
    got = sorted((str(r["__START_AT"])[:10], r.v, r["__END_AT"] is None) for r in table.read().collect())
    assert got == [("2018-01-01", "x", False), ("2018-02-01", "y", True)]
    assert spark.read.parquet(table.log_folder).count() == 2


def test_silver_stream_counts_and_quarantine(spark, tmp_path, rows):
    header = ",".join(SOURCES["orders"].columns)
    put(
        tmp_path / "landing" / "orders", "a.csv",
        f"{header}\n"
        "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 00:00:00,2018-01-10 00:00:00\n"
        "o2,c2,shipped,2018-01-01 10:00:00,,,2018-01-05 00:00:00,2018-01-10 00:00:00\n"
        "o3,,delivered,2018-01-01 10:00:00,,,,2018-01-10 00:00:00\n"
        "o4,c4,mystery,2018-01-01 10:00:00,,,,2018-01-10 00:00:00\n",
    )
    ingest(
        spark, str(tmp_path / "landing"), SOURCES["orders"], str(tmp_path / "bronze/br_orders"),
        str(tmp_path / "cp/b"),
    ).awaitTermination()
    found = {}
    for dataset in ("sv_orders", "sv_quarantine_orders"):
        query = refresh(
            spark, dataset, str(tmp_path / "bronze"), str(tmp_path / dataset),
            str(tmp_path / "cp" / dataset),
        )
        query.awaitTermination()
        found[dataset] = counts(spark, str(tmp_path / dataset))
    assert rows(spark.read.parquet(str(tmp_path / "sv_orders")), "order_id") == [("o1",), ("o2",)]
    quarantined = spark.read.parquet(str(tmp_path / "sv_quarantine_orders"))
    assert rows(quarantined, "order_id", "_quarantine_reason") == [
        ("o2", "undelivered_with_date"), ("o3", "delivered_without_date"),
    ]
    assert found["sv_orders"]["valid_customer_id__failed"] == 1
    assert found["sv_orders"]["known_status__failed"] == 1
    assert found["sv_orders"]["delivered_has_date__failed"] == 1
    assert found["sv_orders"]["known_status__passed"] == 3


def test_a_stream_stops_at_a_broken_fail_rule(spark, tmp_path):
    spark.sql("SELECT 1 AS id UNION ALL SELECT NULL").write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema("id int").parquet(str(tmp_path / "in"))
    query = (
        guard(feed, [Rule("has_id", "fail", "id IS NOT NULL")], "t")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    with pytest.raises(StreamingQueryException, match="has_id"):
        query.awaitTermination()
    assert spark.read.schema("id int").parquet(str(tmp_path / "out")).count() == 0


def test_bronze_feed_is_a_stream_of_new_rows(spark, tmp_path):
    put(tmp_path / "landing" / "sellers", "a.csv",
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,SP\n")
    land(spark, tmp_path, "sellers")
    feed = stream_bronze(spark, SOURCES["sellers"], str(tmp_path / "bronze"))
    assert feed.isStreaming and "batch_id" not in feed.columns


def test_failed_publish_keeps_the_table(spark, tmp_path, rows):
    tables = Tables(spark, str(tmp_path))
    rule = [Rule("has_id", "fail", "id IS NOT NULL"), Rule("small", "warn", "id < 2")]
    tables.publish("ops", "t", spark.createDataFrame([(1,), (2,)], "id int"), rule)
    with pytest.raises(PySparkException):
        tables.publish("ops", "t", spark.createDataFrame([(None,)], "id int"), rule)
    assert rows(tables.read("ops", "t")) == [(1,), (2,)]
    # Recomputed from itself, and with another schema.
    tables.publish("ops", "t", tables.read("ops", "t").filter("id = 1"), rule)
    assert rows(tables.read("ops", "t")) == [(1,)]
    tables.publish("ops", "t", tables.read("ops", "t").withColumn("more", F.lit("x")), rule)
    assert rows(tables.read("ops", "t")) == [(1, "x")]
    # However often it is published, a table keeps two folders.
    assert sorted(p.name for p in (tmp_path / "ops" / "t").iterdir()) == ["a", "b"]
    report = expectation_report({"ops": lambda: tables.log.read("ops")})
    assert rows(report, "expectation", "total_passed", "total_failed") == [
        ("has_id", 4, 0), ("small", 3, 1),
    ]


def test_report_tolerates_an_unreadable_log(spark, tmp_path, rows):
    log = EventLog(spark, str(tmp_path / "log"))
    entry = {"name": "n", "dataset": "d", "passed_records": 3, "failed_records": 1}
    log.append("silver", [entry])
    log.append("silver", [{**entry, "failed_records": 5}])
    missing = EventLog(spark, str(tmp_path / "nothing"))
    logs = {"silver": lambda: log.read("silver"), "gold": lambda: missing.read("gold")}
    assert rows(expectation_report(logs), "layer", "total_passed", "total_failed") == [
        ("silver", 6, 6)
    ]
    newest = expectation_report(logs, latest_only=True)
    assert rows(newest, "total_passed", "total_failed") == [(3, 5)]
    with pytest.raises(RuntimeError):
        expectation_report({"gold": lambda: missing.read("gold")})


def test_layout_reports_each_step(spark, tmp_path, rows):
    tables = Tables(spark, str(tmp_path))
    tables.publish("ops", "facts", spark.range(1000).selectExpr("id % 7 AS k", "id AS v"), [])
    got = optimise(
        spark, lambda name, frame: tables.replace("ops", name, frame),
        {"facts": ("k", "v"), "absent": ("k",)}, layer="ops", files=3,
    )
    status = {(r.table, r.step.split()[0]): r.status for r in got.collect()}
    assert status[("ops.facts", "cluster")] == status[("ops.facts", "statistics")] == "done"
    assert status[("ops.absent", "cluster")].startswith("skipped")
    assert status[("ops.absent", "statistics")].startswith("skipped")
    stored = tables.read("ops", "facts")
    assert stored.count() == 1000 and len(stored.inputFiles()) == 3


def test_namespaces_keep_tables_apart(spark, tmp_path):
    common, private = Tables(spark, str(tmp_path / "a")), Tables(spark, str(tmp_path / "b"), "trial")
    common.publish("ops", "facts", spark.range(3), [])
    private.publish("ops", "facts", spark.range(5), [])
    assert (common.read("ops", "facts").count(), private.read("ops", "facts").count()) == (3, 5)
    private.drop()
    assert common.read("ops", "facts").count() == 3 and not private.exists("ops", "facts")
    with pytest.raises(ValueError):
        common.drop()


def test_no_landed_file_is_lost(spark, tmp_path, rows, caplog):
    """Blank first lines, other suffixes, compressed files; only files without a line are skipped, and said so."""
    import gzip

    source, folder = Source("s", ("a", "b")), tmp_path / "landing" / "s"
    folder.mkdir(parents=True)
    (folder / "blank.csv").write_text("\n  \r\na,b\n1,x\n")
    (folder / "UPPER.CSV").write_text("b,a\nx,2\n")
    (folder / "plain").write_text("a,b\n3,x")
    (folder / "zipped.csv.gz").write_bytes(gzip.compress(b"\na,b\n4,x\n"))
    (folder / "header.csv").write_text("a,b\n")
    (folder / "nothing.csv").write_text("\n\n")
    (folder / "_hidden.csv").write_text("a,b\n9,x\n")
    ingest(spark, str(tmp_path / "landing"), source, str(tmp_path / "bronze"), str(tmp_path / "cp")).awaitTermination()
    stored = read_bronze(spark, source, str(tmp_path / "bronze"))
    assert rows(stored, "a", "b") == [(str(i), "x") for i in (1, 2, 3, 4)]
    assert "nothing.csv" in caplog.text


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffles(spark, 10) == 4
        assert size_shuffles(spark, 100 << 30) == 200
        assert size_shuffles(spark, 10) == 200  # never lowered
        assert size_shuffles(spark, 100 << 40) == 100_000
    finally:
        spark.conf.unset(key)


def test_streams_can_keep_running(spark, tmp_path):
    put(tmp_path / "landing" / "sellers", "a.csv",
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,x,SP\n")
    query = ingest(
        spark, str(tmp_path / "landing"), SOURCES["sellers"], str(tmp_path / "bronze"),
        str(tmp_path / "cp"), trigger={"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert read_bronze(spark, SOURCES["sellers"], str(tmp_path / "bronze")).count() == 1
    finally:
        query.stop()


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second
    assert first.startswith(shared or "/")
