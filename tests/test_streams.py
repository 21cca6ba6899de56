"""Batches that break off, come again, come late or come in small: feeds, silver streams and histories."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelake.operators import hotkeys
from tidelake.operators.scd2 import history
from tidelake.sources.commits import CommittedTable
from tidelake.sources.eventlog import EventLog
from tidelake.sources.landing import SOURCES
from tidelake.streaming.bronze import ingest, read_bronze
from tidelake.streaming.history import HistoryTable
from tidelake.streaming.silver import counts, refresh

START = datetime(2018, 1, 1)
ORDERS = SOURCES["orders"]


def land(root: Path, name: str, *ids: str) -> None:
    folder = root / "landing" / "orders"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{i},c{i},delivered,2018-01-01 10:00:00,,,2018-01-05 00:00:00,2018-01-10 00:00:00" for i in ids]
    (folder / name).write_text("\n".join([",".join(ORDERS.columns), *lines]) + "\n")


def bring(spark, root: Path) -> None:
    ingest(spark, str(root / "landing"), ORDERS, str(root / "bronze/br_orders"), str(root / "cp/bronze")).awaitTermination()


def clean(spark, root: Path, log=None) -> None:
    refresh(
        spark, "sv_orders", str(root / "bronze"), str(root / "silver"), str(root / "cp/silver"), log=log
    ).awaitTermination()


def forget_commits(root: Path, name: str) -> None:
    """Let Spark believe that the batches of a stream were begun and never finished."""
    for entry in (root / "cp" / name / "commits").iterdir():
        entry.unlink()


def ids(df) -> list[str]:
    return sorted(r.order_id for r in df.select("order_id").collect())


@pytest.mark.parametrize("lost", [["bronze"], ["silver"], ["bronze", "silver"]])
def test_replayed_batches_reach_silver_once(spark, tmp_path, lost):
    log = EventLog(spark, str(tmp_path / "log"))
    land(tmp_path, "a.csv", "1", "2")
    bring(spark, tmp_path)
    clean(spark, tmp_path, log)
    for name in lost:
        forget_commits(tmp_path, name)
    land(tmp_path, "b.csv", "3")
    for _ in range(2):
        bring(spark, tmp_path)
        clean(spark, tmp_path, log)
    assert ids(CommittedTable(spark, str(tmp_path / "silver")).read()) == ["1", "2", "3"]
    assert ids(spark.read.parquet(str(tmp_path / "silver"))) == ["1", "2", "3"]
    assert counts(spark, str(tmp_path / "silver"))["valid_order_id__passed"] == 3
    logged = log.read("silver").filter("details LIKE '%valid_order_id%'")
    assert logged.count() == 2


def test_rows_without_a_manifest_are_seen_by_nobody(spark, tmp_path, monkeypatch):
    land(tmp_path, "a.csv", "1")
    bring(spark, tmp_path)
    land(tmp_path, "b.csv", "2", "3")
    commit = CommittedTable.commit

    def crash(self, *args):
        raise OSError("lost")

    monkeypatch.setattr(CommittedTable, "commit", crash)
    with pytest.raises(StreamingQueryException):
        bring(spark, tmp_path)
    monkeypatch.setattr(CommittedTable, "commit", commit)
    folder = str(tmp_path / "bronze/br_orders")
    assert len(list((tmp_path / "bronze/br_orders").glob("batch_id=*"))) == 2  # the rows are there
    assert ids(read_bronze(spark, ORDERS, folder)) == ["1"]
    clean(spark, tmp_path)
    assert ids(CommittedTable(spark, str(tmp_path / "silver")).read()) == ["1"]
    bring(spark, tmp_path)
    clean(spark, tmp_path)
    assert ids(read_bronze(spark, ORDERS, folder)) == ["1", "2", "3"]
    assert ids(CommittedTable(spark, str(tmp_path / "silver")).read()) == ["1", "2", "3"]


def test_a_new_checkpoint_does_not_overwrite(spark, tmp_path):
    land(tmp_path, "a.csv", "1")
    bring(spark, tmp_path)
    with pytest.raises(StreamingQueryException, match="committed by stream"):
        ingest(spark, str(tmp_path / "landing"), ORDERS, str(tmp_path / "bronze/br_orders"), str(tmp_path / "other")).awaitTermination()
    assert ids(read_bronze(spark, ORDERS, str(tmp_path / "bronze/br_orders"))) == ["1"]


def test_batches_without_rows_are_committed(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.append(spark.createDataFrame([], "id int"), 0, lambda: {"n": 0})
    table.commit(1)
    assert table.append(spark.createDataFrame([(1,)], "id int"), 2) and not table.append(spark.createDataFrame([(9,)], "id int"), 2)
    assert [r.id for r in table.read("id int").collect()] == [1]
    assert table.partitions() == ["batch_id=0", "batch_id=1", "batch_id=2"]


# -- histories


def expected(log):
    """Versions by brute force: key, value, start, end."""
    found = []
    for key in {k for k, _, _ in log}:
        kept = []
        for at, value in sorted({(a, v) for k, a, v in log if k == key}):
            if not kept or kept[-1][1] != value:
                kept.append((at, value))
        ends = [at for at, _ in kept[1:]] + [None]
        found += [(key, value, at, end) for (at, value), end in zip(kept, ends)]
    return sorted(found, key=repr)


def versions(table) -> list:
    return sorted(((r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in table.read().collect()), key=repr)


def stamped(rows):
    return [(k, START + timedelta(hours=h), v) for k, h, v in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, at timestamp, v string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_in_any_order_end_in_the_same_history(spark, tmp_path, seed):
    pick = random.Random(seed)
    log = stamped([(f"k{pick.randrange(6)}", pick.randrange(80), pick.choice("abc")) for _ in range(120)])
    if seed != 2:
        log.sort(key=lambda r: r[1])
    table = HistoryTable(spark, str(tmp_path), ["k"], "at", base_every=2)
    seen = []
    for number, a in enumerate(range(0, 120, 30)):
        batch = log[a : a + 30] + (log[:5] if number == 2 else [])
        table.apply(frame(spark, batch), number)
        table.apply(frame(spark, batch), number)
        seen += batch
        assert versions(table) == expected(seen)


def test_a_small_batch_writes_files_of_its_keys_only(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path), ["k"], "at")
    keys = spark.range(20_000).selectExpr("concat('k', id) AS k", "TIMESTAMP'2018-01-01' AS at", "'x' AS v")
    table.apply(keys, 0)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    touched = keys.filter("cast(substr(k, 2) AS int) % 33 = 1").limit(600)
    table.apply(touched.selectExpr("k", "TIMESTAMP'2018-02-01' AS at", "'y' AS v"), 1)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert all(after.get(p) == at for p, at in before.items())
    new = spark.read.parquet(*[str(p) for p in after if p not in before and "versions" in str(p)])
    assert new.select("k").distinct().count() == 600 and new.count() == 1200
    assert table.read().count() == 20_600


def test_a_history_with_no_rows_yet(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path), ["k"], "at")
    table.apply(frame(spark, []), 0)
    with pytest.raises(RuntimeError, match="no batch"):
        table.read()
    table.apply(frame(spark, stamped([("a", 1, "x")])), 1)
    table.apply(frame(spark, []), 2)
    assert versions(table) == expected(stamped([("a", 1, "x")]))
    with pytest.raises(ValueError, match="comes after"):
        table.apply(frame(spark, stamped([("a", 2, "x")])), 0 - 1)


def test_a_broken_off_batch_does_not_count(spark, tmp_path, monkeypatch):
    table = HistoryTable(spark, str(tmp_path), ["k"], "at")
    first, second = stamped([("a", 1, "x"), ("b", 1, "x")]), stamped([("a", 2, "y"), ("b", 0, "z")])
    table.apply(frame(spark, first), 0)
    commit = CommittedTable.commit
    monkeypatch.setattr(CommittedTable, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.apply(frame(spark, second), 1)
    monkeypatch.setattr(CommittedTable, "commit", commit)
    assert versions(table) == expected(first)
    table.apply(frame(spark, second), 1)
    assert versions(table) == expected(first + second)


# -- hot keys


@pytest.mark.parametrize("kind", ["one stamp", "a burst", "even"])
def test_no_segment_of_a_hot_key_is_large(spark, kind):
    second = {"one stamp": "0", "a burst": "CASE WHEN id < 10 THEN id * 3000000 ELSE 15000000 + id % 50 END", "even": "id * 300"}[kind]
    log = spark.range(100_000).selectExpr(
        "CASE WHEN id % 1000 = 999 THEN concat('k', id) ELSE 'hot' END AS k",
        f"timestamp_seconds(1500000000 + {second}) AS at", "md5(cast(id AS string)) AS v",
    )
    log = log.unionByName(log.limit(2000))  # repeated deliveries
    rows = hotkeys.segment_by_rank(log, ["k"], ["at", "v"], 5000)
    sizes = rows.filter("k = 'hot'").groupBy(hotkeys.SEGMENT).count().collect()
    assert all(r[hotkeys.SEGMENT] is not None for r in sizes)
    assert max(r["count"] for r in sizes) <= 10_000 and sum(r["count"] for r in sizes) == 99_900
    assert rows.filter(f"k <> 'hot' AND {hotkeys.SEGMENT} IS NOT NULL").isEmpty()
    ordered = rows.filter("k = 'hot'").groupBy(hotkeys.SEGMENT).agg(F.min(F.struct("at", "v")).alias("a"), F.max(F.struct("at", "v")).alias("b"))
    found = sorted((r[0], tuple(r.a), tuple(r.b)) for r in ordered.collect())
    assert all(x[2] < y[1] for x, y in zip(found, found[1:]))
    cut, whole = (history(log, ["k"], "at", max_rows=n) for n in (5000, 10**6))
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()


def test_short_segments_cost_no_partition_each(spark):
    log = spark.range(40_000).selectExpr("'hot' AS k", "timestamp_seconds(1500000000 + id % 900) AS at", "md5(cast(id AS string)) AS v")
    rows = hotkeys.segment_by_rank(log, ["k"], ["at", "v"], 100)
    assert len(rows.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(hotkeys.SEGMENT).count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert sizes[0] <= 50 and sizes[1] == 40_000 and sizes[2] >= 800


def test_history_reads_its_log_for_late_rows_only(spark, tmp_path, monkeypatch):
    table = HistoryTable(spark, str(tmp_path), ["k"], "at")
    built, derive = [], table._history
    monkeypatch.setattr(table, "_history", lambda rows: built.append(rows) or derive(rows))
    read = []
    for number, rows in enumerate([[("a", 1, "x"), ("b", 1, "x")], [("a", 3, "y")], [("a", 2, "z"), ("b", 4, "y")]]):
        built.clear()
        table.apply(spark.createDataFrame(rows, "k string, at int, v string"), number)
        read.append(sum("/log" in f and f"batch_id={number}" not in f for df in built for f in df.inputFiles()))
    assert read[:2] == [0, 0] and read[2] > 0
    found = {(r.k, r.v, r["__START_AT"], r["__END_AT"]) for r in table.read().collect()}
    assert found == {("a", "x", 1, 2), ("a", "z", 2, 3), ("a", "y", 3, None), ("b", "x", 1, 4), ("b", "y", 4, None)}
