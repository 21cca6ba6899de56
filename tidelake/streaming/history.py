"""Incremental type 2 history.

A batch writes what it changes and nothing else: its rows into the change log, and for the keys it touches the
versions that are new or closed by it. Closed versions stay as written. Open ones are a state of one row a key, of which
the youngest batch's row counts; every ``base_every`` batches that state is written out whole, so a reader meets a key in few files.

Rows that come later than all its key has seen continue from the key's open version alone. A key that gets an earlier
row is derived anew from its whole log, and its older closed versions no longer count from that batch on. The history is thus a
pure function of the log: late, reversed or replayed batches end in the same versions. A batch counts from the moment its
manifest is there; the view over the table then moves on to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.hotkeys import MAX_ROWS, attach
from tidelake.operators.scd2 import END, START, history
from tidelake.sources.commits import BATCH, ONE_RUN, CommittedTable

LAST, KIND = "__LAST", "kind"


class Standing(NamedTuple):
    """What is committed: the newest batch, the newest one with the whole state, and whether any had late rows."""

    last: int
    base: int
    late: bool


class HistoryTable:
    """A history kept up to date from batches of change rows, whose numbers rise."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        sequence: str,
        track: Sequence[str] | None = None,
        max_rows: int = MAX_ROWS,
        base_every: int = 16,
    ):
        self.spark, self.root = spark, root
        self.keys, self.sequence = list(keys), sequence
        self.track, self.max_rows, self.base_every = track, max_rows, base_every
        self.commits = CommittedTable(spark, root)
        self.log_folder, self.folder, self.late_folder = (f"{root}/{part}" for part in ("log", "versions", "late"))

    def standing(self) -> Standing | None:
        """The committed state; None before the first batch with rows."""
        if not self.commits.exists():
            return None
        base = F.when(F.expr("counts['base'] > 0"), F.col(BATCH))
        found = self.commits.commits().filter("counts['rows'] > 0").agg(
            F.max(BATCH).alias("last"), F.max(base).alias("base"), F.sum(F.expr("counts['late']")).alias("late")
        ).first()
        return None if found.last is None else Standing(found.last, found.base or 0, bool(found.late))

    def _open(self, at: Standing) -> str:
        """SQL for the open version of every key."""
        return f"""SELECT state.* FROM (
            SELECT max_by(struct(*), {BATCH}) AS state FROM parquet.`{self.folder}`
            WHERE {KIND} = 'open' AND {BATCH} BETWEEN {at.base} AND {at.last} GROUP BY {", ".join(f"`{k}`" for k in self.keys)})"""

    def _closed(self, at: Standing) -> str:
        """SQL for the closed versions that no late row has overtaken."""
        found = f"SELECT * FROM parquet.`{self.folder}` v WHERE {KIND} = 'closed' AND {BATCH} <= {at.last}"
        if not at.late:
            return found
        same = " AND ".join(f"l.`{k}` <=> v.`{k}`" for k in self.keys)
        return f"""{found} AND NOT EXISTS (
            SELECT 1 FROM parquet.`{self.late_folder}` l WHERE {same} AND l.{BATCH} > v.{BATCH} AND l.{BATCH} <= {at.last})"""

    def sql(self) -> str:
        """The committed history as a statement over files, fit for a view."""
        at = self.standing()
        if at is None:
            raise RuntimeError(f"no batch of {self.root} is committed")
        stored = self.spark.read.parquet(self.folder).columns
        columns = ", ".join(f"`{c}`" for c in stored if c not in (BATCH, KIND, LAST))
        return f"SELECT {columns} FROM ({self._closed(at)}) UNION ALL SELECT {columns} FROM ({self._open(at)})"

    def read(self) -> DataFrame:
        return self.spark.sql(self.sql())

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Log the rows of a batch, then write the versions it opens, closes or changes."""
        if self.commits.has(batch_id):
            return
        at = self.standing()
        if at is not None and batch_id < at.last:
            raise ValueError(f"batch {batch_id} comes after batch {at.last}")
        rows = self._stored(batch, self.log_folder, batch_id)
        if rows.isEmpty():
            self.commits.commit(batch_id, {"rows": 0})
            return
        touched = rows.groupBy(*self.keys).agg(F.min(self.sequence).alias("__first"), F.max(self.sequence).alias("__newest"))
        if at is None:
            late, whole = 0, True
            versions = self._with_last(self._history(rows), touched)
        else:
            late, versions = self._continued(rows, touched, at, batch_id)
            whole = batch_id - at.base >= self.base_every
        if whole and at is not None:
            untouched = attach(self.spark.sql(self._open(at)), touched, self.keys).filter("__first IS NULL")
            versions = versions.unionByName(untouched.select(versions.columns))
        kind = F.when(F.col(END).isNull(), "open").otherwise("closed")
        written = versions.withColumn(KIND, kind).write.partitionBy(KIND).mode("overwrite")
        written.parquet(f"{self.folder}/{BATCH}={batch_id}")
        self.commits.commit(batch_id, {"rows": 1, "base": int(whole), "late": late})

    def _stored(self, df: DataFrame, folder: str, batch_id: int) -> DataFrame:
        """Write a batch's part of a folder and read it again, in the session that plans adaptively."""
        df.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")
        return self.spark.read.schema(df.schema).parquet(f"{folder}/{BATCH}={batch_id}")

    def _history(self, rows: DataFrame) -> DataFrame:
        return history(rows, self.keys, self.sequence, track=self.track, max_rows=self.max_rows)

    def _with_last(self, versions: DataFrame, seen: DataFrame) -> DataFrame:
        """With the newest sequence value that the key has seen."""
        newest = seen.select(*self.keys, F.col("__newest").alias(LAST))
        return attach(versions, newest, self.keys)

    def _continued(self, rows: DataFrame, touched: DataFrame, at: Standing, batch_id: int) -> tuple[int, DataFrame]:
        """How many keys have late rows, and the versions of all touched keys that this batch writes.

        Without late rows the log is not read, and nothing is marked.
        """
        state = self.spark.sql(self._open(at)).drop(BATCH, KIND)
        held = attach(state, touched, self.keys).filter("__first IS NOT NULL")
        late = self._stored(held.filter(F.col(LAST) >= F.col("__first")).select(*self.keys), self.late_folder, batch_id)
        late_keys = late.count()
        marked = late.withColumn("__late", F.lit(True))

        def in_time(df: DataFrame) -> DataFrame:
            return attach(df, marked, self.keys).filter("__late IS NULL") if late_keys else df

        carried = [c for c in state.columns if c not in (START, END, LAST)]
        seeds = in_time(held).select(*[F.col(START).alias(c) if c == self.sequence else F.col(c) for c in carried])
        versions = self._history(seeds.unionByName(in_time(rows).select(*carried)))
        if late_keys:
            log = self.spark.read.parquet(self.log_folder).filter(F.col(BATCH) <= batch_id)
            again = attach(log, marked, self.keys).filter("__late").select(*rows.columns)
            versions = versions.unionByName(self._history(again))

        seen = attach(touched, held.select(*self.keys, LAST), self.keys)
        seen = seen.withColumn("__newest", F.greatest("__newest", LAST)).drop(LAST)
        return late_keys, self._with_last(versions, seen)

    def follow(self, feed: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Keep the history up to date from a stream of change rows."""
        return (
            feed.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or ONE_RUN))
            .start()
        )
