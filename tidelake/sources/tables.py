"""Stored tables: full-recompute publishing, and reading by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidelake.operators.expectations import Rule, drop_failing, guard, observed, outcomes, rules_for
from tidelake.session import delete_folder
from tidelake.sources.eventlog import EventLog

DESCRIPTIONS = {
    "bronze": "Rows as landed, all columns text, with the file and time they came by; append-only",
    "silver": "Typed rows under expectations; append-only",
    "gold": "Star schema and marts, recomputed in full",
    "ops": "Reports and helper tables",
}
LAYERS = tuple(DESCRIPTIONS)


def _bare(folder: str) -> str:
    """A folder without its scheme, which the catalog may spell in several ways."""
    return folder.split(":", 1)[-1].strip("/")


class Tables:
    """Catalog tables ``<layer>.<name>`` over parquet folders under ``root``.

    ``namespace`` keeps environments of one catalog apart: schemas are then ``<namespace>_<layer>``.

    A recomputed table has two folders. A publish overwrites the one the catalog does not point
    at and then moves the pointer: a failing write (for instance a broken ``fail`` expectation)
    leaves the previous contents in place, a table may be recomputed from itself, and queries that
    started on the old contents finish on them.
    """

    def __init__(self, spark: SparkSession, root: str, namespace: str = ""):
        self.spark, self.namespace = spark, namespace
        self.root = root.rstrip("/")
        self.log = EventLog(spark, f"{self.root}/ops/event_log")
        for layer in LAYERS:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema(layer)} LOCATION '{self.root}/{layer}'")

    def schema(self, layer: str) -> str:
        return f"{self.namespace}_{layer}" if self.namespace else layer

    def drop(self) -> None:
        """Forget the tables of a private namespace; their folders stay."""
        if not self.namespace:
            raise ValueError("the common schemas are not dropped")
        for layer in LAYERS:
            self.spark.sql(f"DROP SCHEMA IF EXISTS {self.schema(layer)} CASCADE")

    def folder(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.table(f"{self.schema(layer)}.{name}")

    def exists(self, layer: str, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.schema(layer)}.{name}")

    def publish(
        self, layer: str, name: str, df: DataFrame, rules: Sequence[Rule] | None = None
    ) -> None:
        """Replace a table, schema included, enforcing and counting its rules in the same pass."""
        rules = rules_for(name) if rules is None else rules
        counted, observation = observed(df, rules, name)
        self.replace(layer, name, guard(drop_failing(counted, rules), rules, name))
        if observation is not None:
            self.log.append(layer, outcomes(observation.get, rules, name))

    def replace(self, layer: str, name: str, df: DataFrame, keep_previous: bool = True) -> None:
        """Write the idle folder, then make the table read it. Without ``keep_previous`` what it read before is removed.

        Digests are a large part of stored rows; texts of sixteen letters take half their size under an entropy coder.
        """
        target = self._idle_folder(layer, name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(target)
        self._point(layer, name, target)
        if not keep_previous:
            delete_folder(self.spark, self._idle_folder(layer, name))

    def attach(self, layer: str, name: str, folder: str, partitions: Sequence[str] | None = None) -> None:
        """Register an append-only folder as a table, or pick up what was appended to it.

        ``partitions`` (``column=value``) are those that the table shall show; others in the folder stay out.
        """
        table = f"{self.schema(layer)}.{name}"
        if self.exists(layer, name) and _bare(self._location(table)) != _bare(folder):
            self.spark.sql(f"DROP TABLE {table}")
        if not self.exists(layer, name):
            self.spark.catalog.createTable(table, path=folder, source="parquet", description=DESCRIPTIONS[layer])
            self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quality' = '{layer}')")
        if partitions is not None:
            shown = {r.partition for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}
            new = [p.split("=", 1) for p in partitions if p not in shown]
            for i in range(0, len(new), 500):
                added = " ".join(f"PARTITION ({column} = '{value}')" for column, value in new[i : i + 500])
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
        self.spark.catalog.refreshTable(table)

    def show(self, layer: str, name: str, statement: str) -> None:
        """Make a view under the table's name, or move it on to another state: one metadata call."""
        view = f"{self.schema(layer)}.{name}"
        comment = DESCRIPTIONS[layer].replace("'", "''")
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT '{comment}' TBLPROPERTIES ('quality' = '{layer}') AS {statement}")
        self.spark.catalog.refreshTable(view)

    def _idle_folder(self, layer: str, name: str) -> str:
        base = self.folder(layer, name)
        if not self.exists(layer, name):
            return f"{base}/a"
        in_use = _bare(self._location(f"{self.schema(layer)}.{name}"))
        return f"{base}/b" if in_use == _bare(f"{base}/a") else f"{base}/a"

    def _location(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
        return described.filter("col_name = 'Location'").first().data_type

    def _point(self, layer: str, name: str, target: str) -> None:
        """One metadata call when the schema is unchanged, else the table is declared anew."""
        table = f"{self.schema(layer)}.{name}"
        written = self.spark.read.parquet(target).schema
        if self.exists(layer, name) and self.read(layer, name).schema == written:
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
            self.spark.catalog.refreshTable(table)
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.catalog.createTable(table, path=target, source="parquet")
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quality' = '{layer}')")
