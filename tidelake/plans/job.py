"""The whole job: gate, bronze, silver, gold, then report and layout."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidelake.contracts import CALENDAR_RANGE
from tidelake.operators.layout import optimise
from tidelake.plans.dq import expectation_report, stamped_report
from tidelake.plans.lake import GOLD_STAGES, Lake
from tidelake.plans.security import create_views
from tidelake.session import size_shuffles
from tidelake.sources.commits import BATCH, CommittedTable
from tidelake.sources.landing import SOURCES, landed_bytes, require_landing
from tidelake.sources.tables import Tables
from tidelake.streaming.bronze import follow_bronze, ingest_all, read_bronze
from tidelake.streaming.history import HistoryTable
from tidelake.streaming.silver import FEEDS, refresh_all

RECOMPUTED = ("sv_customers", "sv_geolocation", "sv_category_translation")
HISTORIES = {
    "sv_sellers_history": ("sellers", "seller_id"),
    "sv_products_history": ("products", "product_id"),
}


class Job:
    """Run the layers over ``landing`` into tables under ``root``; a rerun takes only what is new.

    Steps are plain methods, so each layer can also be refreshed on its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        root: str,
        calendar: tuple[str, str] = CALENDAR_RANGE,
        region: tuple[str, ...] = ("SP",),
        namespace: str = "",
    ):
        self.spark, self.landing, self.root = spark, landing, root
        self.calendar, self.region = calendar, region
        self.tables = Tables(spark, root, namespace)
        self.checkpoints = f"{root}/checkpoints"

    def gate(self) -> int:
        """File count of the landing; also sizes the shuffles of the run by what has landed."""
        files = require_landing(self.spark, self.landing)
        size_shuffles(self.spark, landed_bytes(self.spark, self.landing))
        return files

    def bronze(self) -> None:
        ingest_all(self.spark, self.landing, f"{self.root}/bronze", self.checkpoints)
        for source in SOURCES:
            name = f"br_{source}"
            self._attach_committed("bronze", name)

    def silver(self) -> None:
        """All streams side by side, then the tables that are recomputed in full."""
        histories = {}
        for dataset, (source, key) in HISTORIES.items():
            table = HistoryTable(
                self.spark, self.tables.folder("silver", dataset), [key], "_ingested_at"
            )
            query = follow_bronze(
                self.spark, SOURCES[source], self.tables.folder("bronze", f"br_{source}"),
                table.apply, f"{self.checkpoints}/{dataset}", dataset,
            )
            histories[dataset] = (query, table)
        refresh_all(
            self.spark, f"{self.root}/bronze", f"{self.root}/silver", self.checkpoints,
            self.tables.log,
        )
        for dataset in FEEDS:
            self._attach_committed("silver", dataset)
        for dataset, (query, table) in histories.items():
            query.awaitTermination()
            self.tables.show("silver", dataset, table.sql())
        self._publish("silver", RECOMPUTED, self._bronze_frames())

    def gold(self) -> None:
        """Publish gold tables; each stage reads the stored tables of those before it.

        Orders with their person are stored once between dimensions and facts, because all three
        facts look them up.
        """
        stored = {
            name: self.tables.read("silver", name).drop(BATCH)
            for name in (*FEEDS, *HISTORIES, *RECOMPUTED)
        }
        dimensions, facts, marts = GOLD_STAGES
        for layer, stage in (
            ("gold", dimensions), ("ops", ("order_spine",)), ("gold", facts), ("gold", marts)
        ):
            self._publish(layer, stage, stored)
            stored |= {name: self.tables.read(layer, name) for name in stage}
        create_views(self.spark, self.region, *map(self.tables.schema, ("gold", "security")))

    def _attach_committed(self, layer: str, name: str) -> None:
        folder = self.tables.folder(layer, name)
        self.tables.attach(layer, name, folder, CommittedTable(self.spark, folder).partitions())

    def _publish(self, layer: str, names: tuple[str, ...], inputs: dict[str, DataFrame]) -> None:
        """Publish tables that do not depend on each other as concurrent jobs."""
        lake = Lake(self.spark, inputs, calendar=self.calendar)
        frames = {name: lake.before_rules(name) for name in names}
        with ThreadPoolExecutor(len(names)) as pool:
            jobs = [
                pool.submit(self.tables.publish, layer, name, frame)
                for name, frame in frames.items()
            ]
            for job in jobs:
                job.result()

    def report(self) -> DataFrame:
        """Refresh the expectation report table."""
        self.tables.log.define(self.tables.schema("ops"))
        self.tables.log.define()
        logs = {
            layer: lambda layer=layer: self.spark.sql(f"SELECT * FROM event_log('{layer}')")
            for layer in ("silver", "gold")
        }
        self.tables.publish("ops", "dq_expectation_report", stamped_report(expectation_report(logs)))
        return self.tables.read("ops", "dq_expectation_report")

    def layout(self) -> DataFrame:
        return optimise(
            self.spark, partial(self.tables.replace, "gold"), layer=self.tables.schema("gold")
        )

    def run(self) -> int:
        """Everything in order; report and layout do not depend on each other and run together."""
        files = self.gate()
        self.bronze()
        self.silver()
        self.gold()
        with ThreadPoolExecutor(2) as pool:
            for step in [pool.submit(self.report), pool.submit(self.layout)]:
                step.result()
        return files

    def _bronze_frames(self) -> dict[str, DataFrame]:
        return {
            f"br_{name}": read_bronze(
                self.spark, source, self.tables.folder("bronze", f"br_{name}")
            )
            for name, source in SOURCES.items()
        }
