"""Incremental row-wise silver tables, their quarantine and their expectation counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.operators.expectations import drop_failing, guard, observed, outcomes, rules_for
from tidelake.plans import silver
from tidelake.sources.commits import CommittedTable
from tidelake.sources.eventlog import EventLog
from tidelake.sources.landing import SOURCES
from tidelake.streaming.bronze import follow_bronze

FEEDS = {
    "sv_orders": "orders",
    "sv_order_items": "order_items",
    "sv_payments": "payments",
    "sv_reviews": "reviews",
    "sv_customer_keys": "customers",
    "sv_quarantine_orders": "orders",
}


def transform(dataset: str, rows: DataFrame) -> tuple[DataFrame, Observation | None]:
    """A batch of a silver table: typed, counted, then rid of rows its rules drop."""
    if dataset == "sv_quarantine_orders":
        return silver.quarantined_orders(rows), None
    rules = rules_for(dataset)
    counted, observation = observed(silver.ROW_WISE[dataset](rows), rules, dataset)
    return guard(drop_failing(counted, rules), rules, dataset), observation


def refresh(
    spark: SparkSession,
    dataset: str,
    bronze: str,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    log: EventLog | None = None,
) -> StreamingQuery:
    """Append what is new in bronze. Clean rows and quarantine are two streams of one feed.

    Expectation counts are taken while the rows are written and stand in the batch's manifest; the event log
    gets them under the batch's own name, so neither a restart nor a replay loses or doubles them.
    """
    source, table = SOURCES[FEEDS[dataset]], CommittedTable(spark, target)

    def append(rows: DataFrame, batch_id: int) -> None:
        if table.has(batch_id):
            return
        frame, observation = transform(dataset, rows)
        table.write(frame, batch_id)
        found = observation.get if observation else {}
        if log is not None and found:
            log.append("silver", outcomes(found, rules_for(dataset), dataset), name=f"{dataset}-{batch_id}")
        table.commit(batch_id, found)

    return follow_bronze(spark, source, f"{bronze}/br_{source.name}", append, checkpoint, dataset, trigger)


def counts(spark: SparkSession, target: str) -> dict[str, int]:
    """Expectation counters of all batches of a table, whichever runs brought them."""
    found = CommittedTable(spark, target).counts().groupBy("counter").agg(F.sum("n").alias("n"))
    return {r.counter: r.n for r in found.collect()}


def refresh_all(
    spark: SparkSession, bronze: str, silver_root: str, checkpoints: str, log: EventLog | None = None
) -> None:
    """Bring all row-wise tables up to date and log their expectation counts."""
    queries = [
        refresh(spark, dataset, bronze, f"{silver_root}/{dataset}", f"{checkpoints}/{dataset}", log=log)
        for dataset in FEEDS
    ]
    for query in queries:
        query.awaitTermination()
