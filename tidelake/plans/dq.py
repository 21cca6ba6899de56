"""Expectation report from event logs."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.contracts import (
    EXPECTATION_EVENT,
    EXPECTATION_PATH,
    EXPECTATION_SCHEMA,
)
from tidelake.operators.expectations import drop_failing, guard, observed, outcomes, rules_for
from tidelake.operators.integrity import union_all
from tidelake.plans.lake import Lake
from tidelake.session import delete_folder
from tidelake.sources.eventlog import EventLog

logger = logging.getLogger(__name__)


def parse_events(events: DataFrame, layer: str) -> DataFrame:
    """Expectation entries of an event log (timestamp, event_type, details), one row each."""
    recorded = events.filter(F.col("event_type") == EXPECTATION_EVENT).select(
        "timestamp", F.get_json_object("details", EXPECTATION_PATH).alias("recorded")
    )
    entries = recorded.filter("recorded IS NOT NULL").select(
        "timestamp", F.inline(F.from_json("recorded", EXPECTATION_SCHEMA))
    )
    return entries.select(
        F.lit(layer).alias("layer"),
        "dataset",
        F.col("name").alias("expectation"),
        F.col("passed_records").alias("passed"),
        F.col("failed_records").alias("failed"),
        "timestamp",
    )


def expectation_report(
    logs: Mapping[str, Callable[[], DataFrame]], latest_only: bool = False
) -> DataFrame:
    """Last time seen and summed outcomes per (layer, dataset, expectation).

    A log that cannot be read is skipped with a warning; having none at all is an error. Outcomes
    add up over all runs; ``latest_only`` keeps those of the most recent run instead.
    """
    readable = []
    for layer, read in logs.items():
        try:
            readable.append(parse_events(read(), layer))
        except PySparkException as error:
            logger.warning("event log of %s skipped: %s", layer, error)
    if not readable:
        raise RuntimeError("no event log could be read")
    entries = union_all(readable)
    keys = ("layer", "dataset", "expectation")
    if latest_only:
        newest = entries.groupBy(*keys, "timestamp").agg(
            F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
        ).groupBy(*keys).agg(F.max(F.struct("timestamp", "passed", "failed")).alias("newest"))
        return newest.select(
            *keys,
            F.col("newest.timestamp").alias("last_seen"),
            F.col("newest.passed").alias("total_passed"),
            F.col("newest.failed").alias("total_failed"),
        )
    return entries.groupBy(*keys).agg(
        F.max("timestamp").alias("last_seen"),
        F.sum("passed").alias("total_passed"),
        F.sum("failed").alias("total_failed"),
    )


def stamped_report(report: DataFrame) -> DataFrame:
    """The report with the time it was run."""
    return report.withColumn("report_run_at", F.current_timestamp())


def _month(column: str) -> Column:
    return F.trunc(F.to_date(column), "month").cast("timestamp_ntz")


#: Data sets with rules by stage: those of one stage only need earlier ones. The spine has none, but three facts read it.
STAGES = (
    ("sv_orders", "sv_order_items", "sv_payments", "sv_reviews", "sv_customer_keys"),
    ("dim_seller", "dim_product", "dim_customer", "bridge_customer_order"),
    ("order_spine",),
    ("fct_order_items", "fct_payments", "fct_reviews"),
)


#: Data sets that are derived again where they are read: stored lines would move with all their columns, raw ones move anyway.
DERIVED_AGAIN = ("sv_order_items",)
#: What nothing reads of a stored data set, and the data sets of which nothing is read once a data set is stored.
UNREAD = {"bridge_customer_order": ("customer_sk",)}
SPENT = {"bridge_customer_order": ("sv_customer_keys",), "order_spine": ("sv_orders", "bridge_customer_order")}


def recorded(lake: Lake, log: EventLog, folder: str, undated: str) -> Lake:
    """Go through every data set with rules once and record its counts; those that others read are stored, and removed once
    they have been read. The lake returned has what is left, and derives the rest as before.

    Counts carry the last month of the data as the time of the run; data sets without a date are dated ``undated``.
    """
    tables: dict[str, DataFrame] = {}
    for stage in STAGES:
        stored = lake.with_tables(tables)
        with ThreadPoolExecutor(len(stage)) as pool:
            jobs = {name: pool.submit(_store, stored, name, log, f"{folder}/{name}", undated) for name in stage}
            results = {name: job.result() for name, job in jobs.items()}
        tables |= {name: df for name, df in results.items() if df is not None}
        for name in (spent for done in stage for spent in SPENT.get(done, ()) if spent in tables):
            del tables[name]
            delete_folder(lake.spark, f"{folder}/{name}")
    return lake.with_tables(tables)


def _store(lake: Lake, name: str, log: EventLog, folder: str, undated: str) -> DataFrame | None:
    frame, rules = lake.before_rules(name), rules_for(name)
    dated = [c for c in ("_ingested_at", "valid_from", "order_date_key") if c in frame.columns]
    run = F.max(_month(dated[0])) if dated else F.first(F.lit(undated).cast("timestamp_ntz"))
    counted, observation = observed(frame, rules, name, run.alias("__run"))
    sound = guard(drop_failing(counted, rules), rules, name)
    last = name.startswith(("dim_", "fct_")) or name in DERIVED_AGAIN  # nothing that is recorded reads these as stored
    if last:
        sound.write.format("noop").mode("overwrite").save()
    else:
        sound.drop(*UNREAD.get(name, ())).write.option("compression", "zstd").parquet(folder)
    if observation is not None:
        found = observation.get
        at = found["__run"] or datetime.fromisoformat(undated)
        log.append("silver" if name.startswith("sv_") else "gold", outcomes(found, rules, name), at.replace(tzinfo=timezone.utc), name)
    return None if last else lake.spark.read.parquet(folder)
