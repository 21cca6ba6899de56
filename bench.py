"""Headline queries and the end-to-end job, timed. Prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidelake.plans.catalogue import QUERIES  # noqa: E402
from tidelake.plans.job import Job  # noqa: E402
from tidelake.session import scratch_folder, spark_session  # noqa: E402
from tidelake.sources.driver_tables import CALENDAR, DriverTables  # noqa: E402
from tidelake.sources.landing import SOURCES  # noqa: E402

HEADLINES = (
    "mart_monthly_revenue", "mart_delivery_performance", "mart_seller_scorecard",
    "fct_order_items", "fct_payments", "fct_reviews", "dim_customer", "dim_product",
    "sv_order_items", "sv_customers", "sv_geolocation", "scd2_event_status", "asof_seller",
    "q02_seller_states", "q05_score_by_delay", "q08_revenue_by_state", "q16_star_report",
    "dq_expectation_report", "grain_report", "orphan_keys", "csv_ingest", "scd2_incremental",
)


def run_query(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run_job(spark, folder: str) -> tuple[float, int]:
    """Gate, bronze, silver, gold, report and layout over CSV copies of the nine sources."""
    work = scratch_folder(spark, "bench-job")
    tables, records = DriverTables(spark, folder, number_lines=True), 0
    for name, source in SOURCES.items():
        frame = tables[f"br_{name}"].select(*source.columns)
        text = frame.select(*[frame[c].cast("string").alias(c) for c in frame.columns])
        text.write.option("header", True).option("escape", '"').csv(f"{work}/landing/{name}")
        records += frame.count()
    start = time.perf_counter()
    Job(spark, f"{work}/landing", f"{work}/lake", calendar=CALENDAR).run()
    return time.perf_counter() - start, records


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_query(spark, "mart_monthly_revenue", folder)  # JVM warm-up, not counted
    seconds = {name: round(run_query(spark, name, folder), 3) for name in HEADLINES}
    job, records = run_job(spark, folder)
    seconds["job_end_to_end"] = round(job, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_and_job_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "job_records": records,
                "job_records_per_sec": round(records / job),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
