"""Medallion analytics on Spark: landing files to star schema, marts and quality reports."""

from tidelake.plans.lake import Lake
from tidelake.session import scratch_folder, spark_session, tune

__all__ = ["Lake", "scratch_folder", "spark_session", "tune"]
