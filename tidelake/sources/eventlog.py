"""Event log of expectation outcomes, one JSON document per update of a data set."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.contracts import EXPECTATION_EVENT

SCHEMA = "layer string, timestamp timestamp, event_type string, details string"


class EventLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def append(
        self, layer: str, expectations: Sequence[dict], at: datetime | None = None, name: str | None = None
    ) -> None:
        """Record the outcome of one update, in a folder of its own: updates run side by side.

        An update with a ``name`` that is recorded again replaces what it recorded before.
        """
        details = {"flow_progress": {"data_quality": {"expectations": list(expectations)}}}
        stamp = at or datetime.now(timezone.utc)
        row = (layer, stamp, EXPECTATION_EVENT, json.dumps(details))
        entry = self.spark.createDataFrame([row], SCHEMA).coalesce(1)
        entry.write.mode("overwrite").json(f"{self.folder}/{name or uuid.uuid4().hex}")

    def read(self, layer: str) -> DataFrame:
        logged = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(self.folder)
        return logged.filter(F.col("layer") == layer).drop("layer")

    def define(self, schema: str | None = None) -> None:
        """Make the log a table function: ``SELECT * FROM event_log('silver')``.

        For the session, or in a schema of the catalog, where it is found once that is the current one (Spark takes no
        schema before the name of a table function).
        """
        target = f"FUNCTION {schema}.event_log" if schema else "TEMPORARY FUNCTION event_log"
        columns = "timestamp TIMESTAMP, event_type STRING, details STRING"
        self.spark.sql(f"""CREATE OR REPLACE {target}(of_layer STRING) RETURNS TABLE({columns})
            COMMENT 'Expectation outcomes of all updates of a layer'
            RETURN SELECT to_timestamp(timestamp), event_type, details FROM json.`{self.folder}/*` WHERE layer = of_layer""")
