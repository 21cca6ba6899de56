"""Append-only tables whose batches become visible by a manifest, so that a replayed batch is seen once.

A batch writes its rows into a folder of its own and then a manifest that names its files, in one file that
appears by a rename. Readers and followers go by manifests only: rows of a batch that broke off are invisible, and
running the batch again replaces them. Once its manifest exists a batch is final, and running it again does
nothing; so whatever followed it in the meantime has seen all there is. Counters of the batch stand in the manifest too,
and are as durable and as exact as its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"
ONE_RUN = {"availableNow": True}
MANIFEST = "stream string, batch_id bigint, files array<string>, counts map<string, bigint>"
_JSON = {"recursiveFileLookup": "true", "pathGlobFilter": "*.json"}


def running_stream(spark: SparkSession) -> str:
    """Identity of the stream whose batch is being handled: it lives in the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "by hand"


class CommittedTable:
    """Parquet files under ``folder``, one sub-folder a batch, and manifests in ``folder/_commits``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.manifests = f"{self.folder}/_commits"

    def _manifest(self, batch_id: int):
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.manifests}/{batch_id}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def exists(self) -> bool:
        """Whether a batch was ever committed."""
        try:
            return self.commits().limit(1).count() > 0
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def has(self, batch_id: int) -> bool:
        """Whether this batch is final. Another stream's batch under the same number is an error, not a replay."""
        found = self._manifest(batch_id)
        own = running_stream(self.spark)
        if found is not None and found.stream != own:
            raise RuntimeError(f"batch {batch_id} of {self.folder} was committed by stream {found.stream}, not {own}: was the checkpoint replaced?")
        return found is not None

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Rows of a batch, which nobody sees yet; earlier tries are replaced."""
        df.write.mode("overwrite").parquet(f"{self.folder}/{BATCH}={batch_id}")

    def commit(self, batch_id: int, counts: Mapping[str, int] | None = None) -> None:
        """Make the batch final and visible; a batch without a folder has no rows."""
        part = f"{BATCH}={batch_id}"
        try:
            written = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{self.folder}/{part}").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            written = []
        files = [f"{part}/{path.rsplit('/', 1)[1]}" for path in written]
        row = (running_stream(self.spark), batch_id, files, dict(counts or {}))
        entry = self.spark.createDataFrame([row], MANIFEST).coalesce(1)
        entry.write.mode("overwrite").json(f"{self.manifests}/{batch_id}")

    def append(self, df: DataFrame, batch_id: int, counts: Callable[[], Mapping[str, int]] | None = None) -> bool:
        """Write and commit; False if the batch was final already. ``counts`` is asked after the write."""
        if self.has(batch_id):
            return False
        self.write(df, batch_id)
        self.commit(batch_id, counts() if counts else None)
        return True

    def commits(self) -> DataFrame:
        """The manifests of all batches."""
        return self.spark.read.schema(MANIFEST).options(**_JSON).json(self.manifests)

    def counts(self) -> DataFrame:
        """``(batch_id, counter, n)`` of all batches."""
        return self.commits().select("batch_id", F.explode("counts").alias("counter", "n"))

    def partitions(self) -> list[str]:
        """Folder names of the committed batches, one for each batch."""
        return sorted(f"{BATCH}={r.batch_id}" for r in self.commits().select("batch_id").collect())

    def _rows(self, manifests: DataFrame, schema: T.StructType | str | None) -> DataFrame:
        """Rows of the files that manifests name; the driver sees paths only."""
        paths = [f"{self.folder}/{r.file}" for r in manifests.select(F.explode("files").alias("file")).collect()]
        if not paths and schema is not None:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def read(self, schema: T.StructType | str | None = None) -> DataFrame:
        """All committed rows."""
        return self._rows(self.commits(), schema)

    def follow(
        self,
        schema: T.StructType | str,
        handle: Callable[[DataFrame, int], None],
        checkpoint: str,
        name: str | None = None,
        trigger: dict | None = None,
        batches: int = 100,
    ) -> StreamingQuery:
        """Call ``handle(rows, id)`` with the rows of batches committed since; ``batches`` of them at most at once."""
        manifests = self.spark.readStream.schema(MANIFEST).options(**_JSON, maxFilesPerTrigger=batches).json(self.manifests)
        writer = manifests.writeStream.foreachBatch(lambda new, batch_id: handle(self._rows(new, schema), batch_id))
        writer = writer.queryName(name) if name else writer
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONE_RUN)).start()
