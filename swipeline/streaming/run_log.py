"""Run metrics of streams, kept in a table.

A batch's counts come with its own write as observed metrics (`quality.observe_run`) and would be
gone with the session. A listener appends them to a folder, one numbered part per batch: a
batch that is repeated after a failure replaces its part, and a job that goes on from its
checkpoint goes on with the numbers.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "query_id string, started string, n_input bigint, n_processed bigint, n_failed bigint, total_amount decimal(38,2)"
)


class RunLog(StreamingQueryListener):
    """Keeps the observed counts named `name` of every query that reports them."""

    def __init__(self, spark: SparkSession, path: str, name: str = "run"):
        self.spark, self.path, self.name = spark, path, name
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def _event(self, run_id: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(self.name)
        if counts is None:
            return
        row = (
            str(progress.id), progress.timestamp, progress.numInputRows,
            counts["n_processed"], counts["n_failed"], counts["total_amount"],
        )
        part = self.spark.createDataFrame([row], SCHEMA).coalesce(1)
        part.write.mode("overwrite").parquet(f"{self.path}/query={progress.id}/batch={progress.batchId}")

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def wait(self, job: StreamingQuery, seconds: float = 60) -> None:
        """Until everything the ended job reported has been kept: reports come in order, and its
        end is the last."""
        job.awaitTermination()
        if not self._event(str(job.runId)).wait(seconds):
            raise TimeoutError(f"no end of run {job.runId} was reported")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("query")


def run_metrics(log: DataFrame) -> DataFrame:
    """`quality.run_metrics` over all batches that are kept."""
    good, bad = F.sum("n_processed"), F.sum("n_failed")
    return log.agg(
        good.alias("n_processed"), bad.alias("n_failed"),
        F.try_divide(good * 100.0, good + bad).alias("success_percent"),
        F.try_divide(F.sum("total_amount").cast("double"), good).alias("avg_amount"),
        F.count(F.lit(1)).alias("n_batches"),
    )
