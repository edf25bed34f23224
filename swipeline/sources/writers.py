"""Sinks: date-partitioned Parquet, versioned keyed tables, the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from swipeline.operators.predictions import insert_once
from swipeline.operators.store import materialize
from swipeline.session import cut_lineage

# --- fixed values -----------------------------------------------------------
TOPIC_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "lz4"}
# ----------------------------------------------------------------------------


def write_features(df: DataFrame, path: str, time: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by day, so date ranges prune. The rebalance hint gathers
    small days and splits a day with very many rows over many tasks."""
    (
        df.withColumn("event_date", F.to_date(time))
        .hint("rebalance", "event_date")
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )


def write_topic(encoded: DataFrame, servers: str, topic: str = "transactions") -> None:
    writer = encoded.write.format("kafka").options(**TOPIC_OPTIONS)
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_topic_stream(
    encoded: DataFrame, servers: str, checkpoint: str, topic: str = "transactions"
) -> StreamingQuery:
    writer = encoded.writeStream.format("kafka").options(**TOPIC_OPTIONS)
    return (
        writer.option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def archive(
    stream: DataFrame, path: str, checkpoint: str, time: str = "ts"
) -> StreamingQuery:
    """Raw stream to date-partitioned Parquet, each row exactly once."""
    return (
        stream.withColumn("event_date", F.to_date(time))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
        .trigger(availableNow=True)
        .start()
    )


def complete(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders `{prefix}={number}` under `path` that hold `_SUCCESS`.

    A run that dies half way leaves no such mark, and its folder does not count.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    done = files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{prefix}=*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName()[len(prefix) + 1 :]) for s in done)


class VersionedTable:
    """Latest row per key in Parquet, as numbered changes over a full version.

    A version usually holds its own updates only, so its cost follows the batch
    and not the table; every `full_every` versions the table is written whole.
    Reading takes the newest row per key from the last full version and the
    changes since. A repeated version replaces its own output.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, time: str, tie: str, full_every: int = 20
    ):
        self.spark, self.path, self.full_every = spark, path, full_every
        self.order = (key, time, tie)

    def parts(self, before: int | None = None) -> list[str]:
        """Folders to read: the last full version and the changes after it."""
        known = lambda prefix: [
            n for n in complete(self.spark, self.path, prefix) if before is None or n < before
        ]
        full = known("full")[-1:]
        changes = [n for n in known("change") if not full or n > full[0]]
        return [f"{self.path}/full={n}" for n in full] + [
            f"{self.path}/change={n}" for n in changes
        ]

    def read(self, before: int | None = None) -> DataFrame | None:
        parts = self.parts(before)
        return materialize(self.spark.read.parquet(*parts), *self.order) if parts else None

    def upsert(self, updates: DataFrame, version: int) -> None:
        parts = self.parts(before=version)
        if parts and len(parts) < self.full_every:
            latest = materialize(updates, *self.order)
            latest.write.mode("overwrite").parquet(f"{self.path}/change={version}")
            return
        rows = updates
        if parts:
            rows = self.spark.read.parquet(*parts).select(*updates.columns).unionByName(updates)
        merged = materialize(rows, *self.order)
        merged.write.mode("overwrite").parquet(f"{self.path}/full={version}")


class PredictionLog:
    """Append-only Parquet log, one folder per batch, partitioned by a hash of the id; ids
    enter once. A batch reads the ids of its own buckets alone, so a small batch costs a small
    part of the log, whose rows never move."""

    BUCKETS = 32

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self, before: int | None = None) -> DataFrame | None:
        known = [
            n for n in complete(self.spark, self.path, "v") if before is None or n < before
        ]
        if not known:
            return None
        rows = self.spark.read.option("basePath", self.path)
        return rows.parquet(*[f"{self.path}/v={n}" for n in known]).drop("v")

    def read(self, before: int | None = None) -> DataFrame | None:
        rows = self._rows(before)
        return None if rows is None else rows.drop("bucket")

    def known(self, ids: DataFrame, before: int | None = None) -> DataFrame | None:
        """Those of the ids (transaction_id, bucket) that the log holds, looked up from the
        log's side in the partitions they belong to."""
        rows = self._rows(before)
        if rows is None:
            return None
        touched = [r[0] for r in ids.select("bucket").distinct().collect()]  # at most BUCKETS
        near = rows.where(F.col("bucket").isin(touched)).select("transaction_id")
        return near.join(ids.select("transaction_id"), "transaction_id", "left_semi")

    def append(self, new: DataFrame, batch: int) -> None:
        """A repeated batch replaces its own folder, so a retry adds nothing twice.

        The batch is written out first: it is used more than once, and a streaming batch must
        not run its state twice.
        """
        bucket = F.pmod(F.xxhash64("transaction_id"), F.lit(self.BUCKETS)).cast("int")
        fresh = cut_lineage(insert_once(None, new).withColumn("bucket", bucket))
        known = self.known(fresh.select("transaction_id", "bucket"), before=batch)
        if known is not None:
            fresh = fresh.join(known, "transaction_id", "left_anti")
        if fresh.isEmpty():  # a folder without files has no columns to read
            return
        fresh.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/v={batch}"
        )
