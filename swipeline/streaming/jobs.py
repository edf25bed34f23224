"""Structured Streaming jobs around the batch operators.

Every job runs with `availableNow` on what has arrived and resumes from its
checkpoint: offsets and state commit together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from swipeline import config
from swipeline.operators import clean, distributions, predictions, quality
from swipeline.plans import realtime
from swipeline.session import cut_lineage, tune
from swipeline.sources import messages, writers
from swipeline.streaming.card_state import INLINE_ROWS, card_features


#: Reason of dead letters that came behind the watermark, and the columns they keep.
LATE = "late"
GIVEN = ["transaction_id", "card_id", "merchant_id", "merchant_category", "amount", "ts_us", "lat"]


def start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(frame: DataFrame, path: str, batch: int) -> None:
    """One folder per batch, overwritten on retry: each row lands exactly once."""
    frame.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def clean_stream(encoded: DataFrame, good: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Decode and validate; accepted rows and dead letters go to two folders.

    Processed and failed counts are in the progress, under `run`.
    """

    def each(batch: DataFrame, number: int) -> None:
        cleaned = batch.persist()
        try:
            accepted, dead = clean.split_rejects(cleaned)
            write_batch(accepted, good, number)
            write_batch(dead, rejected, number)
        finally:
            cleaned.unpersist()

    cleaned = quality.observe_run(clean.clean(messages.decode(encoded)), "run")
    return start(cleaned, each, checkpoint)


def feature_stream(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    late: str = "1 hour",
    inline_rows: int = INLINE_ROWS,
    keep_late: bool = False,
) -> StreamingQuery:
    """Lookback features of every transaction to a folder.

    With `keep_late` the rows behind the watermark are written beside the others, in
    one pass: `on_time` and `late_rows` read the two halves of a batch.
    """
    tune(transactions.sparkSession)

    def each(batch: DataFrame, number: int) -> None:
        if not keep_late:
            write_batch(batch, path, number)
            return
        folder = batch.write.mode("overwrite").partitionBy("late")
        folder.parquet(f"{path}/batch={number}")

    return start(card_features(transactions, late, inline_rows, keep_late), each, checkpoint)


def on_time(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows of a folder that `feature_stream` wrote with `keep_late`."""
    return spark.read.parquet(path).where("late = 'false'").drop("late", "batch")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The transactions behind the watermark, as dead letters: as they came, with a reason."""
    rows = spark.read.parquet(path).where("late = 'true'")  # a folder's name is text
    return rows.select(*GIVEN, F.lit(LATE).alias("reject_reason"))


def clip_stream(
    transactions: DataFrame, path: str, fitted: str, checkpoint: str, column: str = "amount"
) -> StreamingQuery:
    """Transactions with `{column}_clipped` at the percentile of the day before.

    A batch first adds the sketches of its own days to the folder `fitted`, as a numbered part, and
    then reads the limits from there: no transaction is read twice for it, and a day's
    limit knows nothing of the day itself. Days without a day before stay as they are.
    """
    spark = transactions.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        rows = cut_lineage(batch)
        write_batch(distributions.sketches(rows, [column]), fitted, number)
        known = distributions.limits(spark.read.parquet(fitted))
        write_batch(distributions.clip_by_day(rows, known, column), path, number)

    return start(transactions, each, checkpoint)


def dedup_stream(transactions: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each transaction id once, as long as its copies come within the watermark."""
    timed = transactions.withColumn("ts", F.timestamp_micros("ts_us")).withWatermark("ts", late)
    return timed.dropDuplicatesWithinWatermark(["transaction_id"]).drop("ts")


def after_row(features: DataFrame) -> DataFrame:
    """What the card holds after each row: the row itself counts, as in
    `store.card_snapshot`. A merchant that the window lacks is one more."""
    return features.withColumns(
        {f"tx_count_{w}": F.col(f"tx_count_{w}") + 1 for w in config.VELOCITY_WINDOWS}
        | {
            f"total_amount_{w}": F.col(f"total_amount_{w}") + F.col("amount").cast("double")
            for w in config.VELOCITY_WINDOWS
        }
        | {"unique_merchants_24h": F.col("unique_merchants_24h") + F.col("is_new_merchant")}
    ).drop("is_new_merchant")


def publish_stream(features: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Latest feature row per card, as of after it, into a versioned table."""
    table = writers.VersionedTable(
        features.sparkSession, table_path, "card_id", "ts_us", "transaction_id"
    )
    return start(after_row(features), table.upsert, checkpoint)


def score_stream(
    transactions: DataFrame,
    merchants: DataFrame,
    log_path: str,
    checkpoint: str,
    late: str = "1 hour",
    dead: str | None = None,
) -> StreamingQuery:
    """Features, rule score and decision of every transaction into the prediction log.

    Rows behind the watermark go to the folder `dead`, in the same numbered batch; without
    one they are dropped and counted.
    """
    spark = transactions.sparkSession
    tune(spark)
    log = writers.PredictionLog(spark, log_path)

    def each(batch: DataFrame, number: int) -> None:
        if dead is not None:
            batch = cut_lineage(batch)  # two writes, and the state must run once
            behind = batch.where("late").select(*GIVEN, F.lit(LATE).alias("reject_reason"))
            write_batch(behind, dead, number)
            batch = batch.where("not late").drop("late")
        scored = realtime.score(realtime.vector(batch, merchants))
        rows = predictions.to_predictions(
            scored, ["tx_count_10m", "is_new_card"], F.timestamp_micros("ts_us")
        )
        log.append(rows, number)

    return start(card_features(transactions, late, keep_late=dead is not None), each, checkpoint)
