"""Registered streaming queries: the given tables arrive in slices of event time.

Each slice is written, a job runs on what is new and stops, and the next slice
resumes from the checkpoint. The result is read back as a batch frame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from swipeline import config
from swipeline.functions import cleaning, scalars
from swipeline.operators import clean, distributions
from swipeline.plans import realtime
from swipeline.plans.queries import merchants, outcomes, query, received, rounded
from swipeline.session import cut_lineage, shared_dir
from swipeline.sources import messages, readers, tables, writers
from swipeline.streaming import jobs, run_log
from swipeline.streaming.card_state import card_features


#: Files of a stored table that is cut into slices, at most.
MOST_FILES = 96


def slices(rows: DataFrame, time: str, n: int = 2) -> Iterator[DataFrame]:
    """The rows cut into `n` consecutive spans of the time column; rows without a time
    come in the first.

    The rows are made once and stored, dealt evenly over the tasks: a span of rows that come in
    order would otherwise lie in few files, whose tasks a batch waits for. The number of
    files stays far below what a batch takes, so a span is one batch.
    """
    tasks = min(MOST_FILES, 2 * rows.sparkSession.sparkContext.defaultParallelism)
    rows = cut_lineage(rows.repartition(tasks))
    low, high = rows.agg(F.min(time), F.max(time)).first()
    if low is None:
        yield rows
        return
    edges = [low + (high - low) * i // n for i in range(1, n)]
    for i in range(n):
        part = rows
        if i > 0:
            part = part.where(F.col(time) >= edges[i - 1])
        if i < n - 1:
            early = F.col(time) < edges[i]
            part = part.where(early | F.col(time).isNull() if i == 0 else early)
        yield part


def replay(
    parts: Iterator[DataFrame], folder: str, run: Callable[[DataFrame], StreamingQuery]
) -> list[dict]:
    """Write part after part, run the job after each; progress of every batch."""
    progress = []
    for part in parts:
        part.write.mode("append").parquet(folder)
        job = run(readers.parquet_stream(part.sparkSession, folder, part.schema))
        job.awaitTermination()
        progress += job.recentProgress
    return progress


@query
def src_csv_stream(spark, sf_dir):
    path = shared_dir(spark)
    tables.card_rows(spark, sf_dir).write.option("header", True).csv(f"{path}/in")
    jobs.start(
        readers.csv_stream(spark, f"{path}/in"),
        lambda batch, number: jobs.write_batch(batch, f"{path}/out", number),
        f"{path}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out").select(
        "trans_num", "cc_num", "amt", "merchant", "category", rounded("lat"), "dob", "is_fraud"
    )


@query
def stream_clean(spark, sf_dir):
    """Validation of the message stream; accepted rows and dead letters together."""
    path = shared_dir(spark)
    raw = tables.raw_messages(spark, sf_dir).drop("delivery")
    encoded = messages.encode(raw).withColumn(
        "n", F.get_json_object("value", "$.transaction_id").cast("bigint")
    )
    replay(
        slices(encoded, "n"),
        f"{path}/in",
        lambda s: jobs.clean_stream(s, f"{path}/good", f"{path}/dead", f"{path}/checkpoint"),
    )
    good = spark.read.parquet(f"{path}/good").withColumn("reject_reason", F.lit(None).cast("string"))
    both = good.unionByName(spark.read.parquet(f"{path}/dead"))
    return both.select(
        "transaction_id", F.col("amount").cast("double").alias("amount"), "timestamp",
        "reject_reason",
    )


def _stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    replay(
        slices(tables.transactions(spark, sf_dir), "ts_us", 3),
        f"{path}/in",
        lambda s: jobs.feature_stream(s, f"{path}/out", f"{path}/checkpoint"),
    )
    return spark.read.parquet(f"{path}/out")


@query
def stream_features(spark, sf_dir):
    """The real-time vector from keyed state; the same rows as the batch query."""
    out = realtime.vector(_stream_history(spark, sf_dir), merchants(spark, sf_dir))
    longs = {"hour_of_day", "day_of_week"}
    doubles = {"amount_log", "merchant_risk_score", "merchant_fraud_rate"}
    return out.select(
        "transaction_id",
        *[
            F.col(c).cast("bigint").alias(c) if c in longs
            else rounded(c) if c in doubles else F.col(c)
            for c in realtime.VECTOR
        ],
        "unique_merchants_since_idle",
    )


@query
def stream_dedup(spark, sf_dir):
    """Every transaction arrives twice; the copy comes in the next slice."""
    path = shared_dir(spark)
    tx = tables.transactions(spark, sf_dir)
    first, second = slices(tx, "ts_us")
    replay(
        iter([first, second.unionByName(second), tx]),
        f"{path}/in",
        lambda s: jobs.start(
            jobs.dedup_stream(s, "40 days"),
            lambda batch, number: jobs.write_batch(batch, f"{path}/out", number),
            f"{path}/checkpoint",
        ),
    )
    return spark.read.parquet(f"{path}/out").select("transaction_id", "card_id")


@query
def stream_late(spark, sf_dir):
    """The second half of the month arrives first: the first half is too late."""
    path = shared_dir(spark)
    first, second = slices(tables.transactions(spark, sf_dir), "ts_us")
    progress = replay(
        iter([second, first]),
        f"{path}/in",
        lambda s: jobs.feature_stream(s, f"{path}/out", f"{path}/checkpoint"),
    )
    dropped = sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])
    out = spark.read.parquet(f"{path}/out")
    return out.agg(F.count(F.lit(1)).alias("n_emitted")).withColumn(
        "n_dropped", F.lit(int(dropped)).cast("bigint")
    )


@query
def stream_late_rows(spark, sf_dir):
    """Messages of the second half of the month come first. Every message ends in one place:
    with features (no reason), rejected, or late; the jobs hand over through folders."""
    path = shared_dir(spark)
    times = tables.transactions(spark, sf_dir).select(F.col("transaction_id").alias("id"), "ts_us")
    once = tables.raw_messages(spark, sf_dir).where("delivery = 1").drop("delivery")
    sent = messages.encode(once)
    sent = sent.withColumn("id", F.get_json_object("value", "$.transaction_id")).join(times, "id")
    broken = F.col("id").cast("bigint") % 41 == 0
    encoded = sent.withColumn("value", F.when(broken, "not json").otherwise(F.col("value"))).drop("id")
    cleaned = clean.accepted(messages.decode(encoded)).schema
    for part in reversed(list(slices(encoded, "ts_us"))):
        part.write.mode("append").parquet(f"{path}/in")
        jobs.clean_stream(
            readers.parquet_stream(spark, f"{path}/in", part.schema),
            f"{path}/good", f"{path}/dead", f"{path}/clean",
        ).awaitTermination()
        good = readers.parquet_stream(spark, f"{path}/good", cleaned)
        jobs.feature_stream(
            clean.to_features_input(good), f"{path}/out", f"{path}/features", keep_late=True
        ).awaitTermination()
    accepted = jobs.on_time(spark, f"{path}/out").withColumn("reject_reason", F.lit(None).cast("string"))
    columns = ["transaction_id", "reject_reason"]
    return (
        accepted.select(*columns, "tx_count_24h")
        .unionByName(spark.read.parquet(f"{path}/dead").select(*columns), allowMissingColumns=True)
        .unionByName(jobs.late_rows(spark, f"{path}/out").select(*columns), allowMissingColumns=True)
    )


@query
def stream_expiry(spark, sf_dir):
    """All transactions, then the same ones 90 days later: every card starts anew."""
    path = shared_dir(spark)
    tx = tables.transactions(spark, sf_dir)
    later = tx.withColumns(
        {
            "transaction_id": F.concat(F.lit("again-"), "transaction_id"),
            "ts_us": F.col("ts_us") + 90 * 86_400_000_000,
        }
    )
    replay(
        iter([tx, later]),
        f"{path}/in",
        lambda s: jobs.feature_stream(s, f"{path}/out", f"{path}/checkpoint"),
    )
    out = spark.read.parquet(f"{path}/out")
    return out.select(
        "transaction_id", "tx_count_24h", "unique_merchants_since_idle", "time_since_last_tx",
        scalars.half_up(F.col("ema_before"), 4).alias("ema_before"),
    )


@query
def stream_publish(spark, sf_dir):
    """Latest feature row per card, published batch by batch."""
    path = shared_dir(spark)
    replay(
        slices(tables.transactions(spark, sf_dir), "ts_us"),
        f"{path}/in",
        lambda s: jobs.publish_stream(card_features(s), f"{path}/table", f"{path}/checkpoint"),
    )
    table = writers.VersionedTable(
        spark, f"{path}/table", "card_id", "ts_us", "transaction_id"
    )
    return table.read().select(
        "card_id", "transaction_id", "ts_us", "tx_count_10m", "tx_count_24h",
        "unique_merchants_24h",
    )


@query
def stream_score(spark, sf_dir):
    """Every transaction scored and logged once."""
    path = shared_dir(spark)
    risk = cut_lineage(merchants(spark, sf_dir))  # a stored table: every batch reads it
    replay(
        slices(tables.transactions(spark, sf_dir), "ts_us"),
        f"{path}/in",
        lambda s: jobs.score_stream(s, risk, f"{path}/log", f"{path}/checkpoint"),
    )
    return writers.PredictionLog(spark, f"{path}/log").read().select(
        "transaction_id", "fraud_probability", "risk_level", "decision"
    )


@query
def stream_pipeline(spark, sf_dir):
    """Raw messages to logged decisions by three jobs that hand over through folders: clean,
    drop copies, score. Messages without a readable time arrive first."""
    path = shared_dir(spark)
    risk = cut_lineage(merchants(spark, sf_dir))
    seconds = cleaning.epoch_seconds(F.get_json_object("value", "$.timestamp"))
    encoded = received(spark, sf_dir).withColumn("n", seconds)
    cleaned = clean.accepted(messages.decode(encoded)).schema
    for part in slices(encoded, "n"):
        part.write.mode("append").parquet(f"{path}/in")
        jobs.clean_stream(
            readers.parquet_stream(spark, f"{path}/in", part.schema),
            f"{path}/good", f"{path}/dead", f"{path}/clean",
        ).awaitTermination()
        good = readers.parquet_stream(spark, f"{path}/good", cleaned)
        single = jobs.dedup_stream(clean.to_features_input(good))
        jobs.start(
            single, lambda batch, number: jobs.write_batch(batch, f"{path}/single", number), f"{path}/dedup"
        ).awaitTermination()
        arrived = readers.parquet_stream(spark, f"{path}/single", single.schema)
        jobs.score_stream(arrived, risk, f"{path}/log", f"{path}/score").awaitTermination()
    log = writers.PredictionLog(spark, f"{path}/log").read()
    return outcomes(log, spark.read.parquet(f"{path}/dead"))


@query
def archive(spark, sf_dir):
    """Raw stream archived by day."""
    path = shared_dir(spark)
    replay(
        slices(tables.transactions(spark, sf_dir), "ts_us"),
        f"{path}/in",
        lambda s: writers.archive(
            s.withColumn("ts", F.timestamp_micros("ts_us")), f"{path}/out", f"{path}/checkpoint"
        ),
    )
    return spark.read.parquet(f"{path}/out").groupBy(
        F.col("event_date").cast("string").alias("event_date")
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("double").alias("total"))


@query
def stream_run_metrics(spark, sf_dir):
    """The stored counts of all batches of a validation job that is started three times."""
    path = shared_dir(spark)
    log = run_log.RunLog(spark, f"{path}/runs")
    raw = tables.raw_messages(spark, sf_dir).drop("delivery")
    encoded = messages.encode(raw).withColumn(
        "n", F.get_json_object("value", "$.transaction_id").cast("bigint")
    )
    spark.streams.addListener(log)
    try:
        for part in slices(encoded, "n", 3):
            part.write.mode("append").parquet(f"{path}/in")
            log.wait(jobs.clean_stream(
                readers.parquet_stream(spark, f"{path}/in", part.schema),
                f"{path}/good", f"{path}/dead", f"{path}/checkpoint",
            ))
    finally:
        spark.streams.removeListener(log)
    return run_log.run_metrics(log.read()).select(
        "n_processed", "n_failed", rounded("success_percent"), rounded("avg_amount"), "n_batches"
    )


@query
def stream_clip(spark, sf_dir):
    """Amounts clipped on a stream at the stored percentile of the day before; per day, how many
    are outside what the error bound of the sketch allows."""
    path = shared_dir(spark)
    replay(
        slices(tables.transactions(spark, sf_dir), "ts_us", 3),
        f"{path}/in",
        lambda s: jobs.clip_stream(s, f"{path}/out", f"{path}/fitted", f"{path}/checkpoint"),
    )
    rows = spark.read.parquet(f"{path}/out").withColumn("day", distributions.day_of())
    share, off = config.CLIP_PERCENTILE / 100, distributions.RANK_ERROR
    # a sketch gives a value of the day before: the bound is one too, and no mean of two
    high = F.expr(f"percentile_disc({min(1.0, share + off)}) within group (order by amount)")
    bounds = rows.groupBy(F.date_add("day", 1).alias("day")).agg(
        high.alias("high"), F.min("amount").alias("least"), F.count(F.lit(1)).alias("n"),
    )
    seen = rows.join(bounds, "day", "left")
    step = F.col("amount_clipped") < F.col("amount")
    wrong = F.when(F.col("n").isNull(), step).otherwise(
        (F.col("amount_clipped") > F.col("high") + 0.01) | (step & (F.col("amount_clipped") < F.col("least")))
    )
    return seen.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(wrong).alias("n_wrong")
    )
