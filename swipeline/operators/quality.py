"""Validity of stored state, sanity of feature vectors, parity and leakage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from swipeline import config
from swipeline.schemas import CORRUPT

# --- fixed values: columns of the real-time vector, flags, allowed ranges ----------
FLAGS = ["has_location", "is_weekend", "is_night"]
RANGES = {
    "hour_of_day": (0, 23),
    "day_of_week": (0, 6),
    "merchant_risk_score": (0, 1),
    "merchant_fraud_rate": (0, 1),
}
NOT_NEGATIVE = [
    "amount", "amount_log",
    "tx_count_10m", "tx_count_1h", "tx_count_24h",
    "total_amount_10m", "total_amount_1h", "total_amount_24h",
    "unique_merchants_24h", "time_since_last_tx", "avg_tx_amount_30d",
    "amount_vs_avg_ratio", "merchant_total_transactions",
]
# -------------------------------------------------------------------------------


def with_history_issue(members: DataFrame) -> DataFrame:
    """Members (value, score, ...) with `issue`, the first thing wrong, null for a good one.

    The text is parsed once: inline() keeps the optimizer from repeating it.
    """
    schema = f"amount double, merchant_id string, timestamp bigint, {CORRUPT} string"
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    members = members.select(*members.columns, F.inline(F.array(F.struct(parsed.alias("_m")))))
    amount, ts = F.col("_m.amount"), F.col("_m.timestamp")
    issue = (
        F.when(F.col(f"_m.{CORRUPT}").isNotNull(), "text")
        .when(amount.isNull(), "no_amount")
        .when(amount <= 0, "amount")
        .when(ts.isNull(), "no_time")
        .when(ts != F.col("score"), "time")
    )
    return members.withColumn("issue", issue).drop("_m")


def stats_issue(avg_amount: Column, last_ts: Column) -> Column:
    """First thing wrong with card statistics held as text; absent fields are fine."""
    avg, ts = avg_amount.try_cast("double"), last_ts.try_cast("bigint")
    return (
        F.when(avg_amount.isNotNull() & avg.isNull(), "no_number")
        .when(avg <= 0, "average")
        .when(last_ts.isNotNull() & ts.isNull(), "no_time")
        .when(ts < config.TIMESTAMP_MIN, "time")
    )


def state_report(history: DataFrame, merchants: DataFrame, stats: DataFrame) -> DataFrame:
    """Keys, members, passed and failed keys per kind of state, over all of it.

    history: card_id, value, score. merchants: card_id, merchant_id.
    stats: card_id, avg_amount, last_tx_timestamp (text).
    """
    per_history = with_history_issue(history).groupBy("card_id").agg(
        F.count(F.lit(1)).alias("members"),
        F.count("issue").alias("issues"),
    )
    # distinct pairs first: a card with very many rows collapses before the shuffle
    per_set = (
        merchants.select("card_id", "merchant_id")
        .distinct()
        .groupBy("card_id")
        .agg(F.count(F.lit(1)).alias("members"))
        .withColumn("issues", F.lit(0).cast("bigint"))
    )
    per_stats = stats.select(
        "card_id",
        F.lit(1).cast("bigint").alias("members"),
        stats_issue(F.col("avg_amount"), F.col("last_tx_timestamp"))
        .isNotNull()
        .cast("bigint")
        .alias("issues"),
    )
    keys = (
        per_history.withColumn("kind", F.lit("tx_history"))
        .unionByName(per_set.withColumn("kind", F.lit("merchants")))
        .unionByName(per_stats.withColumn("kind", F.lit("stats")))
    )
    return keys.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("members").alias("n_members"),
        F.count_if(F.col("issues") == 0).alias("passed"),
        F.count_if(F.col("issues") > 0).alias("failed"),
    )


def feature_sanity(vector: DataFrame) -> DataFrame:
    """Per column: nulls, NaNs, infinities and values out of range; one pass."""
    numeric = [*NOT_NEGATIVE, "amount_deviation", *RANGES, *FLAGS]
    names = [c for c in dict.fromkeys(numeric) if c in vector.columns]
    aggregates = []
    for name in names:
        x = F.col(name).cast("double")
        finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
        if name in FLAGS:
            wrong = ~x.isin(0.0, 1.0)
        elif name in RANGES:
            wrong = ~x.between(*RANGES[name])
        elif name in NOT_NEGATIVE:
            wrong = x < 0
        else:
            wrong = F.lit(False)
        aggregates.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.count_if(x.isNull()).alias("n_null"),
                F.count_if(F.isnan(x)).alias("n_nan"),
                F.count_if(F.abs(x) == float("inf")).alias("n_infinite"),
                F.count_if(finite & wrong).alias("n_out_of_range"),
            )
        )
    return vector.agg(F.array(*aggregates).alias("r")).select(F.inline("r"))


def parity_report(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], tolerance: float = 1e-6
) -> DataFrame:
    """Per column: rows compared, rows on one side only, rows that differ."""
    a = left.select(key, F.lit(True).alias("_a"), *[F.col(c).cast("double").alias(f"a_{c}") for c in columns])
    b = right.select(key, F.lit(True).alias("_b"), *[F.col(c).cast("double").alias(f"b_{c}") for c in columns])
    both = a.join(b, key, "full_outer")
    matched = F.col("_a").isNotNull() & F.col("_b").isNotNull()

    def differs(c: str) -> Column:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        return matched & ~F.coalesce(F.abs(x - y) <= tolerance, x.isNull() & y.isNull())

    report = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count_if(matched).alias("n_compared"),
            F.count_if(~matched).alias("n_unmatched"),
            F.count_if(differs(c)).alias("n_different"),
        )
        for c in columns
    ]
    return both.agg(F.array(*report).alias("r")).select(F.inline("r"))


def leakage_check(joined: DataFrame, event_time: str, feature_time: str) -> DataFrame:
    """Rows whose feature is newer than their event; must be none."""
    return joined.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(feature_time).alias("n_hits"),
        F.count_if(F.col(feature_time) > F.col(event_time)).alias("n_leaks"),
    )


def observe_run(cleaned: DataFrame, name: str) -> DataFrame:
    """The same frame; its counts come with the write itself, in batch through an
    `Observation` of that name, on streams in the progress of every batch."""
    good = F.col("reject_reason").isNull()
    return cleaned.observe(
        name, F.count_if(good).alias("n_processed"), F.count_if(~good).alias("n_failed"),
        F.coalesce(F.sum(F.when(good, F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("total_amount"),
    )


def run_metrics(cleaned: DataFrame) -> DataFrame:
    """Processed, failed, success percentage and mean accepted amount."""
    good = F.col("reject_reason").isNull()
    return cleaned.agg(
        F.count_if(good).alias("n_processed"),
        F.count_if(~good).alias("n_failed"),
        (F.count_if(good) * 100.0 / F.count(F.lit(1))).alias("success_percent"),
        (
            F.sum(F.when(good, F.col("amount"))).cast("double") / F.count_if(good)
        ).alias("avg_amount"),
    )
