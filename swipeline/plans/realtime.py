"""Composed plans: the real-time feature vector and the scoring pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from swipeline import config
from swipeline.functions import scalars
from swipeline.operators import clean, scoring, store, velocity
from swipeline.sources import messages

# --- fixed values: the 22 features of the vector ------------------------------------
VECTOR = [
    "amount", "amount_log", "merchant_category", "has_location",
    "tx_count_10m", "tx_count_1h", "tx_count_24h",
    "total_amount_10m", "total_amount_1h", "total_amount_24h",
    "unique_merchants_24h", "time_since_last_tx",
    "avg_tx_amount_30d", "amount_deviation", "amount_vs_avg_ratio",
    "hour_of_day", "day_of_week", "is_weekend", "is_night",
    "merchant_risk_score", "merchant_fraud_rate", "merchant_total_transactions",
]
# --------------------------------------------------------------------------------------


def scalar_columns() -> dict[str, Column]:
    ts = F.timestamp_micros("ts_us")
    return {
        "amount_log": scalars.amount_log(F.col("amount")),
        "has_location": scalars.has_location(F.col("lat")),
        "hour_of_day": scalars.hour_of_day(ts),
        "day_of_week": scalars.day_of_week(ts),
        "is_weekend": scalars.is_weekend(ts),
        "is_night": scalars.is_night(ts),
    }


def vector(history: DataFrame, merchants: DataFrame) -> DataFrame:
    """The 22 features from `velocity.card_history` rows.

    Also keeps the ids, `unique_merchants_since_idle` and the unrounded average
    and previous time that scoring reads.
    """
    return with_merchant(store.lookup_merchant(history, merchants))


def point_in_time(history: DataFrame, risk: DataFrame, limit: int | None = None) -> DataFrame:
    """The same features for training: merchants as they were known before each row.

    risk: `monitoring.merchant_risk_history`. No label of the row, its day or a later
    day reaches an input. Keeps `feature_time`, the moment the merchant was known as of.
    """
    names = list(config.MERCHANT_DEFAULTS)
    found = store.as_of_join(
        history, risk, "merchant_id", "ts_us", "known_us", names, config.VIEW_TTL_S, "known_us", limit
    )
    filled = {f"merchant_{c}": F.coalesce(F.col(c), F.lit(d)) for c, d in config.MERCHANT_DEFAULTS.items()}
    return with_merchant(found.withColumns(filled), "feature_time")


def with_merchant(rows: DataFrame, *keep: str) -> DataFrame:
    full = rows.withColumns(
        scalar_columns()
        | velocity.rolling_columns()
        | {"merchant_category": scalars.category_or_unknown(F.col("merchant_category"))}
    ).withColumn("amount", F.col("amount").cast("double"))
    labels = [c for c in ["is_fraud"] if c in rows.columns]
    return full.select(
        "transaction_id", "card_id", "merchant_id", "ts_us", *VECTOR,
        "unique_merchants_since_idle", "ema_before", "prev_ts", *labels, *keep,
    )


def realtime_features(
    transactions: DataFrame, merchants: DataFrame, limit: int | None = None
) -> DataFrame:
    return vector(velocity.card_history(transactions, limit=limit), merchants)


def score_inputs(features: DataFrame) -> DataFrame:
    """Model inputs from the vector: what the card table held before each row."""
    card = {
        f"card_{c}": F.col(c)
        for c in [
            "tx_count_10m", "tx_count_1h", "tx_count_24h",
            "total_amount_10m", "total_amount_1h", "total_amount_24h",
            "unique_merchants_24h",
        ]
    }
    rows = features.withColumns(
        card
        | {
            "card_avg_tx_amount_30d": F.col("ema_before"),
            "card_last_tx_timestamp": F.coalesce(F.col("prev_ts"), F.lit(0)),
            "card_is_new_card": F.col("prev_ts").isNull().cast("int"),
        }
    )
    keep = [
        "transaction_id", "card_id", "merchant_id", "merchant_category", "ts_us",
        "amount", "merchant_risk_score", "merchant_fraud_rate", *card,
        "card_avg_tx_amount_30d", "card_last_tx_timestamp", "card_is_new_card",
    ]
    labels = [c for c in ["is_fraud"] if c in features.columns]
    return scoring.model_inputs(rows.select(*keep, *labels))


def score(features: DataFrame) -> DataFrame:
    """Rule score A, risk level and decision for every row of the vector."""
    return scoring.decide(score_inputs(features), scoring.rule_score_a())


def from_messages(
    encoded: DataFrame, merchants: DataFrame, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Raw messages to decisions: decoded, cleaned, freed of copies, and scored.

    Returns the scored transactions and the dead letters. A message is in one of
    them, or a copy of a transaction that is.
    """
    cleaned, dead = clean.split_rejects(clean.clean(messages.decode(encoded)))
    transactions = clean.to_features_input(clean.dedup_transactions(cleaned))
    return score(realtime_features(transactions, merchants, limit)), dead


def service_inputs(
    transactions: DataFrame, published: DataFrame
) -> DataFrame:
    """Rows with the published offline features of their card and the request features."""
    table = published.select(
        F.col("cc_num").cast("string").alias("card_id"),
        "avg_amt_7d", "tx_count_24h", "distance_from_home", "hour_of_day", "merchant",
    )
    rows = transactions.select(
        "transaction_id", "card_id",
        F.col("amount").cast("double").alias("current_amt"),
        F.col("merchant_id").alias("current_merchant"),
    )
    return store.request_features(rows.join(table, "card_id", "left"))


def service_score(transactions: DataFrame, published: DataFrame) -> DataFrame:
    rows = service_inputs(transactions, published)
    return rows.withColumn("fraud_probability", scoring.rule_score_b()).withColumn(
        "decision", scoring.binary_decision(F.col("fraud_probability"))
    )
