"""Model inputs, rule scores, model scores and decisions."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from swipeline import config
from swipeline.functions import scalars

# --- fixed values: model inputs, in model order ---------------------------------
MODEL_COLUMNS = [
    "amount", "hour_of_day", "day_of_week", "is_weekend", "merchant_category_hash",
    "tx_count_10m", "tx_count_1h", "tx_count_24h",
    "total_amount_10m", "total_amount_1h", "total_amount_24h",
    "unique_merchants_24h", "avg_tx_amount_30d", "amount_vs_avg_ratio", "is_new_card",
    "merchant_risk_score", "merchant_fraud_rate", "time_since_last_tx", "amount_per_tx_1h",
]
# --- fixed values: rule name -> (condition on model inputs, weight) ---------------
RULES_A = {
    "high_amount": ("amount > 1000", "0.30"),
    "high_velocity": ("tx_count_10m > 5", "0.25"),
    "high_ratio": ("amount_vs_avg_ratio > 3", "0.20"),
    "risky_merchant": ("merchant_risk_score > 0.7", "0.15"),
    "new_card": ("is_new_card = 1", "0.10"),
}
# rule name -> steps, the first that holds counts
RULES_B = {
    "amount_ratio": [("amt_ratio_to_avg > 5", "0.30"), ("amt_ratio_to_avg > 3", "0.15")],
    "velocity": [("velocity_score > 5", "0.25"), ("velocity_score > 3", "0.15")],
    "high_value": [("is_high_value = 1", "0.20")],
    "distance": [("distance_from_home > 1000", "0.15"), ("distance_from_home > 500", "0.08")],
    "hour": [("hour_of_day < 6 or hour_of_day > 23", "0.10")],
}
# ----------------------------------------------------------------------------------

SCORE = "decimal(5,2)"
#: Bytes of a model that is sent to every executor, at most.
MOST_MODEL_BYTES = 256 << 20


def model_inputs(rows: DataFrame) -> DataFrame:
    """The 19 model inputs next to the given columns.

    Reads `amount`, `ts_us`, `merchant_category` and the `card_`/`merchant_`
    columns of `store.lookup_all`; a null takes the default.
    """
    ts = F.timestamp_micros("ts_us")
    amount = F.coalesce(F.col("amount").cast("double"), F.lit(0.0))

    def card(name: str) -> Column:
        return F.coalesce(F.col(f"card_{name}"), F.lit(config.CARD_DEFAULTS[name]))

    def merchant(name: str) -> Column:
        return F.coalesce(F.col(f"merchant_{name}"), F.lit(config.MERCHANT_DEFAULTS[name]))

    average = card("avg_tx_amount_30d")
    last = card("last_tx_timestamp")
    hour_count, hour_total = card("tx_count_1h"), card("total_amount_1h").cast("double")
    inputs = {
        "amount": amount,
        "hour_of_day": scalars.hour_of_day(ts),
        "day_of_week": scalars.day_of_week(ts),
        "is_weekend": scalars.is_weekend(ts),
        "merchant_category_hash": scalars.category_bucket(
            scalars.category_or_unknown(F.col("merchant_category"))
        ),
        **{f"tx_count_{w}": card(f"tx_count_{w}") for w in config.VELOCITY_WINDOWS},
        **{
            f"total_amount_{w}": card(f"total_amount_{w}").cast("double")
            for w in config.VELOCITY_WINDOWS
        },
        "unique_merchants_24h": card("unique_merchants_24h"),
        "avg_tx_amount_30d": average,
        "amount_vs_avg_ratio": scalars.ratio(amount, average),
        "is_new_card": card("is_new_card"),
        "merchant_risk_score": merchant("risk_score"),
        "merchant_fraud_rate": merchant("fraud_rate"),
        "time_since_last_tx": F.when(
            last > 0, F.floor(F.col("ts_us") / config.US) - last
        ).otherwise(F.lit(config.DAY_S)),
        "amount_per_tx_1h": F.when(hour_count > 0, hour_total / hour_count).otherwise(
            F.lit(0.0)
        ),
    }
    kept = [c for c in rows.columns if c not in inputs]
    return rows.select(*kept, *[inputs[c].alias(c) for c in MODEL_COLUMNS])


def contribution(steps: list[tuple[str, str]]) -> Column:
    """Weight of the first step that holds, 0 if none does."""
    out = F.lit("0.00").cast(SCORE)
    for condition, weight in reversed(steps):
        out = F.when(F.expr(condition), F.lit(weight).cast(SCORE)).otherwise(out)
    return out


def _score(rules: dict[str, list[tuple[str, str]]]) -> Column:
    total = F.lit("0.00").cast(SCORE)
    for steps in rules.values():
        total = total + contribution(steps)
    return F.least(total.cast(SCORE), F.lit("1.00").cast(SCORE)).cast("double")


def rule_score_a() -> Column:
    """Score over the model inputs, 0 to 1; decimal weights, so sums do not drift."""
    return _score({name: [rule] for name, rule in RULES_A.items()})


def rule_score_b() -> Column:
    """Score over published and request features, 0 to 1."""
    return _score(RULES_B)


def rule_score_c(amount: Column) -> Column:
    return F.when(amount > 1000, F.lit(0.75)).otherwise(F.lit(0.12))


def risk_level(score: Column) -> Column:
    return (
        F.when(score >= config.HIGH_RISK, "HIGH")
        .when(score >= config.MEDIUM_RISK, "MEDIUM")
        .otherwise("LOW")
    )


def decision(score: Column, amount: Column) -> Column:
    """BLOCK at high risk; REVIEW at medium risk above 5,000; else APPROVE."""
    return (
        F.when(score >= config.HIGH_RISK, "BLOCK")
        .when((score >= config.MEDIUM_RISK) & (amount > config.REVIEW_AMOUNT), "REVIEW")
        .otherwise("APPROVE")
    )


def binary_decision(score: Column) -> Column:
    return F.when(score > config.BLOCK_THRESHOLD, "BLOCK").otherwise("APPROVE")


def decide(rows: DataFrame, score: Column) -> DataFrame:
    return rows.withColumn("fraud_probability", score).withColumns(
        {
            "risk_level": risk_level(F.col("fraud_probability")),
            "decision": decision(F.col("fraud_probability"), F.col("amount")),
        }
    )


def model_score(
    rows: DataFrame,
    model: Any,
    columns: list[str] | None = None,
    name: str = "model_probability",
) -> DataFrame:
    """Probability from any object with `predict_proba(matrix)`.

    The model goes to each Python worker once; batches arrive through Arrow. One that takes
    more than MOST_MODEL_BYTES is refused: it is broadcast.
    Columns the frame lacks count as 0, and a batch the model refuses falls back
    to the rule score; `{name}_source` says which it is, `model` or `rules`.
    """
    columns = columns or list(getattr(model, "feature_name_", MODEL_COLUMNS))
    size = len(cloudpickle.dumps(model))
    if size > MOST_MODEL_BYTES:
        raise ValueError(f"a model of {size} bytes is too large to broadcast")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("p double, source string")
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        loaded = shared.value
        for batch in batches:
            matrix = pd.concat(batch[:-1], axis=1).to_numpy(dtype=float)
            try:
                yield pd.DataFrame({"p": loaded.predict_proba(matrix)[:, 1], "source": "model"})
            except (ValueError, TypeError, ArithmeticError):
                yield pd.DataFrame({"p": batch[-1], "source": "rules"})

    inputs = [
        (F.col(c).cast("double") if c in rows.columns else F.lit(0.0)) for c in columns
    ]
    scored = rows.withColumn("_scored", predict(*inputs, rule_score_a()))
    return scored.withColumns(
        {name: F.col("_scored.p"), f"{name}_source": F.col("_scored.source")}
    ).drop("_scored")


def score_summary(scored: DataFrame) -> DataFrame:
    """Transactions, blocked ones and mean score."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.count_if(F.col("decision") == "BLOCK").alias("n_blocked"),
        F.count_if(F.col("decision") == "REVIEW").alias("n_review"),
        F.avg("fraud_probability").alias("avg_probability"),
    )
