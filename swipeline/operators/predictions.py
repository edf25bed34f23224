"""The prediction log: insert-once, lookups and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from swipeline import config
from swipeline.operators.clean import first_per_key

COLUMNS = [
    "transaction_id", "card_id", "amount", "merchant_id", "merchant_category",
    "fraud_probability", "risk_level", "decision", "model_version", "features_json",
    "actual_label", "created_at",
]


def to_predictions(scored: DataFrame, features: list[str], created_at) -> DataFrame:
    """Scored rows in the shape of the log; the label is filled in later."""
    label = F.col("actual_label") if "actual_label" in scored.columns else F.lit(None)
    return scored.select(
        "transaction_id",
        "card_id",
        F.col("amount").cast("double").alias("amount"),
        "merchant_id",
        "merchant_category",
        "fraud_probability",
        "risk_level",
        "decision",
        F.lit(config.MODEL_VERSION).alias("model_version"),
        F.to_json(F.struct(*features)).alias("features_json"),
        label.cast("int").alias("actual_label"),
        created_at.alias("created_at"),
    )


def insert_once(log: DataFrame | None, new: DataFrame) -> DataFrame:
    """The new predictions that enter the log: the earliest per transaction id,
    and none whose id the log holds."""
    order = [F.col("created_at")] + [
        F.col(c) for c in new.columns if c not in ("transaction_id", "created_at")
    ]
    first = first_per_key(new, "transaction_id", order)
    if log is None:
        return first
    return first.join(log.select("transaction_id"), "transaction_id", "left_anti")


def with_labels(log: DataFrame, labels: DataFrame) -> DataFrame:
    """The log with labels that came in later, by transaction id (transaction_id,
    actual_label). Of several, fraud counts; a row without one
    keeps what it has."""
    late = labels.where(F.col("actual_label").isNotNull()).groupBy("transaction_id").agg(
        F.max("actual_label").alias("_label")
    )
    joined = log.join(late, "transaction_id", "left")
    filled = F.coalesce(F.col("_label"), F.col("actual_label")).cast("int")
    return joined.withColumn("actual_label", filled).select(*log.columns)


def labelled(log: DataFrame) -> DataFrame:
    """Rows of the log that the detection metrics can use, with the label as `is_fraud`."""
    return log.where(F.col("actual_label").isNotNull()).withColumn("is_fraud", F.col("actual_label"))


def get_prediction(log: DataFrame, transaction_id: str, features_schema: str) -> DataFrame:
    """One prediction with its features parsed; the filter reaches the Parquet scan."""
    found = log.where(F.col("transaction_id") == transaction_id)
    return found.withColumn("features", F.from_json("features_json", features_schema))


def recent_predictions(log: DataFrame, n: int = 100, card_id: str | None = None) -> DataFrame:
    """The newest `n`, newest first; ids break ties."""
    rows = log if card_id is None else log.where(F.col("card_id") == card_id)
    return rows.orderBy(F.desc("created_at"), F.desc("transaction_id")).limit(n)


def statistics(log: DataFrame) -> DataFrame:
    """Total, per risk level and per decision, with the mean probability.

    One scan and one exchange: the three groupings are sets of one aggregation. A row that
    counts nothing is added to the log, so that an empty log still has its total.
    """
    rows = log.select("risk_level", "decision", "fraud_probability", F.lit(1).alias("n"))
    nothing = log.sparkSession.range(1).select(F.lit(0).alias("n"))
    counted = rows.unionByName(nothing, allowMissingColumns=True).groupingSets(
        [[], [F.col("risk_level")], [F.col("decision")]], "risk_level", "decision"
    ).agg(
        F.grouping_id().alias("g"), F.sum("n").alias("n_predictions"), F.sum("fraud_probability").alias("s")
    )
    kind = F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "risk_level").otherwise("decision")
    value = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, F.col("risk_level")).otherwise(F.col("decision"))
    return counted.where((F.col("g") == 3) | (F.col("n_predictions") > 0)).select(
        kind.alias("kind"), value.alias("value"), "n_predictions",
        F.coalesce(F.try_divide(F.col("s"), F.col("n_predictions")), F.lit(0.0)).alias("avg_probability"),
    )
