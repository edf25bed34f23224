"""Transaction messages: from the card data set, to and from keyed JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from swipeline.schemas import CORRUPT, HISTORY, MESSAGE

# Message field -> column of the card data set (fixed names).
RENAMED = {
    "transaction_id": "trans_num",
    "card_id": "cc_num",
    "user_id": "cc_num",
    "merchant_id": "merchant",
    "merchant_category": "category",
    "city": "city",
    "state": "state",
    "zip": "zip",
    "job": "job",
    "dob": "dob",
    "first_name": "first",
    "last_name": "last",
    "gender": "gender",
}


def to_message(rows: DataFrame) -> DataFrame:
    """Card data set rows as the 21-field message; naive times are UTC."""
    seconds = F.unix_seconds(F.try_to_timestamp(F.col("trans_date_trans_time")))
    return rows.select(
        *[F.col(source).cast("string").alias(name) for name, source in RENAMED.items()],
        F.coalesce(F.col("amt").cast("double"), F.lit(0.0)).alias("amount"),
        seconds.alias("timestamp"),
        F.col("lat").cast("double").alias("location_lat"),
        F.col("long").cast("double").alias("location_lon"),
        F.coalesce(F.col("is_fraud").cast("int"), F.lit(0)).alias("is_fraud"),
        F.coalesce(F.col("city_pop").cast("bigint"), F.lit(0)).alias("city_pop"),
        F.col("merch_lat").cast("double").alias("merchant_lat"),
        F.col("merch_long").cast("double").alias("merchant_lon"),
    )


def encode(messages: DataFrame, key: str = "card_id") -> DataFrame:
    """Message sink format: the card as key, the whole message as JSON."""
    return messages.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*messages.columns)).alias("value"),
    )


def decode(frame: DataFrame) -> DataFrame:
    """`key`, `value` frames (topic or file) to text fields.

    Text that is no JSON object fills `_corrupt_record`; works on streams too.
    inline() keeps later filters from parsing the text once per field.
    """
    parsed = F.from_json(
        F.col("value").cast("string"),
        MESSAGE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return frame.select(F.inline(F.array(parsed)))


def history_members(transactions: DataFrame) -> DataFrame:
    """One JSON member per transaction, with its time as score."""
    seconds = F.floor(F.col("ts_us") / 1_000_000)
    return transactions.select(
        "card_id",
        "transaction_id",
        seconds.alias("score"),
        F.to_json(
            F.struct(
                F.col("amount").cast("double").alias("amount"),
                "merchant_id",
                seconds.alias("timestamp"),
            )
        ).alias("value"),
    )


def parse_history(members: DataFrame) -> DataFrame:
    """Members back as columns; members that are no JSON are left out."""
    schema = T.StructType([*HISTORY.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    return (
        members.withColumn("m", parsed)
        .where(F.col(f"m.{CORRUPT}").isNull())
        .select("card_id", "transaction_id", "score", "m.amount", "m.merchant_id", "m.timestamp")
    )
