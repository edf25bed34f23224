"""Views of the given tables in the shape of card transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from swipeline.functions.scalars import epoch_us


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as clean card transactions; every fifth card spends in bursts."""
    return (
        read(spark, sf_dir, "events")
        .withColumn("us", epoch_us(F.col("ts")))
        .selectExpr(
            "cast(event_id as string) as transaction_id",
            "cast(user_id as string) as card_id",
            "concat('m', get_json_object(props, '$.k')) as merchant_id",
            "event_type as merchant_category",
            "cast(value * (case when event_id % 7 = 0 then 25 else 1 end) as decimal(18,2)) as amount",
            "case when user_id % 5 = 0 then (us div 345600000000) * 345600000000"
            " + (us % 345600000000) div 288 else us end as ts_us",
            "case when event_id % 20 = 0 then null else 25 + ((event_id * 37) % 200) / 10.0D end as lat",
            "case when event_id % 20 = 0 then null else -120 + ((event_id * 53) % 400) / 10.0D end as lon",
            # likelier for large amounts, never certain, and no function of the other fields
            "cast((event_id * 7919) % 100 < 2 + least(85, floor(value"
            " * (case when event_id % 7 = 0 then 25 else 1 end) / 12)) as int) as is_fraud",
        )
    )


def tied_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` with dates cut to the month: many equal timestamps, large amounts."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("card_id"),
        F.concat(F.lit("m"), F.col("o_orderkey") % 97).alias("merchant_id"),
        F.col("o_orderpriority").alias("merchant_category"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        epoch_us(F.date_trunc("month", F.col("o_orderdate"))).alias("ts_us"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`transactions` as text fields, with one fault per residue of the id mod 40."""
    residue = F.col("transaction_id").cast("bigint") % 40
    text_time = F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd HH:mm:ss")
    iso_time = F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    epoch = F.floor(F.col("ts_us") / 1_000_000).cast("string")
    money = F.col("amount").cast("string")

    def when(value, faults):
        for r, fault in faults.items():
            value = F.when(F.col("residue") == r, fault).otherwise(value)
        return value

    null = F.lit(None).cast("string")
    return (
        transactions(spark, sf_dir)
        .withColumn("residue", residue)
        .select(
            "transaction_id",
            when(F.col("card_id"), {0: null}).alias("card_id"),
            when(F.col("merchant_id"), {14: null}).alias("merchant_id"),
            when(
                money,
                {
                    1: F.lit("not_a_number"),
                    2: F.concat(F.lit("-"), money),
                    3: F.lit("0.004"),
                    8: F.lit("NaN"),
                    13: F.lit("999999999.99"),
                    14: null,
                },
            ).alias("amount"),
            when(
                text_time,
                {
                    4: F.lit("1999-12-31 00:00:00"),
                    5: F.lit("invalid_timestamp"),
                    9: iso_time,
                    10: epoch,
                    19: F.date_format(F.timestamp_micros("ts_us"), "yyyyMMdd'T'HHmmss"),
                    21: F.concat(
                        F.date_format(F.timestamp_micros(F.col("ts_us") + 19_800_000_000), "yyyy-MM-dd'T'HH:mm:ss"),
                        F.lit("+0530"),
                    ),
                    15: F.lit("12:00:00"),
                },
            ).alias("timestamp"),
            when(F.col("merchant_category"), {11: null, 12: F.lit("")}).alias(
                "merchant_category"
            ),
            when(F.col("lat").cast("string"), {6: F.lit("91.0"), 17: F.lit("inf")}).alias("location_lat"),
            when(F.col("lon").cast("string"), {7: F.lit("-181.0"), 18: F.lit("NaN")}).alias("location_lon"),
            # a message with residue 16 was sent twice
            F.explode(
                F.when(F.col("residue") == 16, F.array(F.lit(1), F.lit(2))).otherwise(
                    F.array(F.lit(1))
                )
            ).alias("delivery"),
        )
    )


def card_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`transactions` with the columns of the card data set."""
    card = F.col("card_id").cast("bigint")
    return transactions(spark, sf_dir).select(
        F.col("transaction_id").alias("trans_num"),
        card.alias("cc_num"),
        F.date_format(F.timestamp_micros("ts_us"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(
            "trans_date_trans_time"
        ),
        F.col("amount").cast("double").alias("amt"),
        F.col("merchant_id").alias("merchant"),
        F.col("merchant_category").alias("category"),
        "lat",
        F.col("lon").alias("long"),
        (F.col("lat") + 0.1).alias("merch_lat"),
        (F.col("lon") + 0.1).alias("merch_long"),
        F.lit("").alias("city"),
        F.lit("").alias("state"),
        (10000 + card).alias("zip"),
        (card * 100).alias("city_pop"),
        F.when(card % 11 == 0, F.lit("unknown"))
        .otherwise(F.date_add(F.lit("1950-01-01").cast("date"), (card % 15000).cast("int")).cast("string"))
        .alias("dob"),
        F.lit("").alias("first"),
        F.lit("").alias("last"),
        F.when(card % 2 == 0, "M").otherwise("F").alias("gender"),
        F.lit("").alias("job"),
        "is_fraud",
    )
