"""Sources: CSV and Parquet files, topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from swipeline.schemas import CARD_CSV


def csv(spark: SparkSession, path: str, schema: StructType = CARD_CSV) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def csv_stream(
    spark: SparkSession, path: str, schema: StructType = CARD_CSV, files_per_trigger: int = 1
) -> DataFrame:
    """Replay of a folder; the trigger option takes the place of a send rate."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .csv(path)
    )


def features(
    spark: SparkSession, path: str, time: str, start: Column, end: Column
) -> DataFrame:
    """Rows of a day-partitioned feature table within [start, end); other days are
    not read. `start` and `end` are timestamps."""
    day = F.col("event_date")
    return spark.read.parquet(path).where(
        (day >= F.to_date(start)) & (day <= F.to_date(end))
        & (F.col(time) >= start) & (F.col(time) < end)
    )


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 200
) -> DataFrame:
    """New files of a folder; the trigger option bounds a micro-batch, and with it what one
    card can bring at once."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def topic_stream(
    spark: SparkSession, servers: str, topic: str = "transactions", per_trigger: int = 1_000_000
) -> DataFrame:
    """Topic source from the earliest offset; needs Spark's connector package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )
