from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from swipeline.session import tune


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


DAY = 86_400_000_000
SECOND = 1_000_000
NOON = 1_707_566_400 * SECOND  # 2024-02-10 12:00:00 UTC


@pytest.fixture(scope="session")
def make(spark):
    """Transactions from (id, card, merchant, amount, ts_us) tuples."""

    def build(rows, lat=None, lon=None):
        data = [(*r[:3], "grocery", str(r[3]), r[4], lat, lon) for r in rows]
        frame = spark.createDataFrame(
            data,
            "transaction_id string, card_id string, merchant_id string,"
            " merchant_category string, amount string, ts_us bigint, lat double, lon double",
        )
        return frame.withColumn("amount", frame.amount.cast("decimal(18,2)"))

    return build


def by_id(frame, *columns):
    """{transaction_id: value or tuple of values}"""
    out = {}
    for row in frame.collect():
        values = tuple(row[c] for c in columns)
        out[row["transaction_id"]] = values[0] if len(columns) == 1 else values
    return out
