from __future__ import annotations

import pytest
from pyspark.sql import Observation, functions as F

from swipeline.operators import clean, quality, velocity
from swipeline.schemas import CARD_CSV
from swipeline.session import shared_dir
from swipeline.sources import messages, readers, tables, writers
from swipeline.streaming import jobs

SF = "/root/testdata/sf0.001"


def card_row(**changes):
    row = {
        "trans_num": "t1", "cc_num": 42, "trans_date_trans_time": "2024-02-10 12:00:00",
        "amt": 12.5, "merchant": "m", "category": "c", "lat": 1.0, "long": 2.0,
        "merch_lat": 3.0, "merch_long": 4.0, "city": "x", "state": "y", "zip": 123,
        "city_pop": 9, "dob": "1990-01-01", "first": "A", "last": "B", "gender": "F",
        "job": "j", "is_fraud": 1,
    } | changes
    return tuple(row[f] for f in CARD_CSV.names)


def test_card_row_to_message(spark):
    full, sparse = messages.to_message(
        spark.createDataFrame(
            [card_row(), card_row(lat=None, long=None, merch_lat=None, city_pop=None, is_fraud=None)],
            CARD_CSV,
        )
    ).collect()
    assert len(full) == 21
    assert (full.transaction_id, full.card_id, full.user_id) == ("t1", "42", "42")
    assert (full.amount, full.timestamp, full.zip, full.is_fraud) == (12.5, 1707566400, "123", 1)
    assert (sparse.location_lat, sparse.location_lon, sparse.merchant_lat) == (None, None, None)
    assert (sparse.city_pop, sparse.is_fraud, sparse.merchant_lon) == (0, 0, 4.0)


def test_csv_round_trip(spark, tmp_path):
    rows = [card_row(merchant='a "quoted", name'), card_row(trans_num="t2", lat=None)]
    frame = spark.createDataFrame(rows, CARD_CSV)
    frame.write.option("header", True).csv(str(tmp_path / "csv"))
    back = readers.csv(spark, str(tmp_path / "csv"))
    assert back.schema == CARD_CSV
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))


def test_encoded_message_is_keyed_by_card(spark):
    rows = messages.encode(messages.to_message(spark.createDataFrame([card_row(city="Zürich 🎉")], CARD_CSV)))
    assert rows.columns == ["key", "value"] and rows.first().key == "42"
    back = messages.decode(rows).first()
    assert (back.city, back.amount, back.timestamp) == ("Zürich 🎉", "12.5", "1707566400")


def test_history_leaves_out_broken_members_every_time(spark, make):
    members = messages.history_members(make([("a", "c", "m", 5, 7_500_000), ("b", "c", "m", 6, 9_000_000)]))
    broken = members.withColumn("value", F.when(F.col("transaction_id") == "a", "{").otherwise(F.col("value")))
    for _ in range(2):
        rows = messages.parse_history(broken).collect()
        assert [(r.transaction_id, r.amount, r.timestamp, r.score) for r in rows] == [("b", 6.0, 9, 9)]


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    frame = spark.range(72).select(
        "id", F.timestamp_seconds(F.lit(1707523200) + F.col("id") * 3600).alias("t")
    )
    writers.write_features(frame, str(tmp_path / "f"), "t")
    ts = lambda text: F.lit(text).cast("timestamp")
    out = readers.features(spark, str(tmp_path / "f"), "t", ts("2024-02-11 06:00:00"), ts("2024-02-11 08:00:00"))
    assert sorted(r.id for r in out.collect()) == [30, 31]
    assert len(out.inputFiles()) >= 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t" in plan


def test_counts_come_with_the_write(spark):
    cleaned = clean.clean(tables.raw_messages(spark, SF))
    seen = Observation("run")
    good = F.col("reject_reason").isNull()
    cleaned.observe(seen, F.count_if(good).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == quality.run_metrics(cleaned).first().n_processed


def test_stream_progress_has_the_counts(spark):
    path = shared_dir(spark)
    messages.encode(tables.raw_messages(spark, SF).drop("delivery")).write.parquet(f"{path}/in")
    job = jobs.clean_stream(
        readers.parquet_stream(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema),
        f"{path}/good", f"{path}/dead", f"{path}/checkpoint",
    )
    job.awaitTermination()
    (run,) = [p["observedMetrics"]["run"] for p in job.recentProgress if "run" in p["observedMetrics"]]
    assert run["n_processed"] == spark.read.parquet(f"{path}/good").count() > 0
    assert run["n_failed"] == spark.read.parquet(f"{path}/dead").count() > 0


@pytest.mark.parametrize(("average", "want"), [(0.0, (75.0, 1.0, 2.0)), (None, (75.0, 1.0, 2.0)), (100.0, (100.0, 0.5, 1.5))])
def test_stored_average_zero_counts_as_missing(spark, average, want):
    row = spark.range(1).select(F.lit(150.0).alias("amount"), F.lit(average).cast("double").alias("ema_before"))
    assert tuple(row.select(*[c.alias(n) for n, c in velocity.rolling_columns().items()]).first()) == want
