"""Cases that earlier versions got wrong."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from swipeline.functions import cleaning
from swipeline.operators import clean, hot, monitoring, predictions, store, velocity
from swipeline.plans import queries, stream_queries
from swipeline.sources import writers
from tests.conftest import DAY, NOON, SECOND


def test_null_keys_match_nothing(spark):
    spine = spark.createDataFrame([(1, None, 100), (2, "a", 100)], "id int, k string, t bigint")
    features = spark.createDataFrame([(None, 50, 7), ("a", 60, 8)], "k string, t bigint, v int")
    out = store.as_of_join(spine, features, "k", "t", "t", ["v"], 10, "v")
    assert {r.id: (r.feature_time, r.v) for r in out.collect()} == {1: (None, None), 2: (60, 8)}


def test_published_card_counts_its_last_merchant(make):
    rows = make([("1", "a", "m1", 1, NOON), ("2", "a", "m2", 1, NOON + SECOND), ("3", "b", "m1", 1, NOON),
                 ("4", "b", "m1", 1, NOON + DAY + 1), ("5", "c", "m1", 1, NOON)])
    out = {r.card_id: r for r in store.card_snapshot(velocity.card_history(rows)).collect()}
    assert {k: (r.tx_count_24h, r.unique_merchants_24h) for k, r in out.items()} == {"a": (2, 2), "b": (1, 1), "c": (1, 1)}


def test_money_from_doubles(spark, make):
    rows = make([("1", "a", "m", "0.29", NOON), ("2", "a", "m", "0.58", NOON + 1), ("3", "a", "m", "1", NOON + 2)])
    rows = rows.withColumn("amount", F.col("amount").cast("double"))
    out = {r.transaction_id: r.total_amount_10m for r in velocity.velocity_amounts(rows).collect()}
    assert out == {"1": 0.0, "2": pytest.approx(0.29), "3": pytest.approx(0.87)}
    clipped = clean.clip_at_percentile(rows.select("amount").limit(1), percent=100).first()
    assert float(clipped.amount_clipped) == float(clipped.amount)


@pytest.mark.parametrize(("text", "seconds"), [
    ("2024-02-10T12:00:00Z", 1707566400), ("20240210T120000", 1707566400), ("20240210T1200", 1707566400),
    ("2024-02-10T17:30:00+0530", 1707566400), ("20240210T173000+05:30", 1707566400), ("2024-02-10", 1707523200),
    ("2024-02-10 12:00:00.25-00:00", 1707566400), ("2024-0210", None), ("20240210T12:00:0", None), ("12:00:00", None),
])
def test_iso_forms(spark, text, seconds):
    row = spark.range(1).select(cleaning.epoch_seconds(F.lit(text)).alias("s")).first()
    assert row.s == seconds


@pytest.mark.parametrize(("lat", "reason"), [
    ("inf", cleaning.BAD_LATITUDE), ("NaN", cleaning.BAD_LATITUDE), ("-Infinity", cleaning.BAD_LATITUDE),
    ("north", cleaning.CAST_ERROR), ("90", None), (None, None),
])
def test_infinite_coordinates_are_out_of_range(spark, lat, reason):
    message = {"transaction_id": "1", "card_id": "c", "merchant_id": "m", "amount": "1", "timestamp": "1707566400",
               "merchant_category": "x", "location_lat": lat, "location_lon": "0"}
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in message.items()])
    assert clean.clean(row).first().reject_reason == reason


def test_slices_keep_rows_without_a_time(spark):
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, n bigint")
    parts = [sorted(r.id for r in p.collect()) for p in stream_queries.slices(rows, "n")]
    assert sorted(sum(parts, [])) == [1, 2, 3] and 1 in parts[0]
    assert [p.count() for p in stream_queries.slices(rows.where("n is null"), "n")] == [1]


def test_every_hot_key_is_split_into_as_many_pieces_as_it_needs(spark, make):
    rows = [(str(k), f"c{k % 3}" if k < 3000 else "d", "m", 1, NOON + k) for k in range(3010)]
    split = hot.split_hot(make(rows), "card_id", "ts_us", limit=4)
    assert split.cuts.pieces == 256 and split.cuts.table.count() == 4
    pieces = hot.with_piece(split.hot, split.cuts, "card_id", "ts_us")
    assert pieces.groupBy("card_id", hot.PIECE).count().agg(F.max("count")).first()[0] <= 12


def test_log_reads_the_touched_buckets_only(spark, tmp_path):
    log = writers.PredictionLog(spark, f"{tmp_path}/log")
    rows = lambda ids: spark.createDataFrame([(str(i), "b") for i in ids], "transaction_id string, created_at string")
    log.append(rows(range(2000)), 0)
    log.append(rows([5, 5, 7000]), 1)
    log.append(rows([5, 5, 7000, 8000]), 1)  # a retry
    assert sorted(int(r[0]) for r in log.read().select("transaction_id").collect()) == [*range(2000), 7000, 8000]
    bucket = F.pmod(F.xxhash64("transaction_id"), F.lit(log.BUCKETS)).cast("int").alias("bucket")
    known = log.known(rows([5, 9000]).select("transaction_id", bucket))
    assert [r[0] for r in known.collect()] == ["5"]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)


def test_late_labels(spark):
    log = spark.createDataFrame([("1", None), ("2", 0), ("3", None)], "transaction_id string, actual_label int")
    late = spark.createDataFrame([("1", 1), ("1", 0), ("2", None)], "transaction_id string, actual_label int")
    out = predictions.with_labels(log, late)
    assert {r.transaction_id: r.actual_label for r in out.collect()} == {"1": 1, "2": 0, "3": None}
    assert predictions.labelled(out).count() == 2


def test_merchant_risk_knows_no_later_label(spark, make):
    rows = make([(str(k), "a", "m", 1, NOON + k * DAY) for k in range(3)])
    rows = rows.withColumn("is_fraud", (F.col("transaction_id") == "2").cast("int"))
    out = sorted(monitoring.merchant_risk_history(rows).collect(), key=lambda r: r.known_us)
    assert [(r.total_transactions, round(r.fraud_rate, 4)) for r in out] == [(1, 0.0), (2, 0.0), (3, 0.3333)]
    assert all(r.known_us > NOON + k * DAY for k, r in enumerate(out))


def test_training_is_neither_blind_nor_told(spark):
    row = queries.REGISTRY["train_model"](spark, "/root/testdata/sf0.01").first()
    assert 0.4 < row.pr_auc < 0.99


def test_many_drifts_equal_one(spark):
    a = spark.range(200).select((F.col("id") % 17).alias("x"), F.lit(1).alias("y"))
    b = spark.range(300).select((F.col("id") % 23).alias("x"), F.lit(2).alias("y"))
    many = {r.feature: r.psi for r in monitoring.psi_features(a, b, ["x", "y"]).collect()}
    assert many["x"] == pytest.approx(monitoring.psi(a, b, "x").first().psi) and many["y"] == 0


def test_drift_of_a_feature_without_expected_values(spark):
    a = spark.range(20).select(F.col("id").alias("x"), F.lit(None).cast("double").alias("y"))
    b = spark.range(30).select(F.col("id").alias("x"), F.lit(2.0).alias("y"))
    got = {r.feature: r.psi for r in monitoring.psi_features(a, b, ["x", "y"]).collect()}
    assert set(got) == {"x", "y"} and got["y"] == 0 and got["x"] > 0


def test_slices_are_dealt_evenly(spark):
    """Rows that come in order of time: every slice is spread over all files."""
    rows = spark.range(0, 4000, 1, 4).withColumnRenamed("id", "n")
    files = 2 * spark.sparkContext.defaultParallelism
    for part in stream_queries.slices(rows, "n"):
        sizes = [r["count"] for r in part.groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) in (1999, 2001) and len(sizes) == files and max(sizes) < 2 * 2000 / files
