from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from swipeline.operators import distributions as d, monitoring
from swipeline.session import shared_dir
from swipeline.sources import readers
from swipeline.streaming import jobs, run_log
from tests.conftest import DAY, NOON, by_id

SCHEMA = "transaction_id string, amount decimal(18,2), x double, ts_us bigint"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = [
        (str(i), None if i % 50 == 0 else f"{rng.lognormvariate(3, 2):.2f}", float("nan") if i % 70 == 0 else rng.gauss(0, 1), NOON + rng.randrange(3) * DAY)
        for i in range(30_000)
    ]
    frame = spark.createDataFrame(data, "transaction_id string, amount string, x double, ts_us bigint")
    return data, frame.withColumn("amount", F.col("amount").cast("decimal(18,2)")).repartition(7)


@pytest.mark.parametrize("parts", [1, 9])
def test_ranks_of_merged_sketches_are_within_the_bound(spark, rows, parts):
    """Sketches of many parts, stored and merged, are as exact as one."""
    data, frame = rows
    path = shared_dir(spark)
    for k in range(parts):
        part = frame.where(F.col("transaction_id").cast("int") % parts == k)
        jobs.write_batch(d.sketches(part, ["amount", "x"]), path, k)
    stored = d.merged(spark.read.parquet(path), "feature")
    for feature, column in (("amount", 1), ("x", 2)):
        values = sorted(float(r[column]) for r in data if r[column] is not None and float(r[column]) == float(r[column]))
        for percent in (1, 25, 50, 90, 99):
            got = stored.where(F.col("feature") == feature).select(
                F.kll_sketch_get_quantile_double("sketch", F.lit(percent / 100)).alias("q")
            ).first()["q"]
            low, high = bisect.bisect_left(values, got) / len(values), bisect.bisect_right(values, got) / len(values)
            assert low - d.RANK_ERROR <= percent / 100 <= high + d.RANK_ERROR


def test_clip_uses_the_day_before_alone(spark):
    rows = [(f"a{i}", f"{i}.00", 0.0, NOON) for i in range(1, 101)]
    rows += [("low", "3.00", 0.0, NOON + DAY), ("high", "5000.00", 0.0, NOON + DAY), ("null", None, 0.0, NOON + DAY),
             ("gap", "7000.00", 0.0, NOON + 3 * DAY)]
    frame = spark.createDataFrame(rows, "transaction_id string, amount string, x double, ts_us bigint")
    frame = frame.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    out = d.clip_by_day(frame, d.limits(d.sketches(frame, ["amount"])))
    assert dict(out.dtypes)["amount_clipped"] == "decimal(18,2)"
    got = by_id(out, "amount_clipped")
    assert got["a100"] == 100 and got["low"] == 3 and got["null"] is None and got["gap"] == 7000
    assert 99 <= got["high"] <= 100


def test_clip_stream_reads_what_was_stored(spark, make):
    path = shared_dir(spark)
    days = [[(f"{k}-{i}", "c", "m", i + 1, NOON + k * DAY) for i in range(100)] for k in range(2)]
    for rows in [*days, [("big", "c", "m", 900, NOON + 2 * DAY)]]:
        frame = make(rows)
        frame.write.mode("append").parquet(f"{path}/in")
        jobs.clip_stream(
            readers.parquet_stream(spark, f"{path}/in", frame.schema), f"{path}/out", f"{path}/fitted", f"{path}/checkpoint"
        ).awaitTermination()
    got = by_id(spark.read.parquet(f"{path}/out"), "amount_clipped")
    assert len(got) == 201 and got["0-99"] == 100 and 99 <= got["big"] <= 100


def test_stored_drift_equals_the_direct_one(spark, rows):
    _, frame = rows
    first = frame.where(F.col("ts_us") == NOON)
    fixed = d.edges(first, ["x"])
    stored = d.histograms(first, fixed, ["x"])
    out = d.drift_by_day(stored, d.histograms(frame, fixed, ["x"]))
    clean = frame.where(~F.isnan("x"))
    for r in out.collect():
        day = clean.where(d.day_of() == F.lit(r["day"]))
        direct = monitoring.psi(clean.where(F.col("ts_us") == NOON), day, "x").first()["psi"]
        assert r["psi"] == pytest.approx(direct) and r["n"] == day.count()
    # histograms of parts add up
    halves = [d.histograms(first.where(F.col("transaction_id").cast("int") % 2 == k), fixed, ["x"]) for k in (0, 1)]
    both = d.drift_by_day(halves[0].unionByName(halves[1]), stored).first()
    assert both["psi"] == pytest.approx(0.0)


def test_run_log_goes_on_after_a_restart_and_replaces_repeated_batches(spark):
    path = shared_dir(spark)
    good = '{"transaction_id":"%s","card_id":"c","amount":"5.50","merchant_id":"m","timestamp":"1707580000"}'
    batches = [[good % "1", good % "2", "broken"], [good % "3"], ["broken", "broken"]]
    for k, texts in enumerate(batches):
        log = run_log.RunLog(spark, f"{path}/runs")  # a new driver would have a new one
        spark.streams.addListener(log)
        frame = spark.createDataFrame([("k", t) for t in texts], "key string, value string")
        frame.write.mode("append").parquet(f"{path}/in")
        job = jobs.clean_stream(
            readers.parquet_stream(spark, f"{path}/in", frame.schema), f"{path}/good", f"{path}/dead", f"{path}/checkpoint"
        )
        log.wait(job)
        spark.streams.removeListener(log)
    row = run_log.run_metrics(log.read()).first()
    assert (row.n_processed, row.n_failed, row.n_batches) == (3, 3, 3)
    assert (row.success_percent, row.avg_amount) == (50.0, 5.5)

    class Event:
        progress = type("P", (), {
            "id": job.id, "timestamp": "t", "numInputRows": 1, "batchId": 1,
            "observedMetrics": {"run": {"n_processed": 1, "n_failed": 0, "total_amount": None}},
        })

    log.onQueryProgress(Event)  # batch 1 once more
    assert run_log.run_metrics(log.read()).first().n_batches == 3
