from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from swipeline.operators import offline


def digest(key):
    return "" if key is None else hashlib.md5(f"42:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    """Single keys, a third of the rows with one key, null keys."""
    keys = [str(i) for i in range(400)] + ["hot"] * 220 + [None] * 30
    data = [(k, i) for i, k in enumerate(keys)]
    return data, spark.createDataFrame(data, "transaction_id string, n int").repartition(6)


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("n", [0, 1, 17, 30, 31, 200, 325, 649, 650, 900])
def test_same_rows_as_the_sorted_head(rows, n, digits, monkeypatch):
    monkeypatch.setattr(offline, "DIGITS", digits)
    data, frame = rows
    got = offline.sample_n(frame, n).collect()
    assert len(got) == min(n, len(data)) == len({r["n"] for r in got})
    ordered = sorted(data, key=lambda r: digest(r[0]))
    assert sorted(digest(r["transaction_id"]) for r in got) == [digest(k) for k, _ in ordered[:n]]


def test_every_cut_through_the_copies(rows):
    data, frame = rows
    before = sum(digest(k) < digest("hot") for k, _ in data)
    for extra in (1, 100, 219, 220):
        got = offline.sample_n(frame, before + extra)
        assert got.where("transaction_id = 'hot'").count() == extra


def test_half_a_table_without_a_sort(spark):
    frame = spark.range(200_000).select(F.col("id").cast("string").alias("transaction_id"))
    drawn = offline.sample_n(frame, 100_000)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange" not in plan and "Sort" not in plan
    assert drawn.count() == 100_000
    assert offline.sample_n(frame, 100_000).exceptAll(drawn).isEmpty()


def test_empty_table(spark):
    frame = spark.createDataFrame([], "transaction_id string, n int")
    assert offline.sample_n(frame, 5).count() == 0
