from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from swipeline import config
from swipeline.operators import offline, store
from swipeline.plans import realtime
from swipeline.schemas import TRANSACTION_FEATURES as VIEW, FeatureView
from swipeline.sources.writers import VersionedTable, write_features


def sides(spark, seed=1, n=300):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(5)}"
    spine = [(i, key(), rng.randrange(0, 2000) * 1_000_000) for i in range(n)]
    feats = [(key(), rng.randrange(0, 2000) * 1_000_000, f"{i:04d}", float(i)) for i in range(n)]
    return (
        spine, feats,
        spark.createDataFrame(spine, "n int, k string, t bigint"),
        spark.createDataFrame(feats, "k string, ft bigint, tie string, v double"),
    )


@pytest.mark.parametrize("limit", [None, 25])
def test_as_of_join_against_brute_force(spark, limit):
    spine, feats, a, b = sides(spark)
    ttl = 60
    got = {
        r.n: (r.feature_time, r.v)
        for r in store.as_of_join(a, b, "k", "t", "ft", ["v"], ttl, "tie", limit=limit).collect()
    }
    assert len(got) == len(spine)
    hits = 0
    for n, k, t in spine:
        known = [f for f in feats if f[0] == k and f[1] <= t]
        best = max(known, key=lambda f: (f[1], f[2])) if known else None
        if best is None or t - best[1] > ttl * 1_000_000:
            assert got[n] == (None, None)
        else:
            hits += 1
            assert got[n] == (best[1], best[3])
    assert 0 < hits < len(spine)


def test_as_of_join_is_one_exchange(spark):
    _, _, a, b = sides(spark)
    out = store.as_of_join(a, b, "k", "t", "ft", ["v"], 60, "tie")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", 10, "1", 1.0), ("a", 20, "2", 2.0), ("a", 20, "3", 3.0), ("b", 30, "4", 4.0)]
    return spark.createDataFrame(data, "card_id string, ts_us bigint, transaction_id string, x double")


def values(frame):
    return {r.card_id: r.x for r in frame.collect()}


def test_materialize_is_half_open(rows):
    run = lambda a, b: values(
        store.materialize(rows, "card_id", "ts_us", "transaction_id", F.lit(a), F.lit(b))
    )
    assert run(0, 100) == {"a": 3.0, "b": 4.0}
    assert run(10, 20) == {"a": 1.0}
    assert run(20, 30) == {"a": 3.0}


def versioned(spark, path, full_every=20):
    return VersionedTable(spark, str(path), "card_id", "ts_us", "transaction_id", full_every)


@pytest.mark.parametrize("full_every", [1, 2, 20])
def test_incremental_equals_full(spark, rows, tmp_path, full_every):
    table = versioned(spark, tmp_path / "cards", full_every)
    assert table.read() is None
    slices = [(0, 15), (15, 20), (20, 25), (25, 100)]
    part = lambda a, b: rows.where((F.col("ts_us") >= a) & (F.col("ts_us") < b))
    for version, (a, b) in enumerate(slices):
        table.upsert(part(a, b), version)
    full = store.materialize(rows, "card_id", "ts_us", "transaction_id")
    assert values(table.read()) == values(full)
    # a repeated version replaces its own output
    before = table.parts()
    table.upsert(part(25, 100), 3)
    assert table.parts() == before and values(table.read()) == values(full)
    assert len(before) == {1: 1, 2: 2, 20: 4}[full_every]


def test_a_version_without_success_does_not_count(spark, rows, tmp_path):
    table = versioned(spark, tmp_path / "cards")
    table.upsert(rows, 0)
    (tmp_path / "cards" / "full=1").mkdir()
    (tmp_path / "cards" / "change=1").mkdir()
    assert [p.rsplit("/", 1)[1] for p in table.parts()] == ["full=0"]


def test_older_update_does_not_win(spark, rows):
    published = store.materialize(rows, "card_id", "ts_us", "transaction_id")
    late = spark.createDataFrame([("a", 15, "9", 9.0), ("c", 1, "8", 8.0)], rows.schema)
    out = store.upsert_latest(published, late, "card_id", "ts_us", "transaction_id")
    assert values(out) == {"a": 3.0, "b": 4.0, "c": 8.0}


def test_lookup_defaults(spark):
    cards = spark.createDataFrame(
        [("full", "3", "7.5", "0"), ("part", "2", None, None), ("bad", "x", "y", None)],
        "card_id string, tx_count_1h string, avg_tx_amount_30d string, is_new_card string",
    )
    keys = spark.createDataFrame([("full",), ("part",), ("bad",), ("none",)], "card_id string")
    out = {r.card_id: r for r in store.lookup_card(keys, cards).collect()}
    assert (out["full"].card_tx_count_1h, out["full"].card_avg_tx_amount_30d, out["full"].card_is_new_card) == (3, 7.5, 0)
    assert (out["part"].card_tx_count_1h, out["part"].card_avg_tx_amount_30d, out["part"].card_is_new_card) == (2, 75.0, 1)
    assert (out["bad"].card_tx_count_1h, out["bad"].card_avg_tx_amount_30d) == (0, 75.0)
    assert {c: out["none"][f"card_{c}"] for c in config.CARD_DEFAULTS} == config.CARD_DEFAULTS
    merchant = store.lookup_merchant(
        keys.withColumn("merchant_id", F.col("card_id")),
        spark.createDataFrame([("full", 0.9)], "merchant_id string, risk_score double"),
    )
    got = {r.merchant_id: (r.merchant_risk_score, r.merchant_fraud_rate, r.merchant_total_transactions) for r in merchant.collect()}
    assert got["full"] == (0.9, 0.002, 100) and got["none"] == (0.5, 0.002, 100)


def published(spark):
    return spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 10.0), (2, "2024-01-10 00:00:00", 20.0)],
        "cc_num long, event_timestamp string, amt double",
    ).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def test_online_features_expire(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "cc_num long")
    out = store.online_features(
        keys, published(spark), replace(VIEW, ttl_seconds=5 * 86400), ["transaction_features:amt"],
        F.lit("2024-01-12 00:00:00").cast("timestamp"), {"current_amt": 5.0},
    )
    assert {r.cc_num: (r.amt, r.current_amt) for r in out.collect()} == {
        1: (None, 5.0), 2: (20.0, 5.0), 3: (None, 5.0),
    }


def test_unknown_reference_is_an_error():
    with pytest.raises(ValueError, match="other_view:amt"):
        VIEW.select(["transaction_features:amt", "other_view:amt"])
    with pytest.raises(ValueError, match="nothing"):
        VIEW.select(["transaction_features:nothing"])


def test_request_features(spark):
    rows = spark.createDataFrame(
        [(600.0, "m1", 200.0, 48, "m1"), (500.0, "m1", 0.0, None, None)],
        "current_amt double, current_merchant string, avg_amt_7d double, tx_count_24h long, merchant string",
    )
    got = [
        (r.amt_ratio_to_avg, r.is_high_value, r.is_same_merchant, r.velocity_score)
        for r in store.request_features(rows).collect()
    ]
    assert got == [(3.0, 1, 1, 2.0), (1.0, 0, 0, 0.0)]


def test_view_check(spark, tmp_path):
    from swipeline.sources import tables

    table = offline.offline_features(tables.card_rows(spark, "/root/testdata/sf0.001"))
    assert VIEW.schema_differences(table) == []
    row = VIEW.check(table).first()
    assert (row.null_keys, row.null_event_times, row.schema_differences) == (0, 0, 0)
    assert VIEW.schema_differences(table.drop("age").withColumn("amt", F.col("amt").cast("string"))) == [
        "amt: expected double, found string", "age: expected bigint, found nothing",
    ]
    write_features(table, str(tmp_path / "f"), "event_timestamp")
    back = spark.read.parquet(str(tmp_path / "f"))
    one = back.where(F.col("event_date") == "2024-01-05")
    assert 0 < one.count() < back.count() == table.count()
    assert "PartitionFilters: [isnotnull(event_date" in one._jdf.queryExecution().executedPlan().toString()


def test_vector_has_the_22_features():
    assert len(realtime.VECTOR) == len(set(realtime.VECTOR)) == 22


def three_views(spark):
    """Spine and three tables of one key and one of another; a hot key, ties and null keys."""
    rng = random.Random(8)
    key = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    moment = lambda: datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(500))
    spine = [(i, key(), rng.randrange(3), moment()) for i in range(120)]
    spine_frame = spark.createDataFrame(spine, "n int, k string, j int, event_timestamp timestamp")
    sources, rows = [], {}
    for name, on, ttl in (("one", "k", 20), ("two", "k", 300), ("three", "k", 5000), ("four", "j", 40)):
        rows[name] = (on, ttl, [((key() if on == "k" else rng.randrange(4)), moment(), f"{i:03d}", i) for i in range(90)])
        kind = "string" if on == "k" else "int"
        frame = spark.createDataFrame(rows[name][2], f"{on} {kind}, event_timestamp timestamp, tie string, v int")
        fields = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("tie", T.StringType())])
        sources.append((FeatureView(name, on, "event_timestamp", ttl, fields), frame, "tie"))
    return spine, spine_frame, sources, rows


REFERENCES = ["one:v", "three:v", "two:tie", "four:v", "two:v"]


@pytest.mark.parametrize("limit", [None, 10])
def test_several_views_against_brute_force(spark, limit):
    spine, frame, sources, rows = three_views(spark)
    out = store.historical_views(frame, sources, REFERENCES, full_names=True, limit=limit)
    assert out.columns == ["n", "k", "j", "event_timestamp", *[r.replace(":", "__") for r in REFERENCES]]
    got = {r["n"]: r for r in out.collect()}
    assert len(got) == len(spine)
    for n, k, j, at in spine:
        for name, (on, ttl, known) in rows.items():
            mine = [f for f in known if f[0] is not None and f[0] == (k if on == "k" else j) and f[1] <= at]
            best = max(mine, key=lambda f: (f[1], f[2]), default=None)
            if best is not None and at - best[1] > timedelta(seconds=ttl):
                best = None
            assert got[n][f"{name}__v"] == (best and best[3])


def test_views_of_one_key_share_the_exchange_and_the_sort(spark):
    _, frame, sources, _ = three_views(spark)
    out = store.historical_views(frame, sources, ["one:v", "two:tie", "three:v"], full_names=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert plan.count("Sort [") == 1


def test_names_of_views_must_be_known_and_apart(spark):
    _, frame, sources, _ = three_views(spark)
    for references in (["one:v", "two:v"], ["one:v", "one:v"], ["five:v"], ["one:x"]):
        with pytest.raises(ValueError):
            store.historical_views(frame, sources, references)
    assert store.historical_views(frame, sources, ["one:v"]).columns[-1] == "v"
