from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from swipeline.operators import velocity
from swipeline.session import shared_dir
from swipeline.sources import readers, writers
from swipeline.streaming import jobs
from tests.conftest import DAY, NOON, SECOND, by_id
from tests.test_velocity import COLUMNS, brute, collected, random_rows


@pytest.fixture
def feed(spark, make):
    """Feeds batches one by one through the feature job, each time from the checkpoint."""
    path = shared_dir(spark)

    def run(batches, late="1 hour", inline_rows=2000):
        progress = []
        for rows in batches:
            frame = make(rows, lat=1.0)
            frame.write.mode("append").parquet(f"{path}/in")
            job = jobs.feature_stream(
                readers.parquet_stream(spark, f"{path}/in", frame.schema),
                f"{path}/out", f"{path}/checkpoint", late, inline_rows,
            )
            job.awaitTermination()
            progress += job.recentProgress
        return spark.read.parquet(f"{path}/out"), progress

    return run


@pytest.mark.parametrize("inline_rows", [2000, 3])
def test_stream_equals_definition(feed, inline_rows):
    """Ties, bursts, a hot card and silences, cut into four batches in time order."""
    rows = sorted(random_rows(11, n=300), key=lambda r: (r[4], r[0]))
    cuts = [0, 90, 91, 220, 300]
    # a tie must not be cut in two: move the edges behind it
    for i in range(1, 4):
        while rows[cuts[i]][4] == rows[cuts[i] - 1][4]:
            cuts[i] += 1
    out, _ = feed([rows[a:b] for a, b in zip(cuts, cuts[1:])], inline_rows=inline_rows)
    assert collected(out) == brute(rows)


def test_stream_equals_batch_query(feed, make):
    rows = random_rows(12, n=200)
    out, _ = feed([rows])
    assert collected(out) == collected(velocity.card_history(make(rows)))


@pytest.mark.parametrize("inline_rows", [2000, 0])
def test_late_row_sees_its_own_time(feed, inline_rows):
    minute = 60 * SECOND
    out, _ = feed(
        [
            [("a", "c", "m1", 10, NOON), ("b", "c", "m2", 20, NOON + 30 * minute)],
            # within the watermark, but before the newest row of the card
            [("late", "c", "m3", 5, NOON + 5 * minute), ("z", "c", "m1", 1, NOON + 31 * minute)],
        ],
        inline_rows=inline_rows,
    )
    got = by_id(out, *COLUMNS)
    assert got["late"][:7] == (1, 1, 1, 10, 10, 10, 1)
    # the late row counts for the next one
    assert got["z"][:7] == (1, 3, 3, 20, 35, 35, 3)
    # the gap of a late row is negative: the last processed row is newer
    assert got["late"][8] == -25 * 60


def test_rows_behind_the_watermark_are_dropped_and_counted(feed):
    out, progress = feed(
        [[("a", "c", "m", 1, NOON)], [("old", "c", "m", 1, NOON - 2 * 3600 * SECOND)],
         [("b", "c", "m", 1, NOON + SECOND)]]
    )
    assert by_id(out, "tx_count_24h") == {"a": 0, "b": 1}
    assert sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"]) == 1


def test_state_expires_on_event_time(feed):
    """A silent card's state goes once the other cards' time has moved on."""
    busy = lambda first, last: [
        (f"k{i}", "busy", "m", 1, NOON + i * DAY) for i in range(first, last)
    ]
    out, progress = feed(
        [
            [(f"a{i}", f"idle{i}", "m", 200, NOON) for i in range(20)] + busy(0, 1),
            busy(1, 32), busy(32, 40),
            [("b", "idle0", "m", 200, NOON + 45 * DAY)],
        ]
    )
    got = by_id(out, "tx_count_24h", "ema_before", "time_since_last_tx")
    assert got["b"] == (0, 75.0, 0)
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(rows) > 20 and rows[-1] <= 10


def test_restart_continues_the_state(feed):
    out, _ = feed([[("a", "c", "m1", 10, NOON)]])
    assert out.count() == 1
    out, _ = feed([[("b", "c", "m2", 20, NOON + SECOND)]])
    assert by_id(out, "tx_count_10m", "unique_merchants_24h") == {"a": (0, 0), "b": (1, 1)}


def test_clean_stream_splits_and_continues(spark):
    path = shared_dir(spark)
    good = '{"transaction_id":"%s","card_id":"c","amount":"5","merchant_id":"m","timestamp":"1707580000"}'
    texts = [good % "1", good.replace('"5"', '"x"') % "2", "broken", good % "3"]
    frame = spark.createDataFrame([("k", t) for t in texts], "key string, value string")
    for part in (frame.limit(2), frame):
        part.write.mode("append").parquet(f"{path}/in")
        jobs.clean_stream(
            readers.parquet_stream(spark, f"{path}/in", frame.schema),
            f"{path}/good", f"{path}/dead", f"{path}/checkpoint",
        ).awaitTermination()
    assert spark.read.parquet(f"{path}/good").count() == 3
    assert spark.read.parquet(f"{path}/dead").count() == 3


def test_long_card_in_small_batches(feed):
    """Slots enter and leave over many batches of one busy card."""
    rng = random.Random(5)
    times = sorted(NOON + rng.randrange(3 * DAY) for _ in range(400))
    rows = [(f"{i:04d}", "c", f"m{rng.randrange(6)}", rng.randrange(1, 99), t) for i, t in enumerate(times)]
    out, _ = feed([rows[i:i + 100] for i in range(0, 400, 100)], inline_rows=50)
    assert collected(out) == brute(rows)
    assert out.agg(F.max("tx_count_24h")).first()[0] > 100


@pytest.mark.parametrize("inline_rows", [2000, 0])
def test_rows_behind_the_watermark_go_to_the_dead_letters(spark, make, inline_rows):
    """Accepted and late rows make up what was received; a late row leaves no trace in the state."""
    path = shared_dir(spark)
    hour = 3600 * SECOND
    batches = [
        [("a", "c", "m", 1, NOON), ("a2", None, "m", 1, NOON)],
        # behind the watermark, at it, just before it, and within it; a card of late rows alone
        [("old", "c", "m", 7, NOON - 2 * hour), ("edge", "c", "m", 1, NOON - hour), ("b", "c", "m", 1, NOON - hour + 1000),
         ("alone", "d", "m", 1, NOON - 3 * hour), ("keyless", None, "m", 1, NOON - 3 * hour)],
        [("c", "c", "m", 1, NOON + SECOND), ("d", "d", "m", 1, NOON + SECOND)],
    ]
    for rows in batches:
        frame = make(rows, lat=1.0)
        frame.write.mode("append").parquet(f"{path}/in")
        jobs.feature_stream(
            readers.parquet_stream(spark, f"{path}/in", frame.schema),
            f"{path}/out", f"{path}/checkpoint", inline_rows=inline_rows, keep_late=True,
        ).awaitTermination()
    on_time, late = jobs.on_time(spark, f"{path}/out"), jobs.late_rows(spark, f"{path}/out")
    assert by_id(on_time, "tx_count_24h", "total_amount_24h") == {
        "a": (0, 0.0), "a2": (0, 0.0), "b": (0, 0.0), "c": (2, 2.0), "d": (0, 0.0)
    }
    assert by_id(late, "amount", "ts_us", "reject_reason")["old"] == (7, NOON - 2 * hour, "late")
    assert set(by_id(late, "card_id")) == {"old", "edge", "alone", "keyless"}
    assert on_time.count() + late.count() == sum(map(len, batches))


def test_scoring_keeps_late_rows_too(spark, make):
    path = shared_dir(spark)
    merchants = spark.createDataFrame(
        [("m", 0.1, 0.1, 0)], "merchant_id string, merchant_risk_score double, merchant_fraud_rate double, n int"
    )
    for rows in ([("a", "c", "m", 1, NOON)], [("old", "c", "m", 7, NOON - DAY), ("b", "c", "m", 1, NOON + 1)]):
        frame = make(rows, lat=1.0)
        frame.write.mode("append").parquet(f"{path}/in")
        jobs.score_stream(
            readers.parquet_stream(spark, f"{path}/in", frame.schema), merchants,
            f"{path}/log", f"{path}/checkpoint", dead=f"{path}/dead",
        ).awaitTermination()
    log = writers.PredictionLog(spark, f"{path}/log").read()
    assert {r["transaction_id"] for r in log.collect()} == {"a", "b"}
    dead = spark.read.parquet(f"{path}/dead")
    assert [(r["transaction_id"], r["reject_reason"]) for r in dead.collect()] == [("old", "late")]


def test_many_visits_and_few_rows_spill(feed):
    """A card that is never idle keeps its merchants, one a day: they leave the single value."""
    rows = [(f"{i:02d}", "c", f"m{i % 13}", 5, NOON + i * 20 * 3600 * SECOND) for i in range(40)]
    out, _ = feed([rows[:15], rows[15:30], rows[30:]], inline_rows=5)
    assert collected(out) == brute(rows)
    assert out.agg(F.max("unique_merchants_since_idle")).first()[0] == 13


def test_frames_of_few_rows_are_not_aligned(monkeypatch):
    """A frame has the values as they are and is made without series, also with equal long lists."""
    import pandas as pd

    from swipeline.streaming import card_state

    def refuse(*args, **kwargs):
        raise AssertionError("a series is made per column")

    monkeypatch.setattr(card_state.pd, "Series", refuse)
    rows = [("t1", "c", "m", None, [1, None], [0.5, 75.0]), ("t2", "c", "m", "food", [2, 3], [None, 75.0])]
    frame = card_state._frame(rows)
    monkeypatch.undo()
    assert list(frame.columns) == card_state.OUTPUT.names
    assert list(frame.itertuples(index=False, name=None)) == rows
    assert (frame.dtypes == object).all() and isinstance(frame, pd.DataFrame)
