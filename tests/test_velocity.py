from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from swipeline import config
from swipeline.operators import hot, offline, store, velocity
from tests.conftest import DAY, NOON, SECOND, by_id

COLUMNS = [
    "tx_count_10m", "tx_count_1h", "tx_count_24h",
    "total_amount_10m", "total_amount_1h", "total_amount_24h",
    "unique_merchants_24h", "unique_merchants_since_idle", "time_since_last_tx",
]


def test_counts_per_window(make):
    tx = make(
        [
            ("a", "c", "m1", 10, NOON - 7200 * SECOND),
            ("b", "c", "m2", 20, NOON - 1800 * SECOND),
            ("d", "c", "m1", 30, NOON - 300 * SECOND),
            ("e", "c", "m3", 40, NOON),
            ("f", "other", "m3", 99, NOON - 1),
        ]
    )
    row = by_id(velocity.card_history(tx), *COLUMNS)["e"]
    assert row == (1, 2, 3, 30, 50, 60, 2, 2, 300)


def test_first_transaction(make):
    tx = make([("a", "c", "m", 100, NOON)])
    out = velocity.ema_amount(velocity.card_history(tx).drop("ema_before"))
    row = by_id(out, *COLUMNS, "avg_tx_amount_30d", "amount_vs_avg_ratio")["a"]
    assert row == (0, 0, 0, 0, 0, 0, 0, 0, 0, 75.0, 1.333)


def test_windows_are_closed(make):
    tx = make(
        [
            ("at-edge", "c", "m", 1, NOON - 600 * SECOND),
            ("past-edge", "c", "m", 1, NOON - 600 * SECOND - 1),
            ("now", "c", "m", 1, NOON),
        ]
    )
    assert by_id(velocity.velocity_counts(tx), "tx_count_10m")["now"] == 1


def test_the_future_is_not_seen(make):
    tx = make([("a", "c", "m", 1, NOON - 3600 * SECOND), ("b", "c", "m", 1, NOON),
               ("c", "c", "m", 1, NOON + 3600 * SECOND)])
    assert by_id(velocity.velocity_counts(tx), "tx_count_1h") == {"a": 0, "b": 1, "c": 1}


def test_equal_timestamps_count_in_id_order(make):
    tx = make([(i, "c", "m" + i, 5, NOON) for i in ("x", "y", "z")])
    out = by_id(velocity.card_history(tx), "tx_count_10m", "unique_merchants_24h")
    assert out == {"x": (0, 0), "y": (1, 1), "z": (2, 2)}


def test_merchant_leaves_after_a_day_but_not_after_idle(make):
    # m1 only at the start, m2 keeps the card active
    rows = [("0", "c", "m1", 1, NOON)]
    rows += [(str(i), "c", "m2", 1, NOON + i * DAY // 2) for i in range(1, 5)]
    out = by_id(velocity.card_history(make(rows)), "unique_merchants_24h", "unique_merchants_since_idle")
    assert out["2"] == (2, 2)      # m1 exactly a day ago: still in
    assert out["3"] == (1, 2)      # m1 gone from the window, not from the active period


def test_average_update(make):
    tx = make([("a", "c", "m", 200, NOON), ("b", "c", "m", 150, NOON + 1)])
    out = by_id(velocity.ema_amount(tx), "avg_tx_amount_30d")
    assert out == {"a": 75.0, "b": 87.5}


def test_average_and_gap_are_forgotten_after_thirty_days(make):
    tx = make([("a", "c", "m", 200, NOON), ("b", "c", "m", 200, NOON + 30 * DAY),
               ("d", "c", "m", 200, NOON + 60 * DAY + 1)])
    out = by_id(velocity.card_history(tx), "ema_before", "time_since_last_tx")
    assert out["b"] == (pytest.approx(87.5), 30 * 86400)
    assert out["d"] == (75.0, 0)


def test_long_card_average_matches_a_plain_loop(make):
    rng = random.Random(1)
    amounts = [round(rng.uniform(1, 9000), 2) for _ in range(3200)]
    tx = make([(f"{i:05d}", "c", "m", a, NOON + i) for i, a in enumerate(amounts)])
    out = by_id(velocity.ema_amount(tx), "ema_before")
    average = 75.0
    for i, a in enumerate(amounts):
        assert out[f"{i:05d}"] == pytest.approx(average, rel=1e-12)
        average = 0.1 * a + 0.9 * average


def brute(rows):
    """Every lookback feature by its definition."""
    out = {}
    cards = {}
    for r in sorted(rows, key=lambda r: (r[4], r[0])):
        cards.setdefault(r[1], []).append(r)
    for card in cards.values():
        ema, active, last = 75.0, set(), None
        for i, (tx_id, _, merchant, amount, us) in enumerate(card):
            if last is not None and us - last > 30 * DAY:
                ema, last = 75.0, None
            if last is None or us - last > DAY:
                active = set()
            seen = {
                w: [r for r in card[:i] if r[4] >= us - s * SECOND]
                for w, s in config.VELOCITY_WINDOWS.items()
            }
            out[tx_id] = (
                *[len(v) for v in seen.values()],
                *[round(sum(r[3] for r in v), 2) for v in seen.values()],
                len({r[2] for r in seen["24h"]}),
                len(active),
                0 if last is None else us // SECOND - last // SECOND,
                round(ema, 6),
            )
            ema = 0.1 * amount + 0.9 * ema
            active.add(merchant)
            last = us
    return out


def random_rows(seed, n=400, cards=4, span=40 * DAY):
    """A third of the rows on one card, many ties, bursts and long silences."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if rng.random() < 0.4 else f"c{rng.randrange(cards)}"
        us = NOON + rng.choice([rng.randrange(span), rng.randrange(3 * DAY) // (900 * SECOND) * 900 * SECOND])
        rows.append((f"{i:04d}", card, f"m{rng.randrange(9)}", round(rng.uniform(1, 500), 2), us))
    return rows


def collected(frame):
    return {
        k: (*v[:3], *[round(float(x), 2) for x in v[3:6]], *v[6:9], round(v[9], 6))
        for k, v in by_id(frame, *COLUMNS, "ema_before").items()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_plain_path_against_brute_force(make, seed):
    rows = random_rows(seed)
    assert collected(velocity.card_history(make(rows))) == brute(rows)


def test_hot_path_against_brute_force(make):
    rows = random_rows(3)
    # every card above the limit is cut into pieces and scanned
    assert collected(velocity.card_history(make(rows), limit=20)) == brute(rows)


def test_only_hot_cards_are_cut(spark, make):
    rows = random_rows(4)
    split = hot.split_hot(make(rows), "card_id", "ts_us", limit=120)
    assert {r.card_id for r in split.hot.select("card_id").distinct().collect()} == {"hot"}
    assert split.cold.where(F.col("card_id") == "hot").count() == 0
    pieces = hot.with_piece(split.hot, split.cuts, "card_id", "ts_us")
    sizes = [r["count"] for r in pieces.groupBy(hot.PIECE).count().collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes)


def test_smaller_hot_cards_get_fewer_pieces(make):
    rows = [(f"a{i}", "big", "m", 1, NOON + i) for i in range(800)]
    rows += [(f"b{i}", "small", "m", 1, NOON + i) for i in range(150)]
    split = hot.split_hot(make(rows), "card_id", "ts_us", limit=100)
    cuts = {r.card_id: len(r[hot.CUTS]) for r in split.cuts.table.collect()}
    assert cuts == {"big": 7, "small": 1}
    pieces = hot.with_piece(split.hot, split.cuts, "card_id", "ts_us")
    sizes = {(r.card_id, r[hot.PIECE]): r["count"] for r in pieces.groupBy("card_id", hot.PIECE).count().collect()}
    assert len(sizes) == 10 and max(sizes.values()) <= 110


def test_ordinary_cards_need_one_exchange(make):
    plan = velocity.card_history(make(random_rows(5)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("limit", [None, 20])
def test_offline_steps_against_brute_force(make, limit):
    rows = random_rows(6)
    tx = make(rows)
    steps = [offline.average_of_last(), offline.running_count(), offline.running_distinct()]
    got = by_id(velocity.per_key(tx, steps, limit=limit), "avg_amt_7d", "tx_count_24h", "unique_merchants_7d")
    cards = {}
    for r in sorted(rows, key=lambda r: (r[4], r[0])):
        cards.setdefault(r[1], []).append(r)
    for card in cards.values():
        for i, r in enumerate(card):
            last = [x[3] for x in card[max(0, i - 6): i + 1]]
            assert got[r[0]] == (
                pytest.approx(sum(last) / len(last)), i + 1, len({x[2] for x in card[: i + 1]})
            )


def test_average_of_last_across_blocks(make, monkeypatch):
    monkeypatch.setattr(offline, "RANK_BLOCK", 10)
    rows = [(f"{i:03d}", "c", "m", i + 1, NOON + i) for i in range(60)]
    got = by_id(velocity.per_key(make(rows), [offline.average_of_last()], limit=15), "avg_amt_7d")
    for i in range(60):
        last = [x[3] for x in rows[max(0, i - 6): i + 1]]
        assert got[f"{i:03d}"] == pytest.approx(sum(last) / len(last))


@pytest.mark.parametrize("limit", [None, 20])
def test_time_true_features_against_brute_force(make, limit):
    rows = random_rows(7)
    got = by_id(offline.time_true(make(rows), limit=limit), "avg_amt_7d", "tx_count_24h", "unique_merchants_7d")
    for r in rows:
        week = [x for x in rows if x[1] == r[1] and r[4] - 7 * DAY <= x[4] <= r[4]]
        day = [x for x in week if x[4] >= r[4] - DAY]
        assert got[r[0]] == (
            pytest.approx(sum(x[3] for x in week) / len(week)), len(day), len({x[2] for x in week})
        )


@pytest.mark.parametrize("limit", [None, 2])
def test_home_skips_nulls_per_column(spark, limit):
    rows = [("1", "c", NOON, None, 5.0), ("2", "c", NOON + 1, 1.0, None),
            ("3", "c", NOON + 2, 2.0, 6.0), ("4", "d", NOON, None, None)]
    tx = spark.createDataFrame(rows, "transaction_id string, card_id string, ts_us bigint, lat double, lon double")
    out = velocity.per_key(tx, [offline.home_location(), offline.previous_location()], limit=limit)
    assert by_id(out, "home_lat", "home_lon", "prev_lat", "prev_lon") == {
        "1": (1.0, 5.0, None, None), "2": (1.0, 5.0, None, 5.0),
        "3": (1.0, 5.0, 1.0, None), "4": (None, None, None, None),
    }


@pytest.fixture
def largest(monkeypatch):
    """The largest piece of every scan: what one task works through."""
    sizes = []

    def spied(df, key, *args, **kwargs):
        keys = [key] if isinstance(key, str) else list(key)
        counted = df.groupBy(*keys, hot.PIECE).count().agg(F.max("count")).first()[0]
        sizes.append(counted)
        return hot.running(df, key, *args, **kwargs)

    for module in (velocity, offline, store):
        monkeypatch.setattr(module, "running", spied)
    return sizes


def one_moment(n, others=0):
    rng = random.Random(6)
    rows = [(f"{i:04d}", "c", f"m{rng.randrange(9)}", round(rng.uniform(1, 500), 2), NOON) for i in range(n)]
    return rows + [(f"o{i}", "c", f"m{rng.randrange(9)}", 5, NOON + rng.randrange(2 * DAY)) for i in range(others)]


@pytest.mark.parametrize("others", [0, 60])
def test_one_moment_of_one_card_is_split(make, largest, others):
    rows = one_moment(400, others)
    assert collected(velocity.card_history(make(rows), limit=20)) == brute(rows)
    # rows of other moments bring the ends of their three windows as events of their own
    assert len(largest) > 5 and max(largest) <= (100 if others else 40)


def test_one_moment_counted_whole_is_split(make, largest):
    """Offline features read all rows of a moment, the later ones as well."""
    rows = one_moment(400)
    names = ["avg_amt_7d", "tx_count_24h", "unique_merchants_7d"]
    split = by_id(offline.time_true(make(rows), limit=20), *names)
    assert split == by_id(offline.time_true(make(rows)), *names)
    assert max(largest) <= 40


def test_one_moment_of_the_as_of_join_is_split(spark, largest):
    spine = spark.createDataFrame([("k", NOON, i) for i in range(400)], "k string, t bigint, n int")
    features = spark.createDataFrame(
        [("k", NOON, f"{i:03d}", i) for i in range(400)] + [("k", NOON + 1, "999", -1)],
        "k string, ft bigint, tie string, v int",
    )
    out = store.as_of_join(spine, features, "k", "t", "ft", ["v"], 60, "tie", limit=20)
    assert {(r["n"], r["v"]) for r in out.collect()} == {(i, 399) for i in range(400)}
    assert max(largest) <= 40


@pytest.mark.parametrize("fan", [16])
def test_many_pieces_are_cut_in_levels(make, monkeypatch, fan):
    """No array of cuts grows with the rows of a card; features are those of the plain windows."""
    monkeypatch.setattr(hot, "FAN", fan, raising=False)
    rows = random_rows(11, n=1500, cards=1)
    split = hot.split_hot(make(rows), "card_id", "ts_us", limit=2)
    tables = [split.cuts.table, *getattr(split.cuts, "finer", [])]
    assert split.cuts.pieces == 512
    assert max(t.agg(F.max(F.size(hot.CUTS))).first()[0] for t in tables) < fan
    pieces = hot.with_piece(split.hot, split.cuts, "card_id", "ts_us")
    assert pieces.groupBy("card_id", hot.PIECE).count().agg(F.max("count")).first()[0] <= 20
    # pieces follow the order of the card
    found = sorted((r.card_id, r.ts_us, r.transaction_id, r[hot.PIECE]) for r in pieces.collect())
    assert all(a[3] <= b[3] for a, b in zip(found, found[1:]) if a[0] == b[0])
    assert collected(velocity.card_history(make(rows), limit=2)) == brute(rows)


def test_partitions_grow_with_the_rows(make, monkeypatch):
    """What a task sorts does not grow with the table, and one exchange still serves all windows."""
    monkeypatch.setattr(hot, "TASK_ROWS", 50, raising=False)
    rows = random_rows(12, n=600, cards=40)
    plan = velocity.card_history(make(rows))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(card_id" in plan and ", 12)" in plan and plan.count("Exchange") == 1
    assert collected(velocity.card_history(make(rows))) == brute(rows)


def test_scans_of_hot_cards_carry_few_events(make, monkeypatch):
    """A row whose windows end within its own piece is no event of another one, and the row
    before is looked for once."""
    counts = []

    def spied(df, *args, **kwargs):
        counts.append(df.count())
        return hot.running(df, *args, **kwargs)

    monkeypatch.setattr(velocity, "running", spied)
    rng = random.Random(13)
    rows = [(f"{i:04d}", "c", f"m{rng.randrange(9)}", 5, NOON + i * DAY // 4) for i in range(400)]
    assert collected(velocity.card_history(make(rows), limit=100)) == brute(rows)
    assert max(counts) <= 500 and len(counts) <= 6


def test_missing_merchant_of_a_hot_card_is_one_merchant(make):
    rows = [(r[0], r[1], None if r[2] == "m3" else r[2], *r[3:]) for r in random_rows(14)]
    assert collected(velocity.card_history(make(rows), limit=20)) == brute(rows)
