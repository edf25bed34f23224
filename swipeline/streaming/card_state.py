"""Lookback features on a stream: keyed state per card.

What a card keeps, all on event time:

* numbers: last time, moving average, and for every window the count and sum of
  the rows in `[frontier - w, frontier]`, where the frontier is the newest time;
* the rows of the last 24 hours in ten-minute slots;
* per merchant the last visit of the current activity period.

For an ordinary card all of it is one state value, read and written once per
batch. Beyond INLINE_ROWS rows and visits the slots and visits become entries of their own,
and a batch loads only the slots that leave one of the windows while it is worked
through: memory follows the length of the batch (bounded by the source's
rows-per-trigger option), not the size of the card's history. Rows older than the
frontier are answered from the slots of their own time.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from swipeline import config
from swipeline.operators.velocity import cents

# The runner that prepares a stateful processor does not see shipped packages: the
# processor travels whole and uses nothing of this package but the names below.
register_pickle_by_value(sys.modules[__name__])

US = config.US
ALPHA, DEFAULT_AVG = config.EMA_ALPHA, config.DEFAULT_AVG_AMOUNT
SLOT_US = 600 * US
WINDOWS_US = {w: s * US for w, s in config.VELOCITY_WINDOWS.items()}
DAY_US = config.DAY_S * US
IDLE_US = config.IDLE_GAP_S * US
FORGET_US = config.STATS_GAP_S * US

INLINE_ROWS = 2000

COUNTS = [f"tx_count_{w}" for w in WINDOWS_US]
SUMS = [f"cents_{w}" for w in WINDOWS_US]
#: Whole numbers of a row, in one array: Spark converts a frame of each card column by column,
#: so that few columns cost little.
LONGS = [
    "cents", "ts_us", *COUNTS, *SUMS, "unique_merchants_24h", "unique_merchants_since_idle",
    "is_new_merchant", "prev_us", "late",
]
TEXTS = ["transaction_id", "card_id", "merchant_id", "merchant_category"]
OUTPUT = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in TEXTS],
        T.StructField("longs", T.ArrayType(T.LongType())),
        T.StructField("reals", T.ArrayType(T.DoubleType())),
    ]
)
INPUT = ["ts_us", "transaction_id", "merchant_id", "merchant_category", "cents", "lat"]

NUMBERS = [
    "frontier", "last_us", "ema", "counts", "sums", "merchants", "visited",
    "idle_timer", "forget_timer", "spilled",
]
STATS_SCHEMA = (
    "frontier bigint, last_us bigint, ema double, counts array<bigint>, sums array<bigint>,"
    " merchants bigint, visited bigint, idle_timer bigint, forget_timer bigint,"
    " spilled boolean, slots array<bigint>,"
    " us array<bigint>, ids array<string>, cents array<bigint>, places array<string>,"
    " visit_merchant array<string>, visit_us array<bigint>, visit_id array<string>"
)
SLOT_SCHEMA = "us array<bigint>, ids array<string>, cents array<bigint>, places array<string>"


class CardState(StatefulProcessor):
    """State and features of one card, row by row in (time, id) order per batch."""

    def __init__(self, inline_rows: int = INLINE_ROWS, keep_late: bool = False):
        self.inline_rows, self.keep_late = inline_rows, keep_late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stats = handle.getValueState("stats", STATS_SCHEMA)
        self.slots = handle.getMapState("slots", "slot bigint", SLOT_SCHEMA)
        self.visits = handle.getMapState("visits", "merchant string", "us bigint, id string")

    def close(self) -> None:
        pass

    # -- state access, each entry read and written once per batch --

    def _load(self) -> bool:
        row = self.stats.get()
        self.loaded: dict[int, list] = {}
        self.seen: dict[str, tuple | None] = {}
        self.changed: set[int] = set()
        self.known: set[int] = set()
        if row is None:
            self.frontier = self.last_us = self.ema = None
            self.idle_timer = self.forget_timer = None
            self.spilled = False
            self._zero()
            return False
        for name, value in zip(NUMBERS, row):
            setattr(self, name, value)
        self.counts, self.sums = list(self.counts), list(self.sums)
        slots, us, ids, cents, places, merchants, visit_us, visit_id = row[len(NUMBERS):]
        self.known = set(slots)
        for kept in zip(us, ids, cents, places):
            self.loaded.setdefault(kept[0] // SLOT_US, []).append(kept)
        self.seen = dict(zip(merchants, zip(visit_us, visit_id)))
        return True

    def _zero(self) -> None:
        self.counts = [0] * len(WINDOWS_US)
        self.sums = [0] * len(WINDOWS_US)
        self.merchants = self.visited = 0

    def _slot(self, number: int) -> list:
        """Rows (us, id, cents, merchant) of a slot, in order."""
        if number not in self.loaded:
            stored = self.spilled and number in self.known
            self.loaded[number] = (
                list(zip(*self.slots.getValue((number,)))) if stored else []
            )
        return self.loaded[number]

    def _visit(self, merchant: str) -> tuple | None:
        if merchant not in self.seen:
            key = (merchant,)
            stored = self.spilled and self.visits.containsKey(key)
            self.seen[merchant] = tuple(self.visits.getValue(key)) if stored else None
        return self.seen[merchant]

    def _forget_history(self) -> None:
        if self.spilled:
            self.slots.clear()
            self.visits.clear()
            self.spilled = False
        self.known, self.loaded, self.changed, self.seen = set(), {}, set(), {}
        self._zero()

    def _between(self, low: int, high: int) -> list:
        """Kept rows with low <= time < high, in order."""
        rows = []
        for number in sorted(s for s in self.known if low // SLOT_US <= s <= high // SLOT_US):
            rows += [r for r in self._slot(number) if low <= r[0] < high]
        return rows

    # -- features --

    def _keep(self, row: tuple) -> None:
        us, tx_id, cents, merchant = row
        number = us // SLOT_US
        rows = self._slot(number)
        rows.append(row)
        if len(rows) > 1 and rows[-2][:2] > row[:2]:
            rows.sort(key=lambda r: r[:2])
        self.known.add(number)
        self.changed.add(number)
        for i, w in enumerate(WINDOWS_US.values()):
            if us >= self.frontier - w:
                self.counts[i] += 1
                self.sums[i] += cents
        before = self._visit(merchant)
        if before is None:
            self.visited += 1
        if before is None or before[0] < self.frontier - DAY_US:
            if us >= self.frontier - DAY_US:
                self.merchants += 1
        if before is None or before < (us, tx_id):
            self.seen[merchant] = (us, tx_id)

    def _advance(self, us: int, pending: list[_Queue]) -> None:
        """Move the frontier to `us`: rows older than each window leave it."""
        for i, w in enumerate(WINDOWS_US.values()):
            queue = pending[i]
            while queue.at < len(queue.rows) and queue.rows[queue.at][0] < us - w:
                row = queue.rows[queue.at]
                queue.at += 1
                self.counts[i] -= 1
                self.sums[i] -= row[2]
                if w == DAY_US and self._visit(row[3]) == (row[0], row[1]):
                    self.merchants -= 1
        self.frontier = us

    def _late(self, us: int) -> tuple[list[int], list[int], set[str]]:
        """Counts, sums and merchants as of a time before the frontier."""
        rows = self._between(us - DAY_US, us + 1)
        counts = [sum(1 for r in rows if r[0] >= us - w) for w in WINDOWS_US.values()]
        sums = [sum(r[2] for r in rows if r[0] >= us - w) for w in WINDOWS_US.values()]
        return counts, sums, {r[3] for r in rows}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = sorted(
            (row for frame in rows for row in zip(*[_values(frame[c]) for c in INPUT])),
            key=lambda row: row[:2],
        )
        if self.keep_late:
            # behind the watermark: the row is handed on as it came, and the state stays
            watermark = timerValues.getCurrentWatermarkInMs() * 1000
            behind = bisect_right(batch, watermark, key=lambda row: row[0]) if watermark > 0 else 0
            if behind:
                no_features = [0] * (len(COUNTS) + len(SUMS) + 3)
                yield _frame([
                    (tx_id, key[0], merchant, category, [cents, us, *no_features, None, 1], [lat, 0.0])
                    for us, tx_id, merchant, category, cents, lat in batch[:behind]
                ])
            batch = batch[behind:]
            if not batch:
                return
        self._load()
        newest = batch[-1][0]
        out = []
        queues = None
        for us, tx_id, merchant, category, cents, lat in batch:
            gap = None if self.frontier is None else us - self.frontier
            if gap is not None and gap > FORGET_US:
                self.ema = self.last_us = None
            if gap is not None and gap > IDLE_US:
                self._forget_history()
                queues = None
            if gap is None or gap >= 0:
                if queues is None:
                    start = us if self.frontier is None else self.frontier
                    queues = [
                        _Queue(self._between(start - w, newest - w))
                        for w in WINDOWS_US.values()
                    ]
                    self.frontier = start
                self._advance(us, queues)
                counts, sums, merchants = list(self.counts), list(self.sums), self.merchants
                visit = self._visit(merchant)
                new = visit is None or visit[0] < us - DAY_US
            else:
                counts, sums, near = self._late(us)
                merchants, new = len(near), merchant not in near
            ema = DEFAULT_AVG if self.ema is None else self.ema
            out.append(
                (tx_id, key[0], merchant, category,
                 [cents, us, *counts, *sums, merchants, self.visited, int(new), self.last_us, 0],
                 [lat, ema])
            )
            row = (us, tx_id, cents, merchant)
            self._keep(row)
            if queues is not None:
                for queue in queues:
                    queue.add(row)
            self.last_us = us
            self.ema = ALPHA * cents / 100 + (1 - ALPHA) * ema
        self._store()
        yield _frame(out)

    def _store(self) -> None:
        oldest = (self.frontier - DAY_US) // SLOT_US
        for number in [n for n in self.known if n < oldest]:
            self.known.discard(number)
            self.changed.discard(number)
            self.loaded.pop(number, None)
            if self.spilled and self.slots.containsKey((number,)):
                self.slots.removeKey((number,))
        # a card of few rows a day may still have visited many merchants
        held = sum(map(len, self.loaded.values())) + len(self.seen)
        if not self.spilled and held > self.inline_rows:
            self.spilled = True
            self.changed = set(self.known)
        if self.spilled:
            for number in self.changed:
                self.slots.updateValue((number,), _columns(self.loaded[number], 4))
            for merchant, visit in self.seen.items():
                if visit is not None:
                    self.visits.updateValue((merchant,), visit)
        # a timer that is already set stays: it looks at the frontier when it fires
        if self.idle_timer is None:
            self.idle_timer = self._timer(IDLE_US)
        if self.forget_timer is None:
            self.forget_timer = self._timer(FORGET_US)
        self._save()

    def _save(self) -> None:
        rows, visits = [], []
        if not self.spilled:
            rows = [r for n in sorted(self.loaded) for r in self.loaded[n]]
            visits = [(m, *v) for m, v in self.seen.items() if v is not None]
        self.stats.update(
            (
                *[getattr(self, name) for name in NUMBERS],
                sorted(self.known),
                *_columns(rows, 4),
                *_columns(visits, 3),
            )
        )

    def _timer(self, gap_us: int) -> int:
        at = (self.frontier + gap_us) // 1000 + 1
        self.handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """After a day of silence the history goes, after 30 days everything."""
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if self._load():
            silent = lambda gap: (self.frontier + gap) // 1000 < fired
            if fired == self.forget_timer and silent(FORGET_US):
                self.slots.clear()
                self.visits.clear()
                self.stats.clear()
                return iter([])
            if fired == self.forget_timer:
                self.forget_timer = self._timer(FORGET_US)
            if fired == self.idle_timer:
                if silent(IDLE_US):
                    self._forget_history()
                    self.idle_timer = None
                else:
                    self.idle_timer = self._timer(IDLE_US)
            self._save()
        return iter([])


def _values(column: pd.Series) -> list:
    """A column as a list; a missing number is None."""
    values = column.tolist()
    return [None if v != v else v for v in values] if column.dtype.kind == "f" else values


def _columns(rows: list[tuple], width: int) -> tuple[list, ...]:
    return tuple([r[i] for r in rows] for i in range(width))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Rows as a frame of objects. Arrays have no index that pandas would align, which takes
    most of the time where each card has few rows."""
    columns = {name: np.empty(len(rows), dtype=object) for name in OUTPUT.names}
    for name, values in zip(OUTPUT.names, zip(*rows)):
        for i, value in enumerate(values):
            columns[name][i] = value
    return pd.DataFrame(columns, copy=False)


class _Queue:
    """Rows waiting to leave a window, in order."""

    def __init__(self, rows: list):
        self.rows, self.at = rows, 0

    def add(self, row: tuple) -> None:
        rows = self.rows
        rows.append(row)
        i = len(rows) - 1
        while i > self.at and rows[i - 1][:2] > row[:2]:
            rows[i] = rows[i - 1]
            i -= 1
        rows[i] = row


def card_features(
    stream: DataFrame, late: str = "1 hour", inline_rows: int = INLINE_ROWS, keep_late: bool = False
) -> DataFrame:
    """`velocity.card_history` on a stream of clean transactions.

    `stream` has the columns of `clean.to_features_input`. Rows later than the
    watermark are dropped by the operator and counted in its progress. With
    `keep_late` they come out too: a column `late` tells them, and they have no
    features, since the state no longer knows their time.
    """
    timed = stream.select(
        "card_id",
        "transaction_id",
        "merchant_id",
        "merchant_category",
        cents().alias("cents"),
        "ts_us",
        F.col("lat").cast("double").alias("lat"),
        F.timestamp_micros("ts_us").alias("ts"),
    ).withWatermark("ts", late)
    if keep_late:
        timed = timed.drop("ts")  # the operator drops late rows by this column alone
    raw = timed.groupBy("card_id").transformWithStateInPandas(
        statefulProcessor=CardState(inline_rows, keep_late),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    raw = raw.select(
        *TEXTS,
        *[F.get("longs", F.lit(i)).alias(c) for i, c in enumerate(LONGS)],
        F.get("reals", F.lit(0)).alias("lat"),
        F.get("reals", F.lit(1)).alias("ema_before"),
    ).withColumn("late", F.col("late") == 1)
    seconds = F.floor(F.col("ts_us") / US)
    previous = F.floor(F.col("prev_us") / US)
    given = ["transaction_id", "card_id", "merchant_id", "merchant_category", "amount", "ts_us", "lat"]
    features = {c: F.col(c) for c in COUNTS}
    features |= {f"total_amount_{w}": F.col(c) / 100 for c, w in zip(SUMS, WINDOWS_US)}
    features |= {
        c: F.col(c) for c in ("unique_merchants_24h", "unique_merchants_since_idle", "is_new_merchant")
    }
    features |= {
        "prev_ts": previous,
        "time_since_last_tx": F.coalesce(seconds - previous, F.lit(0)),
        "ema_before": F.col("ema_before"),
    }
    out = raw.withColumn("amount", (F.col("cents") / 100).cast("decimal(18,2)"))
    if keep_late:
        features = {c: F.when(~F.col("late"), v) for c, v in features.items()} | {"late": F.col("late")}
    return out.select(*given, *[v.alias(c) for c, v in features.items()])
