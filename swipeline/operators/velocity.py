"""Lookback features per card: what was known just before each transaction.

Order within a card is (ts_us, transaction_id). A lookback of `w` seconds sees
the earlier rows from `ts - w` on, both ends included. All windows are prefix
sums: "rows so far" minus "rows older than w", so the cost is linear even for a
card with very many rows in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from swipeline import config
from swipeline.functions.scalars import deviation, half_up, ratio
from swipeline.operators.hot import PIECE, UNTIL, UP, Cuts, Step, per_key, running, with_piece
from swipeline.session import cut_lineage

CARD = "card_id"
ORDER = ["ts_us", "transaction_id"]
DAY_US = config.DAY_S * config.US
EMA_BLOCK = 1000  # 0.9 ** 1000 is far below double precision
KEEP = 1.0 - config.EMA_ALPHA
#: Kept from step to step on hot cards: the row before, and the visits to the same merchant
#: before and after.
PREVIOUS, VISITED, VISITS = "_prev", "_visited_us", "_visits_us"


def _ordered(*by: str):
    return Window.partitionBy(*by).orderBy(*ORDER)


def _timed(*by: str):
    return Window.partitionBy(*by).orderBy("ts_us")


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


# --- V1, V2: counts and amounts ------------------------------------------------


def lookback_sums(
    windows: dict[str, int], values: dict[str, Column], include_current: bool = False
) -> Step:
    """`{value}_{window}` sums for every window.

    `include_current` also counts the row itself and all rows of the same time.
    """
    names = [f"{v}_{w}" for w in windows for v in values]

    def totals(df: DataFrame) -> DataFrame:
        ins = df.withColumns({f"_v_{v}": c for v, c in values.items()})
        seen = (
            _timed(CARD).rangeBetween(UP, 0)
            if include_current
            else _ordered(CARD).rowsBetween(UP, -1)
        )
        ins = ins.withColumns({f"_seen_{v}": F.sum(f"_v_{v}").over(seen) for v in values})
        old = {
            f"_old_{v}_{w}": F.sum(f"_v_{v}").over(
                _timed(CARD).rangeBetween(UP, -(s * config.US + 1))
            )
            for w, s in windows.items()
            for v in values
        }
        return ins.withColumns(old).withColumns(
            {
                f"{v}_{w}": _zero(F.col(f"_seen_{v}")) - _zero(F.col(f"_old_{v}_{w}"))
                for w in windows
                for v in values
            }
        )

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        ins = df.withColumns({f"_v_{v}": c for v, c in values.items()})
        values_of = {(v, w): (f"_v_{v}", f"_v_{v}") for w in windows for v in values}
        found = hot_lookback(ins, cuts, windows, values_of, include_current)
        return found.select(*df.columns, *names)

    return Step(names, hot, totals=totals)


def hot_lookback(
    df: DataFrame, cuts: Cuts, windows: dict[str, int],
    values: dict[tuple[str, str], tuple[str, str]], include_current: bool,
) -> DataFrame:
    """`{value}_{window}` of hot cards, from {(value, window): (column that a row brings,
    column that goes just after its time + window)}.

    A row reads what came so far, less what went. What goes within the piece of its row is taken
    away by a window over the piece, and for later pieces by one event at the piece's end. Only
    what goes in a later piece is an event there; all of one moment are one event, and
    so is what came at one moment if all of the moment counts.
    """
    names = [f"{v}_{w}" for v, w in values]
    ends = {w: F.col("ts_us") + (s * config.US + 1) for w, s in windows.items()}
    stays = {w: F.coalesce(us <= F.col(UNTIL), F.lit(True)) for w, us in ends.items()}
    # at the end of a piece, behind its rows: no row of the piece reads it
    closing = df.groupBy(CARD, PIECE).agg(
        *[
            F.sum(F.when(stays[w], -F.col(goes))).alias(f"_d_{v}_{w}")
            for (v, w), (_, goes) in values.items()
        ]
    ).withColumns({"_us": F.lit(2**63 - 1), "_rank": F.lit(9)})
    leaving = [F.when(~stays[w], F.struct(F.lit(w).alias("w"), us.alias("us"))) for w, us in ends.items()]
    moves = F.filter(F.array(*leaving), lambda e: e.isNotNull())
    changes = (
        df.select(CARD, *{goes for _, goes in values.values()}, F.explode(moves).alias("_e"))
        .groupBy(CARD, F.col("_e.us").alias("_us"))
        .agg(
            *[
                F.sum(F.when(F.col("_e.w") == w, -F.col(goes))).alias(f"_d_{v}_{w}")
                for (v, w), (_, goes) in values.items()
            ]
        )
        .withColumn("_rank", F.lit(0))
    )
    read = 2 if include_current else 1
    if include_current:
        came = df.groupBy(CARD, F.col("ts_us").alias("_us")).agg(
            *[F.sum(comes).alias(f"_d_{v}_{w}") for (v, w), (comes, _) in values.items()]
        )
        changes = changes.unionByName(came.withColumn("_rank", F.lit(1)))
    changes = with_piece(changes.withColumn("transaction_id", F.lit("")), cuts, CARD, "_us")
    rows = df.withColumns(
        {
            f"_d_{v}_{w}": F.lit(0) if include_current else F.col(comes)
            for (v, w), (comes, _) in values.items()
        }
        | {"_us": F.col("ts_us"), "_rank": F.lit(read)}
    )
    events = rows.unionByName(changes, allowMissingColumns=True).unionByName(
        closing, allowMissingColumns=True
    )
    scanned = running(
        events, CARD, ["_us", "_rank", "transaction_id"],
        sums={n: _zero(F.col(f"_d_{n}")) for n in names},
    ).where(F.col("_rank") == read)
    # the rows of the piece that went before: the events of other pieces bring nothing here
    past = Window.partitionBy(CARD, PIECE).orderBy("_us")
    gone = {
        f"_g_{v}_{w}": _zero(F.sum(goes).over(past.rangeBetween(UP, -(windows[w] * config.US + 1))))
        for (v, w), (_, goes) in values.items()
    }
    own = {n: F.lit(0) if include_current else _zero(F.col(f"_d_{n}")) for n in names}
    return scanned.withColumns(gone).withColumns(
        {n: F.col(n) - own[n] - F.col(f"_g_{n}") for n in names}
    )


# --- V3: distinct merchants in a rolling window --------------------------------


def lookback_merchants(name: str, seconds: int, include_current: bool = False) -> Step:
    """Distinct merchants of the lookback.

    A merchant enters with a purchase that follows a silence of more than the
    window, and leaves one window after a purchase that precedes such a silence.
    The count is entries so far minus departures so far: no set is built.
    """
    w_us = seconds * config.US

    def value(df: DataFrame) -> DataFrame:
        visits = _ordered(CARD, "merchant_id")
        gap_before = F.col("ts_us") - F.lag("ts_us").over(visits)
        gap_after = F.lead("ts_us").over(visits) - F.col("ts_us")
        return df.withColumns({"_before": gap_before, "_after": gap_after}).withColumns(
            {
                "_enters": (F.col("_before").isNull() | (F.col("_before") > w_us)).cast("int"),
                "_leaves": (F.col("_after").isNull() | (F.col("_after") > w_us)).cast("int"),
            }
        )

    def totals(df: DataFrame) -> DataFrame:
        seen = (
            _timed(CARD).rangeBetween(UP, 0)
            if include_current
            else _ordered(CARD).rowsBetween(UP, -1)
        )
        gone = _timed(CARD).rangeBetween(UP, -(w_us + 1))
        return df.withColumn(
            name, _zero(F.sum("_enters").over(seen)) - _zero(F.sum("_leaves").over(gone))
        )

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        ins = hot_visits(df)
        first = F.col(VISITED).isNull() | (F.col("ts_us") - F.col(VISITED) > w_us)
        last = F.col(VISITS).isNull() | (F.col(VISITS) - F.col("ts_us") > w_us)
        kept = ins.columns
        ins = ins.withColumns({"_enters": first.cast("int"), "_leaves": last.cast("int")})
        flags = {("_n", "w"): ("_enters", "_leaves")}
        found = hot_lookback(ins, cuts, {"w": seconds}, flags, include_current)
        return found.select(*kept, F.col("_n_w").alias(name))

    return Step([name], hot, value=value, totals=totals)


def hot_visits(df: DataFrame) -> DataFrame:
    """The times of the card's visit to the same merchant before and after each row (hot cards):
    inside a piece from its rows, beyond it from the first and last visit of other pieces."""
    if VISITED in df.columns:
        return df
    place = [CARD, "merchant_id", PIECE]
    ends = df.groupBy(*place).agg(F.min("ts_us").alias("_a"), F.max("ts_us").alias("_z"))
    over = Window.partitionBy(CARD, "merchant_id").orderBy(PIECE)
    ends = ends.select(
        *[F.col(c).alias(f"_k_{c}") for c in place],
        F.lag("_z").over(over).alias("_za"), F.lead("_a").over(over).alias("_az"),
    ).where(F.col("_za").isNotNull() | F.col("_az").isNotNull())
    inside = _ordered(*place)
    rows = df.withColumns(
        {VISITED: F.lag("ts_us").over(inside), VISITS: F.lead("ts_us").over(inside)}
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in place]
    joined = rows.join(ends, same, "left").withColumns(
        {
            VISITED: F.coalesce(F.col(VISITED), F.col("_za")),
            VISITS: F.coalesce(F.col(VISITS), F.col("_az")),
        }
    )
    return cut_lineage(joined.select(*rows.columns))


# --- V4: distinct merchants since the last idle day ------------------------------


def merchants_since_idle(name: str = "unique_merchants_since_idle") -> Step:
    gap_us = config.IDLE_GAP_S * config.US

    def card(df: DataFrame) -> DataFrame:
        gap = F.col("ts_us") - F.lag("ts_us").over(_ordered(CARD))
        return df.withColumn("_idle_gap", gap).withColumn(
            "_period",
            _zero(
                F.sum((F.col("_idle_gap") > gap_us).cast("int")).over(
                    _ordered(CARD).rowsBetween(UP, 0)
                )
            ),
        )

    def value(df: DataFrame) -> DataFrame:
        # periods only grow along a merchant's visits
        visited = F.lag("_period").over(_ordered(CARD, "merchant_id"))
        return df.withColumn("_visited", visited).withColumn(
            "_first", (~F.col("_visited").eqNullSafe(F.col("_period"))).cast("int")
        )

    def totals(df: DataFrame) -> DataFrame:
        # first visits so far, less those before the period began
        upto = _ordered(CARD).rowsBetween(UP, 0)
        ins = df.withColumn(
            "_firsts", _zero(F.sum("_first").over(_ordered(CARD).rowsBetween(UP, -1)))
        )
        return ins.withColumn(
            "_base", F.max(F.when(F.col("_idle_gap") > gap_us, F.col("_firsts"))).over(upto)
        ).withColumn(name, F.col("_firsts") - _zero(F.col("_base")))

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        ins = hot_previous(hot_visits(df))
        kept = ins.columns
        ins = hot_epochs(ins, gap_us)
        # no visit since the period began; a row reads before its own visit counts
        new = F.col(VISITED).isNull() | (F.col(VISITED) < F.col("_epoch"))
        ins = cut_lineage(ins.withColumn("_first", new.cast("int")))
        scanned = running(ins, [CARD, "_epoch"], ORDER, sums={name: F.col("_first")})
        return scanned.withColumn(name, F.col(name) - F.col("_first")).select(*kept, name)

    return Step([name], hot, card=card, value=value, totals=totals)


def hot_previous(df: DataFrame) -> DataFrame:
    """`_prev`: the time of the row before (hot cards); once for all steps."""
    if PREVIOUS in df.columns:
        return df
    return cut_lineage(running(df, CARD, ORDER, tops={PREVIOUS: F.col("ts_us")}))


def hot_epochs(df: DataFrame, gap_us: int) -> DataFrame:
    """`_epoch`: the time of the row behind the last silence longer than the gap, the least number
    before the first one (hot cards). `df` has been through `hot_previous`."""
    begins = F.when(F.col("ts_us") - F.col(PREVIOUS) > gap_us, F.col("ts_us"))
    found = running(df, CARD, ORDER, tops={"_epoch": begins})
    return found.withColumn("_epoch", F.coalesce(begins, F.col("_epoch"), F.lit(-(2**63))))


# --- V5: gap since the previous transaction -------------------------------------


def previous_time() -> Step:
    """`prev_ts`: epoch seconds of the previous transaction, null for the first one
    and after 30 days of silence. `time_since_last_tx` in seconds, 0 for null."""
    gap_us = config.STATS_GAP_S * config.US

    names = ["prev_ts", "time_since_last_tx"]

    def finish(df: DataFrame) -> DataFrame:
        seconds = F.floor(F.col("ts_us") / config.US)
        known = F.when(F.col("ts_us") - F.col("_prev") <= gap_us, F.col("_prev"))
        prev = F.floor(known / config.US)
        return df.withColumns({"prev_ts": prev, "time_since_last_tx": _zero(seconds - prev)})

    def card(df: DataFrame) -> DataFrame:
        return finish(df.withColumn("_prev", F.lag("ts_us").over(_ordered(CARD))))

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        ins = hot_previous(df)
        return finish(ins).select(*ins.columns, *names)

    return Step(names, hot, card=card, scans=False)


# --- V6: exponential moving average -----------------------------------------------


def moving_average(name: str = "ema_before") -> Step:
    """Average before the row: 75 at first, then 0.1 * amount + 0.9 * average.

    Forgotten after 30 days of silence. Blocks of 1,000 rows are summed with
    growing weights (all terms have one sign, so nothing cancels); a block needs
    nothing older than the block before it, as 0.9 ** 1000 is below 1e-45.
    """
    gap_us = config.STATS_GAP_S * config.US

    def from_zero(df: DataFrame, by: list[str]) -> DataFrame:
        """`_ema0`, the average with seed 0, of rows numbered by `_n` within `by`."""
        ins = df.withColumns(
            {
                "_block": F.floor(F.col("_n") / EMA_BLOCK),
                "_j": F.col("_n") % EMA_BLOCK,
            }
        )
        weighted = (
            F.lit(config.EMA_ALPHA)
            * F.col("amount").cast("double")
            * F.pow(F.lit(KEEP), -(F.col("_j") + 1))
        )
        ins = ins.withColumn("_x", weighted).withColumn(
            "_sum", F.coalesce(F.sum("_x").over(_ordered(*by, "_block").rowsBetween(UP, -1)), F.lit(0.0))
        )
        full = F.when(
            F.col("_j") == EMA_BLOCK - 1,
            F.pow(F.lit(KEEP), F.lit(EMA_BLOCK)) * (F.col("_sum") + F.col("_x")),
        )
        # ordered by block first: the sort of the sums serves again
        before = Window.partitionBy(*by).orderBy("_block", *ORDER).rowsBetween(UP, -1)
        ins = ins.withColumn("_full", full).withColumn(
            "_seed", F.coalesce(F.last("_full", ignorenulls=True).over(before), F.lit(0.0))
        )
        return ins.withColumn(
            "_ema0", F.pow(F.lit(KEEP), F.col("_j")) * (F.col("_seed") + F.col("_sum"))
        )

    def card(df: DataFrame) -> DataFrame:
        upto = _ordered(CARD).rowsBetween(UP, 0)
        ins = df.withColumns(
            {
                "_ema_gap": F.col("ts_us") - F.lag("ts_us").over(_ordered(CARD)),
                "_row": F.row_number().over(_ordered(CARD)) - 1,
            }
        )
        start = F.when(F.col("_ema_gap") > gap_us, F.col("_row"))
        return ins.withColumn("_start", _zero(F.max(start).over(upto))).withColumn(
            "_n", F.col("_row") - F.col("_start")
        )

    def own(df: DataFrame) -> DataFrame:
        return from_zero(df, [CARD, "_start"]).withColumn(
            name,
            F.pow(F.lit(KEEP), F.col("_n")) * F.lit(config.DEFAULT_AVG_AMOUNT) + F.col("_ema0"),
        )

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        by = [CARD, "_epoch", PIECE]
        ins = hot_previous(df)
        kept = ins.columns
        numbered = cut_lineage(hot_epochs(ins, gap_us)).withColumn(
            "_n", F.row_number().over(_ordered(*by)) - 1
        )
        ins = from_zero(numbered, by)
        last = F.lit(KEEP) * F.col("_ema0") + F.lit(config.EMA_ALPHA) * F.col("amount").cast("double")
        pieces = ins.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"), F.max_by(last, "_n").alias("b")
        )
        # the average behind a piece needs the pieces that end in the EMA_BLOCK rows before its
        # end: together they hold more rows than that, or reach back to the first
        in_order = Window.partitionBy(CARD, "_epoch").orderBy(PIECE)
        near = Window.partitionBy(CARD, "_epoch").orderBy("_upto").rangeBetween(-EMA_BLOCK, 0)
        behind = F.aggregate(
            F.collect_list(F.struct(F.pow(F.lit(KEEP), F.col("n")).alias("f"), "b")).over(near),
            F.lit(config.DEFAULT_AVG_AMOUNT),
            lambda acc, p: p["f"] * acc + p["b"],
        )
        ends = pieces.withColumn("_upto", F.sum("n").over(in_order.rowsBetween(UP, 0)))
        inherited = F.coalesce(F.lag("_behind").over(in_order), F.lit(config.DEFAULT_AVG_AMOUNT))
        carry = ends.withColumn("_behind", behind).select(*by, inherited.alias("_in"))
        out = ins.join(carry, by).withColumn(
            name, F.pow(F.lit(KEEP), F.col("_n")) * F.col("_in") + F.col("_ema0")
        )
        return out.select(*kept, name)

    return Step([name], hot, card=card, own=own)


def rolling_columns(amount: str = "amount", average: str = "ema_before") -> dict[str, Column]:
    """Average (75 where missing or 0), deviation and ratio, rounded as published."""
    avg = F.coalesce(F.nullif(F.col(average), F.lit(0.0)), F.lit(config.DEFAULT_AVG_AMOUNT))
    return {
        "avg_tx_amount_30d": half_up(avg, 2),
        "amount_deviation": deviation(F.col(amount), avg),
        "amount_vs_avg_ratio": half_up(ratio(F.col(amount), avg), 3),
    }


# --- public operators ----------------------------------------------------------------

def _counts() -> dict[str, Column]:
    return {"tx_count": F.lit(1).cast("bigint")}


def cents(amount: str = "amount") -> Column:
    """Money as whole cents: exact, also from doubles, and summed as machine integers."""
    return (F.col(amount).cast("decimal(18,2)") * 100).cast("bigint")


def _amounts() -> dict[str, Column]:
    return {"total_amount": cents()}


def _in_units(df: DataFrame) -> DataFrame:
    names = [f"total_amount_{w}" for w in config.VELOCITY_WINDOWS]
    return df.withColumns({n: F.col(n) / 100 for n in names})


def velocity_counts(df: DataFrame, limit: int | None = None) -> DataFrame:
    return per_key(df, [lookback_sums(config.VELOCITY_WINDOWS, _counts())], limit=limit)


def velocity_amounts(df: DataFrame, limit: int | None = None) -> DataFrame:
    step = lookback_sums(config.VELOCITY_WINDOWS, _amounts())
    return _in_units(per_key(df, [step], limit=limit))


def unique_merchants_24h(df: DataFrame, limit: int | None = None) -> DataFrame:
    return per_key(df, [lookback_merchants("unique_merchants_24h", config.DAY_S)], limit=limit)


def unique_merchants_idle(df: DataFrame, limit: int | None = None) -> DataFrame:
    return per_key(df, [merchants_since_idle()], limit=limit)


def time_since_last(df: DataFrame, limit: int | None = None) -> DataFrame:
    return per_key(df, [previous_time()], limit=limit)


def ema_amount(df: DataFrame, limit: int | None = None) -> DataFrame:
    out = per_key(df, [moving_average()], limit=limit)
    return out.withColumns(rolling_columns())


def card_history(df: DataFrame, limit: int | None = None) -> DataFrame:
    """V1-V6 together: ordinary cards are shuffled once."""
    steps = [
        lookback_sums(config.VELOCITY_WINDOWS, _counts() | _amounts()),
        lookback_merchants("unique_merchants_24h", config.DAY_S),
        merchants_since_idle(),
        previous_time(),
        moving_average(),
    ]
    return _in_units(per_key(df, steps, limit=limit))
