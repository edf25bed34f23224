"""Ordered per-key work when one key may hold a large part of all rows.

A window partitioned by card runs one card in one task. Cards with more rows
than a limit are therefore taken out and handled as a prefix scan:

1. splitters of the order (event time, id), taken from a sample, cut the card into
   pieces of similar size - also within one moment, however many rows it has;
2. every piece is scanned on its own, in its own task;
3. each piece leaves one summary row (sums, last values), and a window over
   these few rows gives what every piece inherits from the earlier ones;
4. the inheritance is joined back to the rows of the piece.

All other cards take the ordinary windows. Results are the same either way.
Copies of one row (one key, time and id) stay in one piece. A scan whose events
belong to no row, such as the end of a window, adds them up by moment first: they
stand at the beginning of their moment and need no splitting. A scan reads its
input more than once, so the rows of hot cards are checkpointed between scans.

A key of many pieces is cut in levels: its pieces of the first level, FAN at most, are cut
again into FAN pieces each, and so on. No array of cuts, sample or group is larger than
that, however many pieces a key has. The rows of hot keys know their own piece from the
start (`PIECE`); only events at other times look theirs up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from swipeline import config
from swipeline.session import cut_lineage

UP = Window.unboundedPreceding
PIECE = "_piece"
#: Time of the cut that ends a row's piece, null for the last piece.
UNTIL = "_until"
CUTS = "_cuts"
TIE = "transaction_id"
#: Rows drawn per piece to find the splitters.
SAMPLE = 200
#: Pieces that one array of cut points tells apart, a power of two.
FAN = 256
#: Rows of ordinary keys that a task sorts on average, at most.
TASK_ROWS = 100_000


class Cuts(NamedTuple):
    table: DataFrame  # hot key and the cut points (time, id) of its order
    pieces: int  # of the largest key, a power of two
    finer: tuple[DataFrame, ...] = ()  # cut points inside the pieces of the level before


class Split(NamedTuple):
    cold: DataFrame            # rows of ordinary keys
    hot: DataFrame | None      # rows of hot keys, None if there are none
    cuts: Cuts | None
    rows: int                  # of all keys together


Phase = Callable[[DataFrame], DataFrame]


class Step(NamedTuple):
    """The same columns twice: by plain windows, and by a scan over pieces.

    The plain windows come in phases. All steps run one phase before any runs the
    next, so windows of one sort order sit next to each other and share the sort:
    first over the card, then over card and value, then over the card again, then
    whatever needs an order of its own.
    """

    columns: Sequence[str]
    hot: Callable[[DataFrame, Cuts], DataFrame]
    card: Phase | None = None
    value: Phase | None = None
    totals: Phase | None = None
    own: Phase | None = None
    scans: bool = True  # the hot path ends in a scan, which the next step must not repeat


def hot_limit(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get(config.HOT_ROWS_CONF, str(config.HOT_ROWS)))


def position(at: str, tie: str) -> Column:
    """Place in the order that is cut; a row without an id stands first in its moment."""
    return F.struct(F.col(at).alias("at"), F.coalesce(F.col(tie).cast("string"), F.lit("")).alias("tie"))


def split_hot(
    df: DataFrame, key: str, at: str, limit: int | None = None, tie: str = TIE
) -> Split:
    """Separate the rows of hot keys and find the cut points of their order.

    Every key above the limit is split, into as many pieces as it holds limits of rows.
    Without such a key nothing is written. Keys and cuts are tables in the shared folder,
    at most 2 * rows / limit entries in all; the driver sees the rows of the largest key
    alone, which sets the depth of the search.
    """
    limit = limit or hot_limit(df)
    counts = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    largest, rows = counts.agg(F.max("n"), F.sum("n")).first()
    if largest is None or largest <= limit:
        return Split(df, None, None, rows or 0)
    counts = counts.where(F.col("n") > limit)
    pieces = 2
    while pieces < -(-largest // limit):
        pieces *= 2
    # the largest key needs all pieces, a smaller one a half, a quarter, ... of them
    wanted = F.pow(F.lit(2), F.ceil(F.log2(F.col("n") / F.lit(limit))))
    own = F.greatest(F.lit(2), F.least(F.lit(pieces), wanted)).cast("int")
    sizes = cut_lineage(counts.withColumn("pieces", own))
    keys = sizes.select(key)
    drawn = (
        df.select(key, position(at, tie).alias("_position"))
        .join(sizes, key)
        .where(F.rand(42) * F.col("n") < F.lit(SAMPLE) * F.col("pieces"))
        .select(key, "pieces", "_position")
    )
    if pieces > FAN:
        drawn = cut_lineage(drawn)
    fan = min(pieces, FAN)
    # of a key with more pieces only the share of one level is looked at first
    coarse = drawn.where(F.rand(43) * F.col("pieces") < F.lit(fan))
    cuts = Cuts(cut_lineage(_cut_points(coarse, [key], fan)), pieces)
    while fan**(1 + len(cuts.finer)) < pieces:
        inside = _descend(drawn, cuts, key).withColumn(
            "pieces", F.col("pieces") / F.lit(FAN ** (1 + len(cuts.finer)))
        ).where("pieces > 1")
        thin = inside.where(F.rand(44 + len(cuts.finer)) * F.col("pieces") < F.lit(FAN))
        finer = cut_lineage(_cut_points(thin, [key, PIECE], FAN))
        cuts = cuts._replace(finer=(*cuts.finer, finer))
    return Split(
        df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi"), cuts, rows
    )


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """One exchange by the key, with as many partitions as keep a task's sorts small; the rows
    of a few tasks go by the session's own number, which may be coalesced."""
    parts = -(-rows // TASK_ROWS)
    if parts <= 8:
        return df.repartition(key)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), key)


def _cut_points(drawn: DataFrame, by: list[str], fan: int) -> DataFrame:
    """Evenly spaced rows of every group of a sample, at most `fan - 1`."""
    drawn = drawn.withColumn("_fan", F.least(F.lit(fan), F.col("pieces")).cast("int"))
    groups = drawn.groupBy(*by, "_fan").agg(F.sort_array(F.collect_list("_position")).alias("p"))
    nth = F.transform(
        F.sequence(F.lit(1), F.col("_fan") - 1),
        lambda i: F.get("p", F.floor(i * F.size("p") / F.col("_fan")).cast("int") - 1),
    )
    return groups.select(*by, F.filter(nth, lambda cut: cut.isNotNull()).alias(CUTS))


def _descend(df: DataFrame, cuts: Cuts, key: str, until: bool = False) -> DataFrame:
    """Adds the piece of every `_position`, level by level, and on wish the time of its end.

    A binary search spelled out step by step. Every step is a projection of its own, so it
    stays generated code. Probes beyond the end of a shorter array are null and count as
    "not before", as does a piece without finer cuts.
    """
    out = df.withColumn(PIECE, F.lit(0).cast("bigint"))
    if until:
        out = out.withColumn(UNTIL, F.lit(None).cast("bigint"))
    for level, table in enumerate((cuts.table, *cuts.finer)):
        out = out.join(table, [key, PIECE] if level else key, "left").withColumn("_before", F.lit(0))
        span = min(cuts.pieces, FAN) // 2
        while span >= 1:
            probe = F.get(F.col(CUTS), F.col("_before") + (span - 1))
            behind = F.col("_position") > probe
            out = out.withColumn(
                "_before", F.col("_before") + F.when(behind, F.lit(span)).otherwise(F.lit(0))
            )
            span //= 2
        if until:  # behind the last cut inside a piece, its own end stays
            ends = F.get(F.col(CUTS), F.col("_before"))["at"]
            out = out.withColumn(UNTIL, F.coalesce(ends, F.col(UNTIL)))
        out = out.withColumn(PIECE, F.col(PIECE) * FAN + F.col("_before")).drop(CUTS, "_before")
    return out


def per_key(
    df: DataFrame, steps: Sequence[Step], key: str = "card_id", at: str = "ts_us",
    limit: int | None = None, tie: str = TIE,
) -> DataFrame:
    """Run the steps over every key; ordinary keys need one exchange in all."""
    split = split_hot(df, key, at, limit, tie)
    out = spread(split.cold, key, split.rows)
    for phase in ("card", "value", "totals", "own"):
        for step in steps:
            run = getattr(step, phase)
            out = run(out) if run else out
    out = out.select(*df.columns, *[c for step in steps for c in step.columns])
    if split.hot is None:
        return out
    hot = cut_lineage(with_piece(split.hot, split.cuts, key, at, tie, until=True))
    for step in steps[:-1]:
        # what a step keeps for the steps after it comes along
        hot = step.hot(hot, split.cuts)
        hot = cut_lineage(hot) if step.scans else hot
    return out.unionByName(steps[-1].hot(hot, split.cuts).select(*out.columns))


def with_piece(
    df: DataFrame, cuts: Cuts, key: str, at: str, tie: str = TIE, until: bool = False
) -> DataFrame:
    """Adds the piece of every row: its number grows along the order of a key. With `until`
    also the time at which the piece ends."""
    return _descend(df.withColumn("_position", position(at, tie)), cuts, key, until).drop("_position")


def running(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    tops: dict[str, Column] | None = None,
) -> DataFrame:
    """Running values over the pieces of a key, each piece in its own task.

    `sums` include the current row. `lasts` hold the last non-null value of the
    rows before the current one, `tops` the greatest one: of values that grow along the order
    both are the same, but the summary of a greatest value needs no sort.
    """
    keys = [key] if isinstance(key, str) else list(key)
    sums, lasts, tops = sums or {}, lasts or {}, tops or {}
    by = [*keys, PIECE]
    ins = df.withColumns(
        {f"_s_{n}": c for n, c in sums.items()}
        | {f"_l_{n}": c for n, c in lasts.items()}
        | {f"_t_{n}": c for n, c in tops.items()}
    )
    position = F.struct(*order)
    summary = ins.groupBy(*by).agg(
        *[F.sum(f"_s_{n}").alias(f"_s_{n}") for n in sums],
        *[
            F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), position)).alias(f"_l_{n}")
            for n in lasts
        ],
        *[F.max(f"_t_{n}").alias(f"_t_{n}") for n in tops],
    )
    earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(UP, -1)
    carry = summary.select(
        *by,
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_cs_{n}") for n in sums],
        *[F.last(f"_l_{n}", ignorenulls=True).over(earlier).alias(f"_cl_{n}") for n in lasts],
        *[F.max(f"_t_{n}").over(earlier).alias(f"_ct_{n}") for n in tops],
    )
    local = Window.partitionBy(*by).orderBy(*order)
    scanned = ins.withColumns(
        {f"_ws_{n}": F.sum(f"_s_{n}").over(local.rowsBetween(UP, 0)) for n in sums}
        | {
            f"_wl_{n}": F.last(f"_l_{n}", ignorenulls=True).over(local.rowsBetween(UP, -1))
            for n in lasts
        }
        | {f"_wt_{n}": F.max(f"_t_{n}").over(local.rowsBetween(UP, -1)) for n in tops}
    )
    joined = scanned.join(carry, by, "left").withColumns(
        {n: F.coalesce(F.col(f"_cs_{n}"), F.lit(0)) + F.col(f"_ws_{n}") for n in sums}
        | {n: F.coalesce(F.col(f"_wl_{n}"), F.col(f"_cl_{n}")) for n in lasts}
        | {n: F.greatest(F.col(f"_wt_{n}"), F.col(f"_ct_{n}")) for n in tops}
    )
    return joined.select(*df.columns, *sums, *lasts, *tops)
