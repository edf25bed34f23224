"""Offline per-card features: running statistics that include the current row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from swipeline import config
from swipeline.functions import scalars
from swipeline.operators.hot import PIECE, UP, Cuts, Step, per_key, running
from swipeline.operators.velocity import (
    CARD,
    ORDER,
    cents,
    lookback_merchants,
    lookback_sums,
)
from swipeline.session import cut_lineage

RANK_BLOCK = 1_000_000


def _ordered(*by: str):
    return Window.partitionBy(*by).orderBy(*ORDER)


def running_count(name: str = "tx_count_24h") -> Step:
    """Number of the transaction within its card."""

    def card(df: DataFrame) -> DataFrame:
        return df.withColumn(name, F.row_number().over(_ordered(CARD)).cast("bigint"))

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        out = running(
            df, CARD, ORDER,
            sums={name: F.lit(1).cast("bigint")},
        )
        return out.select(*df.columns, name)

    return Step([name], hot, card=card)


def average_of_last(rows: int = 7, name: str = "avg_amt_7d") -> Step:
    """Mean amount of the last `rows` transactions, the current one included."""

    def mean(window) -> Column:
        return F.sum(cents()).over(window) / 100 / F.count("amount").over(window)

    def totals(df: DataFrame) -> DataFrame:
        return df.withColumn(name, mean(_ordered(CARD).rowsBetween(-(rows - 1), 0)))

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        # blocks of consecutive rows; the tail of a block is context for the next one
        ranked = running(
            df, CARD, ORDER,
            sums={"_n": F.lit(1).cast("bigint")},
        )
        block = F.floor((F.col("_n") - 1) / RANK_BLOCK)
        tail = (F.col("_n") - 1) % RANK_BLOCK > RANK_BLOCK - rows
        copies = F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))
        spread = ranked.withColumn("_own", block).withColumn("_block", F.explode(copies))
        out = spread.withColumn(
            name, mean(_ordered(CARD, "_block").rowsBetween(-(rows - 1), 0))
        ).where(F.col("_own") == F.col("_block"))
        return out.select(*df.columns, name)

    return Step([name], hot, totals=totals)


def running_distinct(column: str = "merchant_id", name: str = "unique_merchants_7d") -> Step:
    """Distinct values of the card so far: a running sum of first visits."""

    def value(df: DataFrame) -> DataFrame:
        before = F.lag("ts_us").over(_ordered(CARD, column))
        return df.withColumn("_earlier", before).withColumn(
            "_first", F.col("_earlier").isNull().cast("bigint")
        )

    def totals(df: DataFrame) -> DataFrame:
        return df.withColumn(name, F.sum("_first").over(_ordered(CARD).rowsBetween(UP, 0)))

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        firsts = (
            df.groupBy(CARD, column)
            .agg(F.min(F.struct(*ORDER, PIECE)).alias("a"))
            .select(CARD, f"a.{PIECE}", "a.ts_us", "a.transaction_id", F.lit(1).cast("bigint").alias("_d"))
        )
        events = df.withColumns(
            {"_d": F.lit(0).cast("bigint"), "_row": F.lit(True)}
        ).unionByName(firsts, allowMissingColumns=True)
        # the first visit counts for its own row
        scanned = running(
            events.withColumn("_late", 1 - F.col("_d")),
            CARD, [*ORDER, "_late"], sums={name: F.col("_d")},
        )
        return scanned.where("_row").select(*df.columns, name)

    return Step([name], hot, value=value, totals=totals)


def home_location() -> Step:
    """`home_lat`, `home_lon`: the first known value of each, over the whole card."""

    def card(df: DataFrame) -> DataFrame:
        ordered = _ordered(CARD).rowsBetween(UP, Window.unboundedFollowing)
        return df.withColumns(
            {
                "home_lat": F.first("lat", ignorenulls=True).over(ordered),
                "home_lon": F.first("lon", ignorenulls=True).over(ordered),
            }
        )

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        position = F.struct(*ORDER)
        homes = df.groupBy(CARD).agg(
            F.min_by("lat", F.when(F.col("lat").isNotNull(), position)).alias("home_lat"),
            F.min_by("lon", F.when(F.col("lon").isNotNull(), position)).alias("home_lon"),
        )
        return df.join(homes, CARD).select(*df.columns, "home_lat", "home_lon")

    return Step(["home_lat", "home_lon"], hot, card=card)


def previous_location() -> Step:
    """`prev_lat`, `prev_lon` of the card's previous transaction."""

    def card(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "prev_lat": F.lag("lat").over(_ordered(CARD)),
                "prev_lon": F.lag("lon").over(_ordered(CARD)),
            }
        )

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        out = running(
            df, CARD, ORDER,
            lasts={"_prev": F.struct("lat", "lon")},
        )
        return out.select(
            *df.columns,
            F.col("_prev.lat").alias("prev_lat"),
            F.col("_prev.lon").alias("prev_lon"),
        )

    return Step(["prev_lat", "prev_lon"], hot, card=card)


def distance_from_home() -> Column:
    return F.coalesce(
        scalars.haversine_km(
            F.col("lat"), F.col("lon"), F.col("home_lat"), F.col("home_lon")
        ),
        F.lit(0.0),
    )


def distance_from_last() -> Column:
    return F.coalesce(
        scalars.haversine_km(
            F.col("lat"), F.col("lon"), F.col("prev_lat"), F.col("prev_lon")
        ),
        F.lit(0.0),
    )


def time_true(df: DataFrame, limit: int | None = None) -> DataFrame:
    """What the names say: 7-day mean, 24-hour count and 7-day distinct merchants,
    the current row and all rows of its timestamp included."""
    steps = [
        lookback_sums(
            {"24h": config.DAY_S, "7d": 7 * config.DAY_S},
            {"n": F.lit(1).cast("bigint"), "amt": cents()},
            include_current=True,
        ),
        lookback_merchants("unique_merchants_7d", 7 * config.DAY_S, include_current=True),
    ]
    out = per_key(df, steps, limit=limit)
    return out.select(
        *df.columns,
        (F.col("amt_7d") / 100 / F.col("n_7d")).alias("avg_amt_7d"),
        F.col("n_24h").alias("tx_count_24h"),
        "unique_merchants_7d",
    )


def offline_features(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """The 20-column offline table from rows of the card data set."""
    ts = F.try_to_timestamp(F.col("trans_date_trans_time"))
    named = rows.select(
        F.col("trans_num").alias("transaction_id"),
        F.col("cc_num").alias(CARD),
        ts.alias("event_timestamp"),
        F.unix_micros(ts).alias("ts_us"),
        F.col("amt").cast("decimal(18,2)").alias("amount"),
        "category", "zip", "lat", F.col("long").alias("lon"), "city_pop",
        F.col("merchant").alias("merchant_id"),
        "merch_lat", "merch_long", "gender",
        scalars.age_at(F.col("dob"), F.col("trans_date_trans_time")).alias("age"),
    )
    steps = [
        average_of_last(),
        running_count(),
        running_distinct(),
        home_location(),
        previous_location(),
    ]
    out = per_key(named, steps, limit=limit)
    zero = F.lit(0)
    when = F.col("event_timestamp")
    return out.select(
        F.col(CARD).alias("cc_num"),
        when,
        F.col("amount").cast("double").alias("amt"),
        "category",
        F.col("zip").cast("bigint").alias("zip"),
        F.col("lat").cast("float").alias("lat"),
        F.col("lon").cast("float").alias("long"),
        F.col("city_pop").cast("bigint").alias("city_pop"),
        F.col("merchant_id").alias("merchant"),
        F.col("merch_lat").cast("float").alias("merch_lat"),
        F.col("merch_long").cast("float").alias("merch_long"),
        "gender",
        "age",
        F.coalesce("avg_amt_7d", F.lit(0.0)).alias("avg_amt_7d"),
        F.coalesce("tx_count_24h", zero).cast("bigint").alias("tx_count_24h"),
        F.coalesce("unique_merchants_7d", zero).cast("bigint").alias("unique_merchants_7d"),
        distance_from_home().cast("float").alias("distance_from_home"),
        distance_from_last().cast("float").alias("distance_from_last_tx"),
        scalars.hour_of_day(when).cast("bigint").alias("hour_of_day"),
        scalars.day_of_week(when).cast("bigint").alias("day_of_week"),
        "transaction_id",
    )


#: Hex digits of the digest that one round of the selection looks at: 65,536 counts at most.
DIGITS = 4
LONG = 32  # of the whole digest


def sample_n(df: DataFrame, n: int, key: str = "transaction_id", seed: int = 42) -> DataFrame:
    """Exactly `n` rows, the same in every run: smallest seeded hashes of the key.

    Draw it after the features are computed, so histories stay whole. The n-th hash is found
    by counting: rows per leading digits of the hash, then, inside the group where the n-th
    lies, per further digits, and so on. The counts read the key alone, and the draw itself is
    a filter: nothing is sorted and no task sees more than its own rows. Rows of one key
    have one hash; where only some of them fit, those of the first partitions are taken. A
    null key has the smallest hash.
    """
    digest = F.coalesce(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))), F.lit(""))
    if n <= 0:
        return df.where(F.lit(False))
    cut = _nth(df.select(digest.alias("digest")), n)
    if cut is None:
        return df
    head, rest = cut
    begins = F.substring(digest, 1, max(1, len(head)))
    if rest is None:
        return df.where(begins <= head)
    # copies of one key: their places are settled by writing them
    same = cut_lineage(df.where(digest == head).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    last = 0
    for last, count in sorted(map(tuple, same.groupBy(part).count().collect())):  # one row per partition
        if rest <= count:
            break
        rest -= count
    first = (part < last) | ((part == last) & (F.col("_place").bitwiseAND((1 << 33) - 1) < rest))
    return df.where(digest < head).unionByName(same.where(first).drop("_place"))


def _nth(digests: DataFrame, n: int) -> tuple[str, int | None] | None:
    """Where the n smallest digests end: the leading digits of the last of them, and how many
    rows of this very digest belong to them - None if all that begin so do. None if there
    are no more than n rows."""
    width = DIGITS
    while True:
        begins = F.substring("digest", 1, width)
        counts = sorted(map(tuple, digests.groupBy(begins.alias("head")).count().collect()))
        for group, count in counts:
            if n <= count:
                break
            n -= count
        else:
            return None
        if n == count:
            return group, None
        if len(group) < width or width == LONG:  # rows of one digest
            return group, n
        digests = cut_lineage(digests.where(begins == group))
        width = LONG if count <= 16**DIGITS else width + DIGITS
