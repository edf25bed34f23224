"""Fitted distributions that are stored and merged: sketches for clipping, histograms for drift.

What a day or a batch looked like is kept as one small row per feature. Later jobs read these
rows and never the data again: quantiles come from merged sketches, drift from counts
over edges that were fixed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from swipeline import config
from swipeline.operators.monitoring import PSI_BINS, PSI_FLOOR

#: Size of a sketch: at 400, a rank is off by less than RANK_ERROR (99 %), also after merging.
SKETCH_K, RANK_ERROR = 400, 0.0085


def day_of(time: str = "ts_us") -> Column:
    return F.to_date(F.timestamp_micros(time))


def long_values(rows: DataFrame, columns: list[str], time: str) -> DataFrame:
    """(feature, day, x) of every value that is there; NaN is none."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns]
    long = rows.select(day_of(time).alias("day"), F.inline(F.array(*pairs)))
    return long.where(F.col("x").isNotNull() & ~F.isnan("x"))


# --- quantiles -----------------------------------------------------------------------------


def sketches(rows: DataFrame, columns: list[str], time: str = "ts_us") -> DataFrame:
    """(feature, day, sketch) of the rows' values; combined before the shuffle."""
    values = long_values(rows, columns, time)
    return values.groupBy("feature", "day").agg(F.kll_sketch_agg_double("x", F.lit(SKETCH_K)).alias("sketch"))


def merged(stored: DataFrame, *by: str) -> DataFrame:
    """One sketch per group of stored ones, in whatever parts they came."""
    return stored.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))


def limits(stored: DataFrame, percent: float = config.CLIP_PERCENTILE) -> DataFrame:
    """(feature, day, limit): the percentile of the day before, from stored sketches."""
    quantile = F.kll_sketch_get_quantile_double("sketch", F.lit(percent / 100.0))
    return merged(stored, "feature", "day").select(
        "feature", F.date_add("day", 1).alias("day"), quantile.alias("limit")
    )


def clip_by_day(rows: DataFrame, limits: DataFrame, column: str = "amount", time: str = "ts_us") -> DataFrame:
    """Adds `{column}_clipped`: at most the limit of the row's day, where there is one.

    An equi-join on the day with one row per day; a day that holds a third of the rows is split by
    the skew join. Nulls stay null.
    """
    mine = limits.where(F.col("feature") == column).select(F.col("day").alias("_day"), F.col("limit").alias("_limit"))
    kind = rows.schema[column].dataType
    limit = F.coalesce(F.col("_limit").cast(kind), F.col(column))
    joined = rows.withColumn("_day", day_of(time)).join(mine, "_day", "left")
    clipped = F.when(F.col(column).isNotNull(), F.least(F.col(column), limit))
    return joined.withColumn(f"{column}_clipped", clipped).drop("_day", "_limit")


# --- drift ---------------------------------------------------------------------------------


def edges(reference: DataFrame, columns: list[str], time: str = "ts_us") -> DataFrame:
    """(feature, lo, hi) of the reference: fixed from then on."""
    return long_values(reference, columns, time).groupBy("feature").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi")
    )


def histograms(
    rows: DataFrame, edges: DataFrame, columns: list[str], time: str = "ts_us", bins: int = PSI_BINS
) -> DataFrame:
    """(feature, day, bin, n) over equal bins between the fixed edges; values outside fall into
    the end bins. Counts of parts add up."""
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    number = F.when(width > 0, F.floor((F.col("x") - F.col("lo")) / width)).otherwise(F.lit(0))
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), number)).cast("int").alias("bin")
    values = long_values(rows, columns, time).join(F.broadcast(edges), "feature")  # one row per column
    return values.groupBy("feature", "day", place).agg(F.count(F.lit(1)).alias("n"))


def _filled(counts: DataFrame, by: list[str], name: str, bins: int) -> DataFrame:
    """The counts of a group's bins as one array."""
    summed = counts.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    kept = summed.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.element_at("m", b), F.lit(0)))
    return kept.select(*by, filled.alias(name))


def drift_by_day(expected: DataFrame, actual: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """(feature, day, n, psi) of every actual day against all expected days, from stored
    histograms over the same edges. An empty share counts as 1e-6."""
    one = _filled(expected, ["feature"], "e", bins)
    many = _filled(actual, ["feature", "day"], "a", bins)
    whole = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, n: s + n)
    share = lambda n, total: F.greatest(n / total, F.lit(PSI_FLOOR))
    sums = many.join(one, "feature").withColumns({"n_e": whole("e"), "n": whole("a")})
    terms = F.zip_with(
        "e", "a",
        lambda e, a: (share(a, F.col("n")) - share(e, F.col("n_e")))
        * F.log(share(a, F.col("n")) / share(e, F.col("n_e"))),
    )
    return sums.select("feature", "day", "n", F.aggregate(terms, F.lit(0.0), lambda s, t: s + t).alias("psi"))
