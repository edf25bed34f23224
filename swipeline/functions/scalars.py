"""Column expressions: Column in, Column out, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from swipeline import config


def half_up(value: Column, digits: int) -> Column:
    """Round half up at `digits`, as double.

    Going through nine decimal places removes binary noise, so a value that is
    a tie on paper is rounded as a tie. NaN and infinity give null.
    """
    exact = value.try_cast("decimal(28,9)")
    return exact.cast(f"decimal(28,{digits})").cast("double")


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_us(us: Column) -> Column:
    return F.timestamp_micros(us)


def amount_log(amount: Column) -> Column:
    return F.log1p(F.greatest(amount.cast("double"), F.lit(0.0)))


def has_location(lat: Column) -> Column:
    """Looks at the latitude only."""
    return lat.isNotNull().cast("int")


def category_or_unknown(category: Column) -> Column:
    return F.coalesce(category, F.lit(config.OPTIONAL_DEFAULTS["merchant_category"]))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_night(ts: Column) -> Column:
    return ((F.hour(ts) >= 22) | (F.hour(ts) < 6)).cast("int")


def age_at(dob: Column, ts: Column) -> Column:
    """Whole 365-day years between two text or date values, 30 where unreadable."""
    days = F.datediff(
        F.try_to_timestamp(ts.cast("string")), F.try_to_timestamp(dob.cast("string"))
    )
    years = F.floor(days / F.lit(365))
    return F.coalesce(years, F.lit(config.DEFAULT_AGE)).cast("bigint")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null when any coordinate is null."""
    a1, o1, a2, o2 = (F.radians(c.cast("double")) for c in (lat1, lon1, lat2, lon2))
    chord = (
        F.pow(F.sin((a2 - a1) / 2), 2)
        + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    )
    # least() skips nulls, so the null guard has to be explicit
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(
        known,
        F.lit(2 * config.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord))),
    )


def deviation(amount: Column, average: Column) -> Column:
    x, avg = amount.cast("double"), average.cast("double")
    return F.when(avg > 0, half_up((x - avg) / avg, 3)).otherwise(F.lit(0.0))


def ratio(amount: Column, average: Column) -> Column:
    """amount / average, 1 where there is no positive average."""
    x, avg = amount.cast("double"), average.cast("double")
    return F.when(avg > 0, x / avg).otherwise(F.lit(1.0))


def category_bucket(category: Column) -> Column:
    """The same bucket in every process: first 32 bits of the md5, mod 1000."""
    head = F.conv(F.substring(F.md5(category), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(config.HASH_BUCKETS)).cast("bigint")
