from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from swipeline.functions import scalars


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    ("text", "weekend", "night", "hour", "day"),
    [
        ("2024-02-10 15:46:40", 1, 0, 15, 5),
        ("2024-02-12 16:00:00", 0, 0, 16, 0),
        ("2024-02-12 02:00:00", 0, 1, 2, 0),
        ("2024-02-12 21:59:59", 0, 0, 21, 0),
        ("2024-02-12 22:00:00", 0, 1, 22, 0),
        ("2024-02-11 06:00:00", 1, 0, 6, 6),
    ],
)
def test_time_features(spark, text, weekend, night, hour, day):
    t = ts(text)
    got = [
        value(spark, c)
        for c in (scalars.is_weekend(t), scalars.is_night(t), scalars.hour_of_day(t), scalars.day_of_week(t))
    ]
    assert got == [weekend, night, hour, day]


@pytest.mark.parametrize(("x", "digits", "want"), [(2.675, 2, 2.68), (1.005, 2, 1.01), (68.735, 2, 68.74), (-0.0005, 3, -0.001), (None, 2, None)])
def test_half_up(spark, x, digits, want):
    assert value(spark, scalars.half_up(F.lit(x).cast("double"), digits)) == want


def test_amount_log(spark):
    assert value(spark, scalars.amount_log(F.lit(100.0))) == pytest.approx(math.log(101))
    assert value(spark, scalars.amount_log(F.lit(-5.0))) == 0.0


def test_haversine(spark):
    km = value(spark, scalars.haversine_km(F.lit(40.7128), F.lit(-74.006), F.lit(51.5074), F.lit(-0.1278)))
    assert km == pytest.approx(5570.2, abs=0.5)
    half = value(spark, scalars.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert half == pytest.approx(math.pi * 6371)
    null = F.lit(None).cast("double")
    assert value(spark, scalars.haversine_km(null, F.lit(0.0), F.lit(0.0), F.lit(0.0))) is None


@pytest.mark.parametrize(
    ("dob", "when", "age"),
    [("1990-01-01", "2020-01-01", 30), ("unknown", "2020-01-01", 30), ("2000-03-01", "2019-02-24", 18), (None, "2020-01-01", 30)],
)
def test_age(spark, dob, when, age):
    assert value(spark, scalars.age_at(F.lit(dob).cast("string"), F.lit(when))) == age


def test_ratio_without_average(spark):
    assert value(spark, scalars.ratio(F.lit(5.0), F.lit(0.0))) == 1.0
    assert value(spark, scalars.deviation(F.lit(5.0), F.lit(0.0))) == 0.0


def test_bucket_is_stable(spark):
    import hashlib

    want = int(hashlib.md5(b"grocery_pos").hexdigest()[:8], 16) % 1000
    assert value(spark, scalars.category_bucket(F.lit("grocery_pos"))) == want


def test_session_clock_is_utc(spark):
    assert value(spark, F.timestamp_seconds(F.lit(1707580000)).cast("string")) == "2024-02-10 15:46:40"
    assert dt.datetime.fromtimestamp(1707580000, dt.UTC).weekday() == 5
