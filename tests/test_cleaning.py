from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from swipeline.functions import cleaning
from swipeline.operators import clean
from swipeline.schemas import MESSAGE_FIELDS
from swipeline.sources import messages

VALID = {
    "transaction_id": "tx_12345",
    "card_id": "card_67890",
    "amount": "125.50",
    "merchant_id": "merchant_abc",
    "timestamp": "1707580000",
    "merchant_category": "grocery_pos",
    "location_lat": "36.08",
    "location_lon": "-81.18",
}


@pytest.fixture(scope="module")
def run(spark):
    def build(*changes):
        rows = [tuple({**VALID, **c}.get(f) for f in MESSAGE_FIELDS) for c in changes]
        schema = ", ".join(f"{f} string" for f in MESSAGE_FIELDS)
        frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
        return clean.clean(frame).orderBy("i").collect()

    return build


def test_valid_row_is_typed(run):
    (row,) = run({})
    assert row.reject_reason is None
    assert row.amount == Decimal("125.50")
    assert row.timestamp == 1707580000
    assert (row.location_lat, row.location_lon) == (36.08, -81.18)
    assert (row.city, row.state, row.user_id) == ("", "", "")


@pytest.mark.parametrize(
    ("text", "amount"),
    [
        ("125", "125.00"),
        ("-125.50", "125.50"),
        (" 12.5 ", "12.50"),
        ("1e3", "1000.00"),
        ("125.555", "125.56"),
        ("2.675", "2.68"),
        ("1.005", "1.01"),
        ("10000", "10000.00"),
        ("999999999.99", "10000.00"),
        ("-1e300", "10000.00"),
        ("inf", "10000.00"),
    ],
)
def test_amounts(run, text, amount):
    (row,) = run({"amount": text})
    assert row.reject_reason is None and row.amount == Decimal(amount)


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"amount": "not_a_number"}, cleaning.CAST_ERROR),
        ({"amount": "NaN"}, cleaning.CAST_ERROR),
        ({"amount": ""}, cleaning.CAST_ERROR),
        ({"amount": "1.0f"}, cleaning.CAST_ERROR),
        ({"location_lat": "north"}, cleaning.CAST_ERROR),
        ({"amount": "0"}, cleaning.NOT_POSITIVE),
        ({"amount": "0.004"}, cleaning.NOT_POSITIVE),
        ({"timestamp": "946684799"}, cleaning.OUT_OF_RANGE),
        ({"timestamp": "4102444801"}, cleaning.OUT_OF_RANGE),
        ({"timestamp": "invalid"}, cleaning.BAD_TIMESTAMP),
        ({"timestamp": "12:00:00"}, cleaning.BAD_TIMESTAMP),
        ({"timestamp": "2024-13-45 00:00:00"}, cleaning.BAD_TIMESTAMP),
        ({"location_lat": "91"}, cleaning.BAD_LATITUDE),
        ({"location_lat": "-91"}, cleaning.BAD_LATITUDE),
        ({"location_lon": "181"}, cleaning.BAD_LONGITUDE),
        ({"location_lon": "-181"}, cleaning.BAD_LONGITUDE),
        ({"card_id": None}, cleaning.MISSING + "card_id"),
        ({"amount": None, "merchant_id": None}, cleaning.MISSING + "amount, merchant_id"),
        # the first failed check gives the reason
        ({"amount": "x", "timestamp": "x", "location_lat": "91"}, cleaning.CAST_ERROR),
        ({"timestamp": "x", "amount": "0"}, cleaning.BAD_TIMESTAMP),
    ],
)
def test_rejects(run, change, reason):
    (row,) = run(change)
    assert row.reject_reason == reason


def test_all_missing_fields_are_listed(run):
    (row,) = run({f: None for f in VALID if f != "transaction_id"})
    assert row.reject_reason == cleaning.MISSING + "card_id, amount, merchant_id, timestamp"


@pytest.mark.parametrize(
    ("text", "seconds"),
    [
        ("2024-02-10T12:00:00Z", 1707566400),
        ("2024-02-10 12:00:00", 1707566400),
        ("2024-02-10T12:00:00+01:00", 1707562800),
        ("2024-02-10T12:00:00.750", 1707566400),
        ("2024-02-10", 1707523200),
        ("1707580000.999", 1707580000),
        ("946684800", 946684800),
        ("4102444800", 4102444800),
    ],
)
def test_timestamps(run, text, seconds):
    (row,) = run({"timestamp": text})
    assert row.reject_reason is None and row.timestamp == seconds


@pytest.mark.parametrize(("lat", "lon"), [("90", "180"), ("-90", "-180"), ("0", "0"), (None, None)])
def test_coordinates_at_the_edge_are_valid(run, lat, lon):
    (row,) = run({"location_lat": lat, "location_lon": lon})
    assert row.reject_reason is None


def test_category_default_only_for_null(run):
    null, empty = run({"merchant_category": None}, {"merchant_category": ""})
    assert (null.merchant_category, empty.merchant_category) == ("UNKNOWN", "")


@pytest.mark.parametrize("text", ["卡_日本", "tx_🎉", "x" * 1000, "a'b\"c\\d"])
def test_ids_stay_as_they_are(run, text):
    (row,) = run({"transaction_id": text, "card_id": text})
    assert (row.transaction_id, row.card_id) == (text, text)


def test_one_bad_message_does_not_stop_the_others(run):
    rows = run({}, {"amount": "bad"}, {"transaction_id": "tx_2"})
    assert [r.reject_reason for r in rows] == [None, cleaning.CAST_ERROR, None]


def test_decode_flags_what_is_no_object(spark):
    texts = ['{"transaction_id":"a","amount":1.5,"extra":1}', "not json", "[1,2]", '"s"', "{}"]
    frame = spark.createDataFrame([("k", t) for t in texts], "key string, value string")
    out = clean.clean(messages.decode(frame)).select("transaction_id", "amount", "reject_reason")
    rows = out.collect()
    assert rows[0].transaction_id == "a" and rows[0].reject_reason.startswith(cleaning.MISSING)
    assert [r.reject_reason for r in rows[1:4]] == [cleaning.NOT_A_RECORD] * 3
    assert rows[4].reject_reason == (
        cleaning.MISSING + "transaction_id, card_id, amount, merchant_id, timestamp"
    )


def test_json_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([("k", "{}")], "key string, value string").write.parquet(str(tmp_path / "m"))
    good = clean.accepted(messages.decode(spark.read.parquet(str(tmp_path / "m"))))
    plan = good.select("amount")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_reprocessing_changes_nothing(spark, run):
    frame = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("a", 1, "y")],
        "transaction_id string, timestamp bigint, note string",
    )
    once = clean.dedup_transactions(frame)
    twice = clean.dedup_transactions(once.unionByName(frame))
    expected = [("a", 1, "y"), ("b", 1, "z")]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, twice.collect())) == expected


@pytest.mark.parametrize("percent", [1.0, 50.0, 90.0, 99.0, 100.0])
def test_percentile_clip_is_exact(spark, percent):
    values = [(i * 7919 % 1000) / 100 + 0.5 for i in range(1, 1001)] + [50000.0, 99999.99]
    frame = spark.createDataFrame([(str(v),) for v in values], "t string").select(
        F.col("t").cast("decimal(18,2)").alias("amount")
    )
    got = clean.clip_at_percentile(frame, percent=percent).agg(F.max("amount_clipped")).first()[0]
    ordered = sorted(round(v, 2) for v in values)
    rank = max(1, -(-len(ordered) * percent // 100))
    assert float(got) == ordered[int(rank) - 1]


def test_parsing_is_compiled_and_done_once(spark):
    """The parsing is no part of a generator, which Spark interprets, nor of the reject filter; text
    that does not match is null, as a cast of '' raises an error inside Spark."""
    frame = spark.createDataFrame([tuple(VALID.get(f) for f in MESSAGE_FIELDS)], ", ".join(f"{f} string" for f in MESSAGE_FIELDS))
    plan = clean.accepted(frame)._jdf.queryExecution().optimizedPlan().toString()
    parsing = [line for line in plan.splitlines() if "regexp_" in line]
    assert len(parsing) == 1 and "Generate" not in parsing[0] and "Filter" not in parsing[0]
    texts = spark.createDataFrame([("x",), ("",), (" 1.5",), (None,)], "t string")
    found = texts.select(cleaning.matching(F.col("t"), cleaning.NUMBER).alias("m")).collect()
    assert [r.m for r in found] == [None, None, " 1.5", None]
