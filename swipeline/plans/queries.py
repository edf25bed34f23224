"""Every registered batch query: (spark, folder of the given tables) -> DataFrame.

Doubles are rounded on output, so that two engines print the same value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from swipeline import config
from swipeline.functions import cleaning, scalars
from swipeline.operators import (
    clean,
    distributions,
    monitoring,
    offline,
    predictions,
    quality,
    scoring,
    store,
    training,
    velocity,
)
from swipeline.plans import realtime
from swipeline.schemas import TRANSACTION_FEATURES as VIEW, FeatureView
from swipeline.session import cut_lineage, shared_dir, tune
from swipeline.sources import messages, readers, tables, writers

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DAY_US = config.DAY_S * config.US


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    REGISTRY[function.__name__] = run
    return run


def money(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def rounded(name: str, digits: int = 6) -> Column:
    return scalars.half_up(F.col(name), digits).alias(name)


def long(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def at(text: str) -> Column:
    return F.unix_micros(F.lit(text).cast("timestamp"))


def half_time(rows: DataFrame, time: str = "ts_us") -> Column:
    """The middle of the rows' time, in microseconds."""
    low, high = rows.agg(F.min(time), F.max(time)).first()
    return F.lit(None).cast("bigint") if low is None else F.lit(low + (high - low) // 2)


FIXED_MODEL = training.LinearScorer(
    [0.002, 0.3, 0.5, 9.0], -2.0, ["amount", "tx_count_10m", "is_new_card", "no_such_column"]
)

# --- shared inputs -------------------------------------------------------------------


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant table of all transactions."""
    return monitoring.merchant_risk(tables.transactions(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realtime.realtime_features(
        tables.transactions(spark, sf_dir), merchants(spark, sf_dir)
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return realtime.score(features(spark, sf_dir))


def offline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offline.offline_features(tables.card_rows(spark, sf_dir))


def published_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.materialize(
        offline_table(spark, sf_dir), "cc_num", "event_timestamp", "transaction_id"
    )


def card_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.card_snapshot(velocity.card_history(tables.transactions(spark, sf_dir)))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction predicted, then predicted a second time an hour later as
    BLOCK: the second prediction must not enter the log."""
    created = F.timestamp_micros("ts_us")
    first = predictions.to_predictions(
        scored(spark, sf_dir), ["tx_count_10m", "is_new_card"], created
    )
    copies = first.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns(
        {
            "created_at": F.col("created_at") + F.make_dt_interval(hours=F.col("copy")),
            "decision": F.when(F.col("copy") == 1, "BLOCK").otherwise(F.col("decision")),
        }
    )
    return predictions.insert_once(None, copies.drop("copy"))


# --- sources and sinks -----------------------------------------------------------------


@query
def src_csv(spark, sf_dir):
    path = shared_dir(spark)
    tables.card_rows(spark, sf_dir).write.option("header", True).csv(path)
    rows = readers.csv(spark, path)
    return rows.select(
        "trans_num", "cc_num", "amt", "merchant", "category", rounded("lat"), "dob", "is_fraud"
    )


@query
def sink_parquet(spark, sf_dir):
    path = shared_dir(spark)
    writers.write_features(offline_table(spark, sf_dir), path, "event_timestamp")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("amt").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query
def src_parquet(spark, sf_dir):
    """A week of the stored offline table; the other days' files are not read."""
    path = shared_dir(spark)
    writers.write_features(offline_table(spark, sf_dir), path, "event_timestamp")
    week = [F.lit(t).cast("timestamp") for t in ("2024-01-08 12:00:00", "2024-01-15 12:00:00")]
    out = readers.features(spark, path, "event_timestamp", *week)
    return out.select("transaction_id", "cc_num", "amt", "tx_count_24h")


@query
def to_message(spark, sf_dir):
    out = messages.to_message(tables.card_rows(spark, sf_dir))
    return out.select(
        "transaction_id", "card_id", "user_id", "merchant_id", "merchant_category", "zip",
        "gender", "dob", "amount", "timestamp", rounded("location_lat"),
        rounded("location_lon"), rounded("merchant_lat"), "is_fraud", "city_pop",
    )


@query
def encode_messages(spark, sf_dir):
    encoded = messages.encode(messages.to_message(tables.card_rows(spark, sf_dir)))
    back = F.from_json(
        "value", "transaction_id string, amount double, timestamp bigint, zip string, is_fraud int"
    )
    return encoded.select("key", back.alias("m")).select("key", "m.*")


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as they arrive: every 41st is no JSON object."""
    sent = messages.encode(tables.raw_messages(spark, sf_dir).drop("delivery"))
    broken = F.get_json_object("value", "$.transaction_id").cast("bigint") % 41 == 0
    return sent.withColumn("value", F.when(broken, "not json").otherwise(F.col("value")))


def outcomes(scored: DataFrame, dead: DataFrame) -> DataFrame:
    """Decided transactions and dead letters in one table."""
    decided = scored.select(
        "transaction_id", "fraud_probability", "risk_level", "decision",
        F.lit(None).cast("string").alias("reject_reason"),
    )
    return decided.unionByName(
        dead.select("transaction_id", "reject_reason"), allowMissingColumns=True
    )


@query
def pipeline_batch(spark, sf_dir):
    """Raw messages to decisions in one plan; nothing is lost on the way."""
    return outcomes(*realtime.from_messages(received(spark, sf_dir), merchants(spark, sf_dir)))


@query
def decode_messages(spark, sf_dir):
    out = clean.clean(messages.decode(received(spark, sf_dir)))
    return out.select(
        "transaction_id", "card_id", money("amount"), "timestamp", "merchant_category",
        "reject_reason",
    )


# --- validation and cleaning --------------------------------------------------------------


@query
def validate_required(spark, sf_dir):
    out = clean.validate_required(tables.raw_messages(spark, sf_dir))
    return out.select("transaction_id", "missing_fields")


@query
def fill_optional(spark, sf_dir):
    out = clean.fill_optional(tables.raw_messages(spark, sf_dir))
    return out.select("transaction_id", "merchant_category", "city", "state", "user_id")


@query
def cast_types(spark, sf_dir):
    raw = tables.raw_messages(spark, sf_dir)
    amount = cleaning.amount(F.col("amount"))
    lat, lon = (cleaning.coordinate(F.col(c)) for c in ("location_lat", "location_lon"))
    return raw.select(
        "transaction_id",
        amount.isNull().cast("int").alias("amount_failed"),
        rounded_of(F.when(F.abs(lat) < 1e6, lat), "lat"),
        rounded_of(F.when(F.abs(lon) < 1e6, lon), "lon"),
    )


def rounded_of(column: Column, name: str, digits: int = 6) -> Column:
    return scalars.half_up(column, digits).alias(name)


@query
def normalize_amount(spark, sf_dir):
    """`orders` amounts, most of them above the clip, and the dirty messages."""
    ties = tables.tied_transactions(spark, sf_dir).select(
        F.concat(F.lit("o"), "transaction_id").alias("id"), F.col("amount").cast("string")
    )
    raw = tables.raw_messages(spark, sf_dir).select(
        F.concat(F.lit("e"), "transaction_id").alias("id"), "amount"
    )
    return ties.unionByName(raw).select(
        "id", cleaning.amount(F.col("amount")).cast("double").alias("amount")
    )


@query
def clip_percentile(spark, sf_dir):
    ties = tables.tied_transactions(spark, sf_dir)
    return clean.clip_at_percentile(ties).select(
        "transaction_id", money("amount"), money("amount_clipped")
    )


@query
def parse_timestamp(spark, sf_dir):
    raw = tables.raw_messages(spark, sf_dir)
    return raw.select(
        "transaction_id", cleaning.epoch_seconds(F.col("timestamp")).alias("epoch_seconds")
    )


@query
def validate_ranges(spark, sf_dir):
    out = clean.clean(tables.raw_messages(spark, sf_dir))
    return out.select("transaction_id", money("amount"), "timestamp", "reject_reason")


@query
def reject_report(spark, sf_dir):
    return clean.reject_report(clean.clean(tables.raw_messages(spark, sf_dir)))


@query
def dedup_transactions(spark, sf_dir):
    good = clean.accepted(tables.raw_messages(spark, sf_dir).drop("delivery"))
    out = clean.dedup_transactions(good)
    return out.select("transaction_id", "card_id", money("amount"), "timestamp")


# --- scalar features -----------------------------------------------------------------------


@query
def tx_features(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    return tx.select(
        "transaction_id",
        rounded_of(scalars.amount_log(F.col("amount")), "amount_log"),
        scalars.has_location(F.col("lat")).alias("has_location"),
        scalars.category_or_unknown(F.col("merchant_category")).alias("merchant_category"),
    )


@query
def temporal_features(spark, sf_dir):
    ts = F.timestamp_micros("ts_us")
    return tables.transactions(spark, sf_dir).select(
        "transaction_id",
        scalars.hour_of_day(ts).cast("bigint").alias("hour_of_day"),
        scalars.day_of_week(ts).cast("bigint").alias("day_of_week"),
        scalars.is_weekend(ts).alias("is_weekend"),
        scalars.is_night(ts).alias("is_night"),
    )


@query
def age_at_tx(spark, sf_dir):
    """Birth dates derived from the customer; every 13th customer has an unreadable one."""
    orders = tables.read(spark, sf_dir, "orders")
    dob = F.when(F.col("o_custkey") % 13 == 0, "unknown").otherwise(
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("o_custkey") % 15000).cast("int"))
        .cast("string")
    )
    return orders.select("o_orderkey", scalars.age_at(dob, F.col("o_orderdate")).alias("age"))


@query
def haversine(spark, sf_dir):
    km = scalars.haversine_km(F.col("lat"), F.col("lon"), F.lit(40.0), F.lit(-100.0))
    return tables.transactions(spark, sf_dir).select("transaction_id", rounded_of(km, "km"))


@query
def category_bucket(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    key = F.concat_ws("-", "merchant_category", "merchant_id")
    return tx.select("transaction_id", scalars.category_bucket(key).alias("bucket"))


@query
def json_roundtrip(spark, sf_dir):
    """History members as JSON and back; every 17th is broken and left out."""
    members = messages.history_members(tables.transactions(spark, sf_dir))
    broken = F.col("transaction_id").cast("bigint") % 17 == 0
    members = members.withColumn("value", F.when(broken, "{broken").otherwise(F.col("value")))
    return messages.parse_history(members)


# --- lookback features ------------------------------------------------------------------------


@query
def velocity_counts(spark, sf_dir):
    out = velocity.velocity_counts(tables.transactions(spark, sf_dir))
    return out.select("transaction_id", "tx_count_10m", "tx_count_1h", "tx_count_24h")


@query
def velocity_amounts(spark, sf_dir):
    out = velocity.velocity_amounts(tables.transactions(spark, sf_dir))
    return out.select(
        "transaction_id",
        money("total_amount_10m"), money("total_amount_1h"), money("total_amount_24h"),
    )


@query
def unique_merchants_24h(spark, sf_dir):
    out = velocity.unique_merchants_24h(tables.transactions(spark, sf_dir))
    return out.select("transaction_id", "unique_merchants_24h")


@query
def unique_merchants_idle(spark, sf_dir):
    out = velocity.unique_merchants_idle(tables.transactions(spark, sf_dir))
    return out.select("transaction_id", "unique_merchants_since_idle")


@query
def time_since_last(spark, sf_dir):
    out = velocity.time_since_last(tables.transactions(spark, sf_dir))
    return out.select("transaction_id", "time_since_last_tx")


@query
def ema_amount(spark, sf_dir):
    out = velocity.ema_amount(tables.transactions(spark, sf_dir))
    return out.select("transaction_id", "avg_tx_amount_30d")


@query
def rolling_features(spark, sf_dir):
    out = velocity.ema_amount(tables.transactions(spark, sf_dir))
    return out.select("transaction_id", "amount_deviation", "amount_vs_avg_ratio")


@query
def velocity_ties(spark, sf_dir):
    """All lookback features where many rows of a card share one timestamp."""
    out = velocity.card_history(tables.tied_transactions(spark, sf_dir))
    return out.select(
        "transaction_id", "tx_count_10m", "tx_count_24h", money("total_amount_24h"),
        "unique_merchants_24h", "unique_merchants_since_idle", "time_since_last_tx",
        rounded_of(F.col("ema_before"), "ema_before", 4),
    )


@query
def velocity_hot_cards(spark, sf_dir):
    """The same features with every card of more than 60 rows cut into pieces."""
    out = velocity.card_history(tables.transactions(spark, sf_dir), limit=60)
    return out.select(
        "transaction_id", "tx_count_10m", "tx_count_24h", money("total_amount_24h"),
        "unique_merchants_24h", "unique_merchants_since_idle", "time_since_last_tx",
        rounded_of(F.col("ema_before"), "ema_before", 4),
    )


@query
def velocity_hot_moment(spark, sf_dir):
    """The same features with four cards whose rows have one of a few timestamps: every moment of
    a card is cut into pieces by the id."""
    ten_days = 10 * 86_400 * config.US
    moved = tables.transactions(spark, sf_dir).withColumns({
        "card_id": (F.col("card_id").cast("bigint") % 4).cast("string"),
        "ts_us": F.col("ts_us") - F.col("ts_us") % ten_days,
    })
    out = velocity.card_history(moved, limit=100)
    return out.select(
        "transaction_id", "tx_count_10m", "tx_count_24h", money("total_amount_24h"),
        "unique_merchants_24h", "unique_merchants_since_idle", "time_since_last_tx",
        rounded_of(F.col("ema_before"), "ema_before", 4),
    )


@query
def asof_join_hot_keys(spark, sf_dir):
    """The as-of join with every user of more than 20 rows cut into pieces."""
    return _purchases_and_views(spark, sf_dir, limit=20)


@query
def asof_join_null_keys(spark, sf_dir):
    """The as-of join where every fifth event, on either side, has no user."""
    return _purchases_and_views(spark, sf_dir, keyless=True)


@query
def realtime_features(spark, sf_dir):
    out = features(spark, sf_dir)
    plain = [c for c in realtime.VECTOR if c not in {"amount_log", "merchant_risk_score", "merchant_fraud_rate"}]
    longs = {"hour_of_day", "day_of_week"}
    return out.select(
        "transaction_id",
        *[long(c) if c in longs else F.col(c) for c in plain],
        rounded("amount_log"), rounded("merchant_risk_score"), rounded("merchant_fraud_rate"),
        "unique_merchants_since_idle",
    )


# --- offline features ----------------------------------------------------------------------------


def _one_step(spark, sf_dir, step):
    return velocity.per_key(tables.transactions(spark, sf_dir), [step])


@query
def avg_last7(spark, sf_dir):
    out = _one_step(spark, sf_dir, offline.average_of_last())
    return out.select("transaction_id", rounded("avg_amt_7d"))


@query
def running_count(spark, sf_dir):
    out = _one_step(spark, sf_dir, offline.running_count())
    return out.select("transaction_id", "tx_count_24h")


@query
def running_distinct(spark, sf_dir):
    out = _one_step(spark, sf_dir, offline.running_distinct())
    return out.select("transaction_id", "unique_merchants_7d")


@query
def offline_time_true(spark, sf_dir):
    out = offline.time_true(tables.transactions(spark, sf_dir))
    return out.select(
        "transaction_id", rounded("avg_amt_7d"), "tx_count_24h", "unique_merchants_7d"
    )


@query
def time_true_hot_cards(spark, sf_dir):
    """The same with every card of more than 60 rows cut into pieces."""
    out = offline.time_true(tables.transactions(spark, sf_dir), limit=60)
    return out.select(
        "transaction_id", rounded("avg_amt_7d"), "tx_count_24h", "unique_merchants_7d"
    )


@query
def distance_from_home(spark, sf_dir):
    out = _one_step(spark, sf_dir, offline.home_location())
    return out.select("transaction_id", rounded_of(offline.distance_from_home(), "km"))


@query
def distance_from_last(spark, sf_dir):
    out = _one_step(spark, sf_dir, offline.previous_location())
    return out.select("transaction_id", rounded_of(offline.distance_from_last(), "km"))


def _offline_output(table: DataFrame) -> DataFrame:
    """Floats as doubles with three decimals: single precision has no more to offer."""
    floats = [
        "lat", "long", "merch_lat", "merch_long", "distance_from_home", "distance_from_last_tx",
    ]
    return table.select(
        "cc_num", F.unix_micros("event_timestamp").alias("event_us"), "amt", "category", "zip",
        "city_pop", "merchant", "gender", "age", rounded("avg_amt_7d"), "tx_count_24h",
        "unique_merchants_7d", "hour_of_day", "day_of_week",
        *[rounded_of(F.col(c).cast("double"), c, 2) for c in floats],
    )


@query
def offline_features(spark, sf_dir):
    return _offline_output(offline_table(spark, sf_dir))


@query
def offline_hot_cards(spark, sf_dir):
    """The same with every card of more than 60 rows cut into pieces."""
    return _offline_output(offline.offline_features(tables.card_rows(spark, sf_dir), limit=60))


@query
def sample_n(spark, sf_dir):
    """5,000 rows drawn after the features are computed."""
    out = _one_step(spark, sf_dir, offline.running_count())
    return offline.sample_n(out, 5000).select("transaction_id", "card_id", "tx_count_24h")


# --- feature store -----------------------------------------------------------------------------------


@query
def sample_half(spark, sf_dir):
    """Every second order line, exactly half of the table (rounded down): a sample that no single
    task could sort. Lines of one order share their key, so the cut may fall among them;
    the query shows what does not depend on which of them it takes."""
    lines = tables.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("order"), "l_quantity")
    drawn = offline.sample_n(lines, lines.count() // 2, key="order")
    per_order = drawn.groupBy("order").agg(F.count(F.lit(1)).alias("n"))
    return per_order.select("order", "n")


@query
def feature_view_check(spark, sf_dir):
    return VIEW.check(offline_table(spark, sf_dir))


def _purchases_and_views(
    spark, sf_dir, limit: int | None = None, keyless: bool = False
) -> DataFrame:
    """Purchases with the latest view of the same user, at most a day old."""
    events = tables.read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", scalars.epoch_us(F.col("ts")).alias("us")
    )
    if keyless:
        events = events.withColumn("user_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id")))
    spine = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "us")
    views = events.where(F.col("event_type") == "view").select(
        "user_id", "us", "value", F.col("event_id").alias("view_id")
    )
    return store.as_of_join(
        spine, views, "user_id", "us", "us", ["value", "view_id"], config.DAY_S, "view_id",
        limit=limit,
    )


@query
def asof_join(spark, sf_dir):
    return _purchases_and_views(spark, sf_dir)


@query
def historical_features(spark, sf_dir):
    """View references joined as of every transaction; a card never sees a later row."""
    spine = tables.transactions(spark, sf_dir).select(
        "transaction_id",
        F.col("card_id").cast("bigint").alias("cc_num"),
        F.timestamp_micros(F.col("ts_us") - 1).alias("event_timestamp"),
    )
    table = offline_table(spark, sf_dir).withColumnRenamed("transaction_id", "row_id")
    out = store.historical_features(
        spine, VIEW, table,
        ["transaction_features:amt", "transaction_features:tx_count_24h"], "row_id",
    )
    return out.select("transaction_id", "amt", "tx_count_24h")


def _event_view(name: str, key: str, days: float) -> FeatureView:
    fields = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("row_id", T.LongType())])
    return FeatureView(name, key, "event_timestamp", int(days * config.DAY_S), fields)


def _views(spark, sf_dir, limit: int | None = None) -> DataFrame:
    """Purchases with the latest view, click and signup of the same user and the latest error
    with the same code, each kind with a lifetime of its own; every fifth event has no user."""
    user = F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id")
    events = tables.read(spark, sf_dir, "events").select(
        "event_id", user, F.get_json_object("props", "$.k").cast("bigint").alias("code"),
        "event_type", "value", F.timestamp_micros(scalars.epoch_us(F.col("ts"))).alias("event_timestamp"),
    )
    spine = events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "code", "event_timestamp")
    sources = [
        (
            _event_view(kind, key, days),
            events.where(F.col("event_type") == kind).select(key, "event_timestamp", "value", F.col("event_id").alias("row_id")),
            "row_id",
        )
        for kind, key, days in (("view", "user_id", 1), ("click", "user_id", 0.25), ("signup", "user_id", 30), ("error", "code", 2))
    ]
    references = ["view:value", "click:value", "signup:row_id", "view:row_id", "error:value"]
    return store.historical_views(spine, sources, references, full_names=True, limit=limit).drop("event_timestamp")


@query
def historical_views(spark, sf_dir):
    return _views(spark, sf_dir)


@query
def historical_views_hot_keys(spark, sf_dir):
    """The same with every user and code of more than 20 rows cut into pieces."""
    return _views(spark, sf_dir, limit=20)


def _running(spark, sf_dir) -> DataFrame:
    return _one_step(spark, sf_dir, offline.running_count()).select(
        "card_id", "ts_us", "transaction_id", "merchant_id", money("amount"), "tx_count_24h"
    )


@query
def materialize(spark, sf_dir):
    rows = _running(spark, sf_dir)
    half = half_time(tables.transactions(spark, sf_dir))
    return store.materialize(rows, "card_id", "ts_us", "transaction_id", end=half)


@query
def materialize_incremental(spark, sf_dir):
    """First half published, second half merged; equals one full run."""
    rows = _running(spark, sf_dir)
    half = half_time(tables.transactions(spark, sf_dir))
    first = store.materialize(rows, "card_id", "ts_us", "transaction_id", end=half)
    second = store.materialize(rows, "card_id", "ts_us", "transaction_id", start=half)
    return store.upsert_latest(first, second, "card_id", "ts_us", "transaction_id")


@query
def upsert_card_features(spark, sf_dir):
    """The same through stored versions of the published table."""
    rows = _running(spark, sf_dir)
    before = F.col("ts_us") < half_time(tables.transactions(spark, sf_dir))
    table = writers.VersionedTable(
        spark, shared_dir(spark), "card_id", "ts_us", "transaction_id"
    )
    for version, part in enumerate([before, ~before]):
        table.upsert(rows.where(part), version)
    return table.read()


@query
def lookup_merchant(spark, sf_dir):
    """Every ninth transaction asks for a merchant that the table does not have."""
    unknown = F.col("transaction_id").cast("bigint") % 9 == 0
    asked = tables.transactions(spark, sf_dir).withColumn(
        "merchant_id",
        F.when(unknown, F.concat(F.lit("x"), "merchant_id")).otherwise(F.col("merchant_id")),
    )
    out = store.lookup_merchant(asked, merchants(spark, sf_dir))
    return out.select(
        "transaction_id", rounded("merchant_risk_score"), rounded("merchant_fraud_rate"),
        "merchant_total_transactions",
    )


CARD_COLUMNS = [
    "card_tx_count_10m", "card_tx_count_1h", "card_tx_count_24h",
    "card_unique_merchants_24h", "card_last_tx_timestamp", "card_is_new_card",
]


def _card_lookup(spark, sf_dir) -> DataFrame:
    """Customers as cards: those with transactions have a row, all others do not."""
    cards = tables.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("card_id"),
        F.concat(F.lit("m"), F.col("c_custkey") % 120).alias("merchant_id"),
    )
    return store.lookup_all(cards, card_table(spark, sf_dir), merchants(spark, sf_dir))


@query
def lookup_card(spark, sf_dir):
    cards = tables.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("card_id")
    )
    out = store.lookup_card(cards, card_table(spark, sf_dir))
    return out.select(
        "card_id", *CARD_COLUMNS, rounded("card_total_amount_24h"),
        rounded("card_avg_tx_amount_30d", 4),
    )


@query
def lookup_all(spark, sf_dir):
    out = _card_lookup(spark, sf_dir)
    return out.select(
        "card_id", *CARD_COLUMNS, rounded("card_total_amount_24h"),
        rounded("merchant_risk_score"), "merchant_total_transactions",
    )


@query
def online_features(spark, sf_dir):
    """Published fields for all customers at the end of February, ten days' lifetime."""
    from dataclasses import replace

    keys = tables.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cc_num"))
    out = store.online_features(
        keys,
        published_offline(spark, sf_dir),
        replace(VIEW, ttl_seconds=10 * config.DAY_S),
        [f"transaction_features:{c}" for c in ("amt", "merchant", "tx_count_24h")],
        F.lit("2024-02-09 00:00:00").cast("timestamp"),
        {"current_amt": 600.0, "current_merchant": "m1"},
    )
    return out.select("cc_num", "amt", "merchant", "tx_count_24h", "current_amt", "current_merchant")


@query
def training_set(spark, sf_dir):
    out = store.training_set(tables.transactions(spark, sf_dir))
    return out.select(
        "transaction_id", "card_id", "is_fraud", "tx_count", rounded("avg_amount"),
        "last_tx_timestamp", "unique_merchants",
    )


@query
def request_features(spark, sf_dir):
    out = realtime.service_inputs(
        tables.transactions(spark, sf_dir), published_offline(spark, sf_dir)
    )
    return out.select(
        "transaction_id", rounded("amt_ratio_to_avg"), "is_high_value", "is_same_merchant",
        rounded("velocity_score"),
    )


# --- scoring and prediction log -------------------------------------------------------------------------


@query
def model_features(spark, sf_dir):
    out = realtime.score_inputs(features(spark, sf_dir))
    exact = {"hour_of_day", "day_of_week", "tx_count_10m", "tx_count_1h", "tx_count_24h",
             "unique_merchants_24h", "merchant_category_hash", "time_since_last_tx",
             "is_new_card", "is_weekend"}
    return out.select(
        "transaction_id",
        *[long(c) if c in exact else rounded(c, 4) for c in scoring.MODEL_COLUMNS],
    )


@query
def rule_score_a(spark, sf_dir):
    out = scored(spark, sf_dir)
    return out.select("transaction_id", "fraud_probability")


@query
def rule_score_b(spark, sf_dir):
    out = realtime.service_score(
        tables.transactions(spark, sf_dir), published_offline(spark, sf_dir)
    )
    return out.select("transaction_id", "fraud_probability")


@query
def rule_score_c(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    return tx.select(
        "transaction_id", scoring.rule_score_c(F.col("amount")).alias("fraud_probability")
    )


@query
def decisions(spark, sf_dir):
    out = scored(spark, sf_dir)
    return out.select("transaction_id", "risk_level", "decision")


@query
def binary_decision(spark, sf_dir):
    out = realtime.service_score(
        tables.transactions(spark, sf_dir), published_offline(spark, sf_dir)
    )
    return out.groupBy("decision").agg(
        F.count(F.lit(1)).alias("n_transactions"), F.max("fraud_probability").alias("max_score")
    )


@query
def score_summary(spark, sf_dir):
    out = scoring.score_summary(scored(spark, sf_dir))
    return out.select("n_transactions", "n_blocked", "n_review", rounded("avg_probability"))


@query
def model_score(spark, sf_dir):
    """A logistic model of fixed weights, one of them for a column that is not there."""
    inputs = realtime.score_inputs(features(spark, sf_dir))
    out = scoring.model_score(inputs, FIXED_MODEL)
    decided = scoring.decide(out, F.round("model_probability", 6))
    return decided.select(
        "transaction_id", rounded("model_probability"), "model_probability_source", "risk_level", "decision"
    )


class Refusing:
    """A model that takes no batch."""

    def predict_proba(self, matrix):
        raise ValueError("the matrix has another shape")


@query
def model_fallback(spark, sf_dir):
    """Every batch is refused: the rules score, and the source says so."""
    out = scoring.model_score(realtime.score_inputs(features(spark, sf_dir)), Refusing())
    return out.select("transaction_id", "model_probability", "model_probability_source")


@query
def label_predictions(spark, sf_dir):
    """The log after labels came in for two of three transactions."""
    return predictions.with_labels(prediction_log(spark, sf_dir), late_labels(spark, sf_dir)).select(
        "transaction_id", "decision", "actual_label"
    )


def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = tables.transactions(spark, sf_dir).where(F.col("transaction_id").cast("bigint") % 3 != 0)
    return tx.select("transaction_id", F.col("is_fraud").alias("actual_label"))


@query
def log_metrics(spark, sf_dir):
    """Detection metrics from the labelled rows of the log."""
    log = predictions.with_labels(prediction_log(spark, sf_dir), late_labels(spark, sf_dir))
    out = monitoring.confusion(predictions.labelled(log), ALERT_THRESHOLD)
    return out.select(
        "true_positives", "false_positives", "false_negatives", "true_negatives",
        rounded("precision"), rounded("recall"), rounded("false_positive_rate"),
    )


@query
def recent_by_card(spark, sf_dir):
    """The newest ten predictions of one card, that of the first user."""
    out = predictions.recent_predictions(prediction_log(spark, sf_dir), 10, "1")
    return out.select("transaction_id", "card_id", "amount", "risk_level")


@query
def store_predictions(spark, sf_dir):
    log = prediction_log(spark, sf_dir)
    return log.select(
        "transaction_id", "card_id", "amount", "merchant_id", "merchant_category",
        "fraud_probability", "risk_level", "decision", "model_version", "actual_label",
        F.unix_micros("created_at").alias("created_us"),
        F.get_json_object("features_json", "$.tx_count_10m").cast("bigint").alias("tx_count_10m"),
    )


@query
def get_prediction(spark, sf_dir):
    """Written to the stored log, read back by id."""
    log = writers.PredictionLog(spark, shared_dir(spark))
    log.append(prediction_log(spark, sf_dir), 0)
    found = predictions.get_prediction(log.read(), "77", "tx_count_10m bigint, is_new_card int")
    return found.select(
        "transaction_id", "card_id", "amount", "decision", "features.tx_count_10m",
        "features.is_new_card",
    )


@query
def recent_predictions(spark, sf_dir):
    newest = predictions.recent_predictions(prediction_log(spark, sf_dir), 100)
    return newest.select("transaction_id", "card_id", "amount", "risk_level")


@query
def prediction_stats(spark, sf_dir):
    out = predictions.statistics(prediction_log(spark, sf_dir))
    return out.select("kind", "value", "n_predictions", rounded("avg_probability"))


# --- data quality --------------------------------------------------------------------------------------------


@query
def dq_report(spark, sf_dir):
    """Stored state with faults: one in 1,000 members is broken in one of four ways,
    and every tenth card has bad statistics."""
    tx = tables.transactions(spark, sf_dir)
    n = F.col("transaction_id").cast("bigint") % 1000
    members = messages.history_members(tx)
    value = (
        F.when(n == 1, F.lit("not json"))
        .when(n == 2, F.regexp_replace("value", '"amount":', '"amount":-'))
        .when(n == 3, F.regexp_replace("value", '"amount":[0-9.]+,', ""))
        .otherwise(F.col("value"))
    )
    score = F.when(n == 4, F.col("score") + 1).otherwise(F.col("score"))
    history = members.withColumns({"value": value, "score": score})
    card = F.col("card_id").cast("bigint")
    stats = card_table(spark, sf_dir).select(
        "card_id",
        F.when(card % 10 == 3, "abc").when(card % 10 == 4, "-1.5")
        .otherwise(F.col("avg_tx_amount_30d").cast("string")).alias("avg_amount"),
        F.when(card % 10 == 5, "12.5.1").when(card % 10 == 6, "946684799")
        .otherwise(F.col("last_tx_timestamp").cast("string")).alias("last_tx_timestamp"),
    )
    return quality.state_report(history, tx, stats)


@query
def feature_sanity(spark, sf_dir):
    return quality.feature_sanity(features(spark, sf_dir))


@query
def parity_report(spark, sf_dir):
    """Offline columns as coded and as named, against the real-time ones."""
    tx = tables.transactions(spark, sf_dir)
    true = offline.time_true(tx).select(
        "transaction_id", F.col("tx_count_24h").alias("count_true")
    )
    coded = _one_step(spark, sf_dir, offline.running_count()).select(
        "transaction_id", F.col("tx_count_24h").alias("count_coded")
    )
    left = true.join(coded, "transaction_id")
    online = velocity.velocity_counts(tx).select(
        "transaction_id",
        (F.col("tx_count_24h") + 1).alias("count_true"),
        (F.col("tx_count_24h") + 1).alias("count_coded"),
    )
    return quality.parity_report(left, online, "transaction_id", ["count_true", "count_coded"])


@query
def leakage_check(spark, sf_dir):
    return quality.leakage_check(_purchases_and_views(spark, sf_dir), "us", "feature_time")


@query
def run_metrics(spark, sf_dir):
    out = quality.run_metrics(clean.clean(tables.raw_messages(spark, sf_dir)))
    return out.select(
        "n_processed", "n_failed", rounded_of(F.col("success_percent"), "success_percent"),
        rounded("avg_amount"),
    )


# --- profiles and monitoring ------------------------------------------------------------------------------------

ALERT_THRESHOLD = 0.15


@query
def merchant_risk(spark, sf_dir):
    out = monitoring.merchant_risk(tables.transactions(spark, sf_dir))
    return out.select(
        "merchant_id", "total_transactions", rounded("fraud_rate"), rounded("risk_score")
    )


@query
def user_history(spark, sf_dir):
    out = monitoring.user_history(tables.transactions(spark, sf_dir))
    return out.select("card_id", rounded("avg_amount"), "n_transactions", "favourite_merchants")


@query
def geo_patterns(spark, sf_dir):
    out = monitoring.geo_patterns(tables.transactions(spark, sf_dir))
    return out.select("lat_cell", "lon_cell", "n_transactions", rounded("fraud_rate"))


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    tx = tables.transactions(spark, sf_dir)
    half = F.col("ts_us") < half_time(tx)
    return tx.where(half), tx.where(~half)


@query
def psi(spark, sf_dir):
    expected, actual = _halves(spark, sf_dir)
    return monitoring.psi(expected, actual, "amount").select(rounded("psi"))


PSI_COLUMNS = [
    "amount", "amount_log", "tx_count_10m", "tx_count_1h", "tx_count_24h", "total_amount_24h",
    "unique_merchants_24h", "time_since_last_tx", "hour_of_day", "merchant_fraud_rate",
]


@query
def psi_features(spark, sf_dir):
    """Drift of ten features between the halves, in one pass."""
    rows = features(spark, sf_dir)
    half = F.col("ts_us") < half_time(tables.transactions(spark, sf_dir))
    out = monitoring.psi_features(rows.where(half), rows.where(~half), PSI_COLUMNS)
    return out.select("feature", rounded("psi"))


DRIFT_COLUMNS = ["amount", "lat", "lon"]


@query
def psi_daily(spark, sf_dir):
    """Drift of every day of the second half against the first, from stored histograms alone: the
    first half is read once, when they are made."""
    path = shared_dir(spark)
    expected, actual = _halves(spark, sf_dir)
    fixed = cut_lineage(distributions.edges(expected, DRIFT_COLUMNS))
    for name, side in (("expected", expected), ("actual", actual)):
        distributions.histograms(side, fixed, DRIFT_COLUMNS).write.parquet(f"{path}/{name}")
    out = distributions.drift_by_day(*[spark.read.parquet(f"{path}/{n}") for n in ("expected", "actual")])
    return out.select("feature", F.date_format("day", "yyyy-MM-dd").alias("day"), "n", rounded("psi"))


@query
def windowed_metrics(spark, sf_dir):
    out = monitoring.windowed_metrics(scored(spark, sf_dir), ALERT_THRESHOLD)
    return out.select("metric", "window_us", rounded("value"), "alert")


@query
def confusion_metrics(spark, sf_dir):
    out = monitoring.confusion(scored(spark, sf_dir), ALERT_THRESHOLD)
    return out.select(
        "true_positives", "false_positives", "false_negatives", "true_negatives",
        rounded("precision"), rounded("recall"), rounded("false_positive_rate"),
    )


@query
def pr_auc(spark, sf_dir):
    out = monitoring.pr_auc(scored(spark, sf_dir))
    return out.select(rounded("pr_auc"), rounded("precision_at_95_recall"))


@query
def pr_auc_model(spark, sf_dir):
    """The same from the scores of a logistic model, which are continuous: no two need be equal."""
    inputs = realtime.score_inputs(features(spark, sf_dir))
    out = scoring.model_score(inputs, FIXED_MODEL).withColumn("fraud_probability", F.col("model_probability"))
    return monitoring.pr_auc(out).select(rounded("pr_auc"), rounded("precision_at_95_recall"))


@query
def windowed_metrics_model(spark, sf_dir):
    inputs = realtime.score_inputs(features(spark, sf_dir))
    out = scoring.model_score(inputs, FIXED_MODEL).withColumn("fraud_probability", F.col("model_probability"))
    out = monitoring.windowed_metrics(out, ALERT_THRESHOLD)
    return out.select("metric", "window_us", rounded("value"), "alert")


@query
def business_metrics(spark, sf_dir):
    out = monitoring.business_metrics(
        scored(spark, sf_dir).withColumn("amount", F.col("amount").cast("decimal(18,2)")),
        ALERT_THRESHOLD,
    )
    return out.select(rounded("customer_friction_rate"), "prevented_loss", "fraud_loss")


@query
def alerts(spark, sf_dir):
    expected, actual = _halves(spark, sf_dir)
    out = monitoring.alerts(
        monitoring.psi(expected, actual, "amount"),
        monitoring.pr_auc(scored(spark, sf_dir)),
        0.62,
    )
    return out.select(rounded("psi"), rounded("pr_auc"), "drift_alert", "pr_auc_alert")


@query
def class_weight(spark, sf_dir):
    out = monitoring.class_weight(tables.transactions(spark, sf_dir))
    return out.select("n_negative", "n_positive", rounded("positive_weight"))


@query
def audit_log(spark, sf_dir):
    return monitoring.audit_log(scored(spark, sf_dir))


def point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = tables.transactions(spark, sf_dir)
    return realtime.point_in_time(velocity.card_history(tx), monitoring.merchant_risk_history(tx))


@query
def training_leakage(spark, sf_dir):
    """Rows of the training frame, those with a known merchant, and those that know it from
    their own day or later."""
    rows = point_in_time(spark, sf_dir)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("feature_time").alias("n_hits"),
        F.count_if(F.col("feature_time") > F.col("ts_us")).alias("n_leaks"),
    )


@query
def train_model(spark, sf_dir):
    """Boosted trees on point-in-time inputs; average precision on the later rows."""
    _, test, importance = training.train(realtime.score_inputs(point_in_time(spark, sf_dir)))
    top = importance.orderBy(F.desc("importance")).limit(1).select("feature").scalar()
    return monitoring.pr_auc(test).withColumn("top_feature", top)


@query
def model_score_trained(spark, sf_dir):
    """Boosted trees are trained and stored, read again as arrays, and score every transaction;
    the scores of the trained model itself differ nowhere."""
    rows = cut_lineage(realtime.score_inputs(point_in_time(spark, sf_dir)))
    model, _, _ = training.train(rows, iterations=5)
    path = shared_dir(spark)
    training.save(model, path)
    stored = scoring.model_score(rows, training.load(spark, path))
    own = model.transform(training.assembled(stored, scoring.MODEL_COLUMNS, "is_fraud"))
    apart = F.abs(vector_to_array("probability")[1] - F.col("model_probability"))
    return own.agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(~(apart < 1e-9)).alias("n_different"),
        F.count_if(F.col("model_probability_source") != "model").alias("n_by_rules"),
        F.count_if(~F.col("model_probability").between(0, 1)).alias("n_out_of_range"),
    )
