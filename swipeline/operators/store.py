"""Feature store work: as-of joins, publishing, lookups, request features."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from swipeline import config
from swipeline.operators.hot import UP, Cuts, Step, per_key, running
from swipeline.schemas import FeatureView


class Served(NamedTuple):
    """A feature table of an as-of join: its time in microseconds, the columns it serves, how
    long they last, and the column whose largest value wins among rows of one time."""

    features: DataFrame
    time: str
    columns: Sequence[str]
    ttl_seconds: int
    tie: str


def as_of_views(
    spine: DataFrame, key: str, spine_time: str, tables: Sequence[Served], limit: int | None = None
) -> DataFrame:
    """Each spine row with the latest row of every table at or before its time.

    The result is the spine's columns and one struct per table, `_view0`, `_view1`, ..., of
    `feature_time` and the table's columns; a row that is older than its table's lifetime gives a
    null. A null key equals no other: such spine rows get nulls, and such features serve nobody.
    The spine and all tables go through one exchange as one union, in which one scan carries
    the last row of each table on; no range join, no pairs. The number of tables sets the
    width of that scan's state and not the number of exchanges or sorts.
    """
    keyless = spine.where(F.col(key).isNull())
    names = [f"_view{i}" for i in range(len(tables))]
    both = spine.where(F.col(key).isNotNull()).select(
        F.col(key),
        F.col(spine_time).alias("_at"),
        # behind the features of its moment, spread over the pieces of a hot one
        F.concat(F.lit("1"), F.hex(F.xxhash64(*spine.columns))).alias("_tie"),
        F.struct(*spine.columns).alias("_spine"),
    )
    for name, table in zip(names, tables):
        payload = F.struct(F.col(table.time).alias("feature_time"), *table.columns)
        rows = table.features.where(F.col(key).isNotNull()).select(
            F.col(key),
            F.col(table.time).alias("_at"),
            F.concat(F.lit("0"), F.col(table.tie).cast("string")).alias("_tie"),
            payload.alias(f"{name}_row"),
        )
        both = both.unionByName(rows, allowMissingColumns=True)
    order = ["_at", "_tie"]

    def card(df: DataFrame) -> DataFrame:
        upto = Window.partitionBy(key).orderBy(*order).rowsBetween(UP, 0)
        return df.withColumns(
            {n: F.last(f"{n}_row", ignorenulls=True).over(upto) for n in names}
        )

    def hot(df: DataFrame, cuts: Cuts) -> DataFrame:
        scanned = running(df, key, order, lasts={n: F.col(f"{n}_row") for n in names})
        return scanned.select(*df.columns, *names)

    found = per_key(both, [Step(names, hot, card=card)], key=key, at="_at", limit=limit, tie="_tie")

    def fresh(name: str, table: Served) -> Column:
        age = F.col("_at") - F.col(f"{name}.feature_time")
        return F.when(age <= table.ttl_seconds * config.US, F.col(name)).alias(name)

    joined = found.where(F.col("_spine").isNotNull()).select(
        "_spine.*", *[fresh(n, t) for n, t in zip(names, tables)]
    )
    kinds = {f.name: f.dataType for f in joined.schema.fields}
    nulls = {n: F.lit(None).cast(kinds[n]) for n in names}
    return joined.unionByName(keyless.withColumns(nulls).select(*joined.columns))


def as_of_join(
    spine: DataFrame,
    features: DataFrame,
    key: str,
    spine_time: str,
    feature_time: str,
    columns: Sequence[str],
    ttl_seconds: int,
    tie: str,
    limit: int | None = None,
) -> DataFrame:
    """Each spine row with the latest feature row at or before its time.

    Times are epoch microseconds. A feature older than the lifetime gives nulls.
    Among feature rows of one time the largest `tie` wins.
    """
    table = Served(features, feature_time, columns, ttl_seconds, tie)
    joined = as_of_views(spine, key, spine_time, [table], limit)
    return joined.select(
        *spine.columns, *[F.col(f"_view0.{c}").alias(c) for c in ("feature_time", *columns)]
    )


def historical_features(
    spine: DataFrame, view: FeatureView, table: DataFrame, references: list[str], tie: str
) -> DataFrame:
    """`view:field` references joined to the spine as of its `event_timestamp`."""
    return historical_views(spine, [(view, table, tie)], references)


def historical_views(
    spine: DataFrame,
    sources: Sequence[tuple[FeatureView, DataFrame, str]],
    references: Sequence[str],
    full_names: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """`view:field` references of several views joined to the spine as of `event_timestamp`.

    `sources` are (view, table, tie). Each view has its own lifetime. Views that share a key are
    served by one scan of the spine; each further key is one more. Columns come in the
    order of the references, named by their field, or `view__field` with `full_names`; two of one
    name are an error, as are a view or field that is not known.
    """
    views = {view.name: (view, table, tie) for view, table, tie in sources}
    wanted: dict[str, list[str]] = {}
    for reference in references:
        name = reference.partition(":")[0]
        if name not in views:
            raise ValueError(f"unknown feature {reference}")
        wanted.setdefault(name, []).extend(views[name][0].select([reference]))
    label = lambda r: r.replace(":", "__") if full_names else r.partition(":")[2]
    labels = [label(r) for r in references]
    if len({*labels, *spine.columns}) < len(labels) + len(spine.columns):
        raise ValueError("two columns would have one name: ask for full names")
    by_key: dict[str, list[str]] = {}
    for name in wanted:
        by_key.setdefault(views[name][0].key, []).append(name)
    out = spine.withColumn("_spine_us", F.unix_micros("event_timestamp"))
    for key, names in by_key.items():
        tables = []
        for name in names:
            view, table, tie = views[name]
            source = table.withColumn("_feature_us", F.unix_micros(view.event_time))
            tables.append(Served(source, "_feature_us", list(dict.fromkeys(wanted[name])), view.ttl_seconds, tie))
        joined = as_of_views(out, key, "_spine_us", tables, limit)
        # kept apart until the end: another key's scan goes by the same names
        out = joined.withColumnsRenamed({f"_view{i}": f"_of_{name}" for i, name in enumerate(names)})
    return out.select(
        *spine.columns,
        *[F.col("_of_" + r.replace(":", ".")).alias(name) for r, name in zip(references, labels)],
    )


def materialize(
    features: DataFrame,
    key: str,
    time: str,
    tie: str,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """The latest row of every key within [start, end).

    A plain aggregate: rows of one key are combined before the shuffle.
    """
    rows = features
    if start is not None:
        rows = rows.where(F.col(time) >= start)
    if end is not None:
        rows = rows.where(F.col(time) < end)
    rest = [c for c in features.columns if c != key]
    latest = rows.groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct(time, tie)).alias("latest")
    )
    return latest.select(key, "latest.*").select(*features.columns)


def upsert_latest(
    published: DataFrame, updates: DataFrame, key: str, time: str, tie: str
) -> DataFrame:
    """Published table after the updates: the newer row of every key."""
    return materialize(published.unionByName(updates), key, time, tie)


def with_defaults(
    rows: DataFrame, table: DataFrame, key: str, defaults: dict[str, object], prefix: str = ""
) -> DataFrame:
    """Left join on the key; a missing row or field takes the default and its type.

    No broadcast hint: the table may be large, so its measured size decides, and
    a hot key of the row side is split by the skew join.
    """
    types = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    narrow = table.select(
        key, *[F.col(c).alias(f"_t_{c}") for c in defaults if c in table.columns]
    )
    joined = rows.join(narrow, key, "left")
    filled = {
        prefix + c: F.coalesce(
            F.col(f"_t_{c}").try_cast(types[type(d)]) if c in table.columns else F.lit(None),
            F.lit(d),
        ).cast(types[type(d)])
        for c, d in defaults.items()
    }
    return joined.withColumns(filled).select(*rows.columns, *filled)


def lookup_merchant(rows: DataFrame, merchants: DataFrame, prefix: str = "merchant_") -> DataFrame:
    return with_defaults(rows, merchants, "merchant_id", config.MERCHANT_DEFAULTS, prefix)


def lookup_card(rows: DataFrame, cards: DataFrame, prefix: str = "card_") -> DataFrame:
    return with_defaults(rows, cards, "card_id", config.CARD_DEFAULTS, prefix)


def lookup_all(rows: DataFrame, cards: DataFrame, merchants: DataFrame) -> DataFrame:
    return lookup_merchant(lookup_card(rows, cards), merchants)


def card_snapshot(history: DataFrame) -> DataFrame:
    """`card_history` rows as the table of latest card features.

    Everything is what the next transaction of the same moment would read: counts,
    sums and merchants include the row itself. A merchant is counted if the card's
    latest visit to it lies in the last day, which needs no order and no window.
    """
    amount = F.col("amount").cast("double")
    rows = history.select(
        "card_id",
        *[
            (F.col(f"tx_count_{w}") + 1).alias(f"tx_count_{w}")
            for w in config.VELOCITY_WINDOWS
        ],
        *[
            (F.col(f"total_amount_{w}") + amount).alias(f"total_amount_{w}")
            for w in config.VELOCITY_WINDOWS
        ],
        (
            F.lit(1 - config.EMA_ALPHA) * F.col("ema_before")
            + F.lit(config.EMA_ALPHA) * amount
        ).alias("avg_tx_amount_30d"),
        F.floor(F.col("ts_us") / config.US).alias("last_tx_timestamp"),
        F.lit(0).alias("is_new_card"),
        "merchant_id",
        "ts_us",
        "transaction_id",
    )
    latest = materialize(rows, "card_id", "ts_us", "transaction_id")
    visits = history.groupBy("card_id", "merchant_id").agg(F.max("ts_us").alias("visit_us"))
    recent = (
        visits.select("card_id", "visit_us")
        .join(latest.select("card_id", "ts_us"), "card_id")
        .where(F.col("visit_us") >= F.col("ts_us") - config.DAY_S * config.US)
        .groupBy("card_id")
        .agg(F.count(F.lit(1)).alias("unique_merchants_24h"))
    )
    return latest.join(recent, "card_id")


def online_features(
    keys: DataFrame,
    published: DataFrame,
    view: FeatureView,
    references: list[str],
    request_time: Column,
    request: dict[str, object] | None = None,
) -> DataFrame:
    """Latest published fields for many keys; rows past their lifetime give nulls.

    `request` holds one set of request columns, repeated for every key.
    """
    columns = view.select(references)
    narrow = published.select(view.key, view.event_time, *columns)
    joined = keys.join(narrow, view.key, "left")
    fresh = F.unix_micros(request_time) - F.unix_micros(view.event_time) <= (
        view.ttl_seconds * config.US
    )
    out = joined.withColumns({c: F.when(fresh, F.col(c)) for c in columns})
    for name, value in (request or {}).items():
        out = out.withColumn(name, F.lit(value))
    return out.drop(view.event_time)


def request_features(rows: DataFrame) -> DataFrame:
    """On-demand features from the current request and the published ones.

    velocity_score is transactions per hour over the 24-hour count;
    is_same_merchant compares with the last published merchant.
    """
    avg = F.col("avg_amt_7d")
    return rows.withColumns(
        {
            "amt_ratio_to_avg": F.when(avg > 0, F.col("current_amt") / avg).otherwise(F.lit(1.0)),
            "is_high_value": (F.col("current_amt") > config.HIGH_VALUE_AMOUNT).cast("int"),
            "is_same_merchant": F.coalesce(
                (F.col("current_merchant") == F.col("merchant")).cast("int"), F.lit(0)
            ),
            "velocity_score": F.coalesce(F.col("tx_count_24h") / F.lit(24.0), F.lit(0.0)),
        }
    )


def training_snapshot(transactions: DataFrame) -> DataFrame:
    """One row per card: transactions, mean amount, last time, distinct merchants."""
    per_merchant = transactions.groupBy("card_id", "merchant_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("total"),
        F.max("ts_us").alias("last_us"),
    )
    return per_merchant.groupBy("card_id").agg(
        F.sum("n").alias("tx_count"),
        (F.sum("total").cast("double") / F.sum("n")).alias("avg_amount"),
        F.floor(F.max("last_us") / config.US).alias("last_tx_timestamp"),
        F.count(F.lit(1)).alias("unique_merchants"),
    )


def training_set(transactions: DataFrame, labels: Sequence[str] = ("is_fraud",)) -> DataFrame:
    """Every labelled transaction with the snapshot of its card.

    The snapshot knows the future; use `historical_features` to train in earnest.
    """
    rows = transactions.select("transaction_id", "card_id", *labels)
    return rows.join(training_snapshot(transactions), "card_id", "left")
