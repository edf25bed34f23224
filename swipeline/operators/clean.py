"""Validation with a dead-letter path, and removal of copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from swipeline import config
from swipeline.functions import cleaning, scalars
from swipeline.schemas import CORRUPT


def validate_required(messages: DataFrame) -> DataFrame:
    """Adds `missing_fields`, '' when the contract is met."""
    return messages.withColumn("missing_fields", cleaning.missing_fields())


def fill_optional(messages: DataFrame) -> DataFrame:
    present = [n for n in config.OPTIONAL_DEFAULTS if n in messages.columns]
    absent = [n for n in config.OPTIONAL_DEFAULTS if n not in messages.columns]
    return messages.withColumns(
        {n: cleaning.optional(n) for n in present}
        | {n: F.lit(config.OPTIONAL_DEFAULTS[n]) for n in absent}
    )


def clean(messages: DataFrame) -> DataFrame:
    """Typed transactions with a nullable `reject_reason`.

    One projection without a shuffle, so it runs on batch and streaming frames.
    Columns outside the contract pass through.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in messages.columns else None
    # Parsed once, next to the text: the reason needs both. The parsing is a projection of its own,
    # which is compiled; passing its columns through inline() keeps the optimizer from copying
    # it into the reject filter.
    values = {
        "_lat": cleaning.coordinate(F.col("location_lat")),
        "_lon": cleaning.coordinate(F.col("location_lon")),
        "_value": cleaning.amount(F.col("amount")),
        "_seconds": cleaning.epoch_seconds(F.col("timestamp")),
    }
    read = messages.select(*messages.columns, *[c.alias(f"_read{n}") for n, c in values.items()])
    parsed = read.select(
        *messages.columns,
        F.inline(F.array(F.struct(*[F.col(f"_read{n}").alias(n) for n in values]))),
    )
    flagged = parsed.withColumn(
        "reject_reason",
        cleaning.reject_reason(
            F.col("amount"), F.col("_value"), F.col("_seconds"),
            F.col("location_lat"), F.col("_lat"), F.col("location_lon"), F.col("_lon"), corrupt,
        ),
    )
    typed = flagged.withColumns(
        {
            "amount": F.col("_value"),
            "timestamp": F.col("_seconds"),
            "location_lat": F.col("_lat"),
            "location_lon": F.col("_lon"),
        }
    ).drop("_lat", "_lon", "_value", "_seconds")
    return fill_optional(typed)


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the dead letters with their reason."""
    return (
        cleaned.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        cleaned.where(F.col("reject_reason").isNotNull()),
    )


def accepted(messages: DataFrame) -> DataFrame:
    return split_rejects(clean(messages))[0]


def to_features_input(cleaned: DataFrame) -> DataFrame:
    """Accepted messages in the shape the feature operators read."""
    return cleaned.select(
        "transaction_id",
        "card_id",
        "merchant_id",
        "merchant_category",
        "amount",
        (F.col("timestamp") * config.US).alias("ts_us"),
        F.col("location_lat").alias("lat"),
        F.col("location_lon").alias("lon"),
    )


def reject_report(cleaned: DataFrame) -> DataFrame:
    """Rows per outcome."""
    return cleaned.groupBy(
        F.coalesce(F.col("reject_reason"), F.lit("accepted")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    An aggregate, not a window: copies of one key collapse before the shuffle,
    so a key with very many copies does no harm.
    """
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("first_row")
    )
    return first.select(key, "first_row.*").select(*df.columns)


def dedup_transactions(transactions: DataFrame) -> DataFrame:
    """One row per transaction id: the earliest, then the smallest in every field."""
    order = [F.col("timestamp")] + [
        F.col(c) for c in transactions.columns if c not in ("transaction_id", "timestamp")
    ]
    return first_per_key(transactions, "transaction_id", order)


def clip_at_percentile(
    df: DataFrame, column: str = "amount", percent: float = config.CLIP_PERCENTILE
) -> DataFrame:
    """Clip a money column at its exact percentile (nearest rank).

    Rows are first counted per cent value. The rank is then located in two
    steps - among coarse steps of the value, and among the values of one step -
    so no sort sees more than a small part of the distinct values.
    """
    cents = (F.col(column).cast("decimal(18,2)") * 100).cast("bigint")
    counts = df.where(F.col(column).isNotNull()).groupBy(cents.alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # monotone steps, finer than 1.1 % of the value: at most about 4,000 of them
    step = F.floor(F.log2(F.greatest(F.col("v"), F.lit(0)) + 1.0) * 64)
    steps = counts.groupBy(step.alias("step")).agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    rank = F.greatest(F.lit(1), F.ceil(total * F.lit(percent / 100.0)))
    cut_step = _cut(steps, "step", rank, "n", F.lit(0))
    values = counts.where(step == cut_step.select("step").scalar())
    cut = _cut(values, "v", rank, "n", cut_step.select("before").scalar())
    limit = (cut.select("v").scalar() / 100).cast("decimal(18,2)")
    return df.withColumn(f"{column}_clipped", F.least(F.col(column), limit))


def _cut(counts: DataFrame, value: str, rank: Column, n: str, offset: Column) -> DataFrame:
    """The first value whose running count reaches `rank`, with the count before it."""
    from pyspark.sql import Window

    running = F.sum(n).over(Window.orderBy(value)) + offset
    return (
        counts.withColumn("upto", running)
        .where(F.col("upto") >= rank)
        .orderBy(value)
        .limit(1)
        .select(value, (F.col("upto") - F.col(n)).alias("before"))
    )
