"""Declared schemas and the feature view."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

# Card data set as delivered (CSV with a header).
CARD_CSV = T.StructType(
    [
        T.StructField("trans_num", T.StringType()),
        T.StructField("cc_num", T.LongType()),
        T.StructField("trans_date_trans_time", T.StringType()),
        T.StructField("amt", T.DoubleType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("long", T.DoubleType()),
        T.StructField("merch_lat", T.DoubleType()),
        T.StructField("merch_long", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.LongType()),
        T.StructField("city_pop", T.LongType()),
        T.StructField("dob", T.StringType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

# Raw message: every field arrives as text, so a bad value becomes a reject
# reason instead of a failed job.
MESSAGE_FIELDS = [
    "transaction_id", "card_id", "user_id", "amount", "merchant_id", "merchant_category",
    "timestamp", "location_lat", "location_lon", "city", "state", "zip", "job", "dob",
    "is_fraud", "first_name", "last_name", "gender", "city_pop", "merchant_lat", "merchant_lon",
]
CORRUPT = "_corrupt_record"
MESSAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in [*MESSAGE_FIELDS, CORRUPT]]
)

HISTORY = T.StructType(
    [
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


@dataclass(frozen=True)
class FeatureView:
    """A keyed, time-stamped feature table with a lifetime."""

    name: str
    key: str
    event_time: str
    ttl_seconds: int
    fields: T.StructType
    path: str | None = None
    tags: dict[str, str] = field(default_factory=dict)

    def select(self, references: list[str]) -> list[str]:
        """`view:field` references as column names; unknown ones are an error."""
        known = set(self.fields.names)
        names = []
        for reference in references:
            view, _, name = reference.partition(":")
            if view != self.name or name not in known:
                raise ValueError(f"unknown feature {reference}")
            names.append(name)
        return names

    def schema_differences(self, df: DataFrame) -> list[str]:
        """Declared columns that the frame lacks or holds under another type."""
        actual = {f.name: f.dataType for f in df.schema.fields}
        return [
            f"{f.name}: expected {f.dataType.simpleString()}, "
            f"found {actual[f.name].simpleString() if f.name in actual else 'nothing'}"
            for f in self.fields.fields
            if actual.get(f.name) != f.dataType
        ]

    def check(self, df: DataFrame) -> DataFrame:
        """One row: rows, null keys, null event times, schema differences."""
        differences = self.schema_differences(df)
        return df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(self.key).isNull()).alias("null_keys"),
            F.count_if(F.col(self.event_time).isNull()).alias("null_event_times"),
        ).withColumn("schema_differences", F.lit(len(differences)).cast("bigint"))


# The offline view: field names and types are fixed values.
TRANSACTION_FEATURES = FeatureView(
    name="transaction_features",
    key="cc_num",
    event_time="event_timestamp",
    ttl_seconds=365 * 86400,
    fields=T.StructType(
        [
            T.StructField("amt", T.DoubleType()),
            T.StructField("category", T.StringType()),
            T.StructField("zip", T.LongType()),
            T.StructField("lat", T.FloatType()),
            T.StructField("long", T.FloatType()),
            T.StructField("city_pop", T.LongType()),
            T.StructField("merchant", T.StringType()),
            T.StructField("merch_lat", T.FloatType()),
            T.StructField("merch_long", T.FloatType()),
            T.StructField("gender", T.StringType()),
            T.StructField("age", T.LongType()),
            T.StructField("avg_amt_7d", T.DoubleType()),
            T.StructField("tx_count_24h", T.LongType()),
            T.StructField("unique_merchants_7d", T.LongType()),
            T.StructField("distance_from_home", T.FloatType()),
            T.StructField("distance_from_last_tx", T.FloatType()),
            T.StructField("hour_of_day", T.LongType()),
            T.StructField("day_of_week", T.LongType()),
        ]
    ),
    tags={"version": "v1"},
)
