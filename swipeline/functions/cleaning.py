"""Field-level cleaning of text messages. Every function is a Column expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from swipeline import config

# --- fixed values: reject reasons, in order of precedence -------------------
NOT_A_RECORD = "Transaction must be a dictionary"
MISSING = "Missing required fields: "
CAST_ERROR = "Type casting error"
BAD_TIMESTAMP = "Unable to parse timestamp"
NOT_POSITIVE = "Amount must be positive"
OUT_OF_RANGE = "Timestamp out of range"
BAD_LATITUDE = "Invalid latitude"
BAD_LONGITUDE = "Invalid longitude"
# ---------------------------------------------------------------------------

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NUMBER_OR_INFINITE = NUMBER + r"|(?i)^\s*[+-]?inf(inity)?\s*$"
COORDINATE = NUMBER_OR_INFINITE + r"|(?i)^\s*[+-]?nan\s*$"
#: ISO date and time, with or without separators, zone with or without colon.
DATE_TIME = (
    r"^\d{4}(-?)\d{2}\1\d{2}([T ]\d{2}(:?)\d{2}(\3\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
#: The same with all separators, which most texts have: nothing is to be put in.
EXTENDED = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
BASIC_DATE, BASIC_TIME, BASIC_ZONE = r"^(\d{4})(\d{2})(\d{2})", r"([T ]\d{2})(\d{2})(\d{2})", r"([+-]\d{2})(\d{2})$"
SHORT_TIME = r"([T ]\d{2})(\d{2})(?=$|Z|[+-])"


def matching(text: Column, pattern: str) -> Column:
    """The text where it has the pattern, null otherwise; refers to the text once. Casting '' to a
    number would raise and catch an error in every such row."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(0))


def number(text: Column) -> Column:
    """Text as double; null unless it reads as a number."""
    return matching(text, NUMBER).try_cast("double")


def coordinate(text: Column) -> Column:
    """Text as degrees; infinite and NaN are readable, if never in range."""
    return F.trim(matching(text, COORDINATE)).try_cast("double")


def iso(text: Column) -> Column:
    """ISO text with its separators put in; null if it is none."""
    out = F.regexp_replace(matching(text, DATE_TIME), BASIC_DATE, "$1-$2-$3")
    out = F.regexp_replace(F.regexp_replace(out, BASIC_TIME, "$1:$2:$3"), SHORT_TIME, "$1:$2")
    # without a time, the last parts of a date are no zone
    out = F.when(F.length(out) > 10, F.regexp_replace(out, BASIC_ZONE, "$1:$2")).otherwise(out)
    return F.when(text.rlike(EXTENDED), text).otherwise(out)


def missing_fields(fields: list[str] = config.REQUIRED_FIELDS) -> Column:
    """Names of the null fields in contract order, '' if none."""
    return F.concat_ws(", ", *[F.when(F.col(f).isNull(), F.lit(f)) for f in fields])


def optional(name: str) -> Column:
    """Null becomes the default; an empty string stays."""
    return F.coalesce(F.col(name), F.lit(config.OPTIONAL_DEFAULTS[name]))


def amount(text: Column, maximum: float = config.AMOUNT_MAX) -> Column:
    """Absolute value, clipped, in cents; null if the text is no number.

    Money is cast from text straight to decimal, so 125.555 becomes 125.56.
    """
    readable = F.trim(matching(text, NUMBER_OR_INFINITE))
    size = F.abs(readable.try_cast("double"))
    limit = F.lit(maximum).cast("decimal(18,2)")
    return F.when(size > maximum, limit).otherwise(F.abs(readable.try_cast("decimal(18,2)")))


def epoch_seconds(text: Column) -> Column:
    """Epoch number (truncated), ISO text with or without zone, or date and time."""
    return F.coalesce(
        number(text).try_cast("bigint"),
        F.unix_seconds(iso(text).try_cast("timestamp")),
    )


def reject_reason(
    amount_text: Column,
    amount_value: Column,
    timestamp_value: Column,
    lat_text: Column,
    lat: Column,
    lon_text: Column,
    lon: Column,
    corrupt: Column | None = None,
) -> Column:
    """First failed check in contract order, null for a good row."""
    missing = missing_fields()
    unreadable = (
        amount_value.isNull()
        | (lat_text.isNotNull() & lat.isNull())
        | (lon_text.isNotNull() & lon.isNull())
    )
    checks = [
        (missing != "", F.concat(F.lit(MISSING), missing)),
        (unreadable, F.lit(CAST_ERROR)),
        (timestamp_value.isNull(), F.lit(BAD_TIMESTAMP)),
        (amount_value <= 0, F.lit(NOT_POSITIVE)),
        (
            ~timestamp_value.between(config.TIMESTAMP_MIN, config.TIMESTAMP_MAX),
            F.lit(OUT_OF_RANGE),
        ),
        (lat.isNotNull() & ~lat.between(-90, 90), F.lit(BAD_LATITUDE)),
        (lon.isNotNull() & ~lon.between(-180, 180), F.lit(BAD_LONGITUDE)),
    ]
    if corrupt is not None:
        checks.insert(0, (corrupt.isNotNull(), F.lit(NOT_A_RECORD)))
    reason = F.lit(None).cast("string")
    for failed, text in reversed(checks):
        reason = F.when(failed, text).otherwise(reason)
    return reason
