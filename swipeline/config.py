"""Fixed values shared by every job."""

from __future__ import annotations

# --- fixed values ---------------------------------------------------------
US = 1_000_000  # microseconds per second

VELOCITY_WINDOWS = {"10m": 600, "1h": 3600, "24h": 86400}  # seconds
DAY_S = 86400
IDLE_GAP_S = 86400          # merchant set is forgotten after this much silence
STATS_GAP_S = 2592000       # moving average is forgotten after 30 days of silence
EMA_ALPHA = 0.1
DEFAULT_AVG_AMOUNT = 75.0
CLIP_PERCENTILE = 99.0

AMOUNT_MAX = 10000.0
TIMESTAMP_MIN = 946684800   # 2000-01-01
TIMESTAMP_MAX = 4102444800  # 2100-01-01

REQUIRED_FIELDS = ["transaction_id", "card_id", "amount", "merchant_id", "timestamp"]
OPTIONAL_DEFAULTS = {
    "merchant_category": "UNKNOWN",
    "city": "",
    "state": "",
    "user_id": "",
}

CARD_DEFAULTS = {
    "tx_count_10m": 0,
    "tx_count_1h": 0,
    "tx_count_24h": 0,
    "total_amount_10m": 0.0,
    "total_amount_1h": 0.0,
    "total_amount_24h": 0.0,
    "unique_merchants_24h": 0,
    "avg_tx_amount_30d": 75.0,
    "last_tx_timestamp": 0,
    "is_new_card": 1,
}
MERCHANT_DEFAULTS = {"risk_score": 0.5, "fraud_rate": 0.002, "total_transactions": 100}

EARTH_RADIUS_KM = 6371.0
DEFAULT_AGE = 30
HASH_BUCKETS = 1000

HIGH_RISK = 0.7
MEDIUM_RISK = 0.3
REVIEW_AMOUNT = 5000
BLOCK_THRESHOLD = 0.5
HIGH_VALUE_AMOUNT = 500
MODEL_VERSION = "v1.0.0"
VIEW_TTL_S = 365 * 86400
# --------------------------------------------------------------------------

# A key with more rows than this is spread over many tasks (see operators/hot.py).
HOT_ROWS_CONF = "spark.swipeline.hotKeyRows"
HOT_ROWS = 5_000_000
