"""Values that results depend on."""

# ---------------------------------------------------------------------------
# Names, keys, limits and defaults of the data contract.
# ---------------------------------------------------------------------------
RAW_TOPIC = "raw_trades"
CLEAN_TOPIC = "clean_trades"
REQUIRED_KEYS = ("e", "s", "p", "q", "T", "m", "t")
SOURCE_NAME = "binance"
EXPECTED_SYMBOLS = ("BTCUSDT", "ETHUSDT")

SPIKE_THRESHOLD_PCT = 2.0
DEDUP_HORIZON = 2000
STATS_INTERVAL = 100
VALUE_DECIMALS = 6

WATERMARK = "2 minutes"
TUMBLING_WIDTH = "1 minute"
SLIDING_WIDTH = "5 minutes"
SLIDING_SLIDE = "1 minute"
TUMBLING_NAME = "tumbling_1m"
SLIDING_NAME = "sliding_5m_1m"

ANOMALY_FEATURES = (
    "avg_price",
    "trade_count",
    "sum_value",
    "price_change_pct",
    "value_per_trade",
    "spike_rate",
)
ANOMALY_MIN_ROWS = 5
FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.05
FOREST_SEED = 42

PRICE_FEATURES = (
    "rolling_mean_5",
    "rolling_mean_10",
    "rolling_std_5",
    "price_change",
    "price_change_pct",
    "volume_zscore",
)
PREDICT_MIN_ROWS = 15
PREDICT_MIN_TRAINING_ROWS = 10

ANOMALY_REPORT_COLUMNS = (
    "symbol",
    "window_start",
    "avg_price",
    "trade_count",
    "sum_value",
    "spike_count",
    "anomaly_score",
)
SERIES_MEASURES = (
    "avg_price",
    "trade_count",
    "sum_value",
    "spike_count",
    "pred_error",
    "anomaly_score",
)
# ---------------------------------------------------------------------------

# Our own reject reasons, in the order in which they are tested.
BAD_JSON = "bad_json"
MISSING_FIELD = "missing_field"
BAD_TYPE = "bad_type"
EMPTY_SYMBOL = "empty_symbol"
NON_FINITE = "non_finite"
NON_POSITIVE = "non_positive"
DUPLICATE = "duplicate"
REJECT_REASONS = (BAD_JSON, MISSING_FIELD, BAD_TYPE, EMPTY_SYMBOL, NON_FINITE, NON_POSITIVE, DUPLICATE)
