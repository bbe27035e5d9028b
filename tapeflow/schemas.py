"""Table schemas."""

from pyspark.sql.types import StructType


def _table(**columns: str) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


CLEAN_TRADE = _table(
    symbol="string",
    price="double",
    quantity="double",
    trade_value_usdt="double",
    trade_time="string",
    timestamp_ms="long",
    is_buyer_maker="boolean",
    is_price_spike="boolean",
    trade_id="long",
    source="string",
)

_WINDOW = {"window_start": "timestamp", "window_end": "timestamp", "symbol": "string"}

TUMBLING_TABLE = _table(
    **_WINDOW,
    trade_count="long",
    avg_price="double",
    sum_qty="double",
    sum_value="double",
    spike_count="long",
    event_date="date",
)

SLIDING_TABLE = _table(
    **_WINDOW,
    trade_count="long",
    avg_price="double",
    min_price="double",
    max_price="double",
    sum_value="double",
    event_date="date",
)
