"""Other tables as trades and as trade messages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..schemas import CLEAN_TRADE


def as_trades(df: DataFrame, **columns) -> DataFrame:
    """Project any table to the clean schema (plus ``event_time``). ``columns`` gives symbol,
    price, quantity, timestamp_ms, trade_id and is_buyer_maker as columns or SQL text; value,
    time text and the rest are derived unless given."""
    given = {k: F.expr(v) if isinstance(v, str) else v for k, v in columns.items()}
    base = df.select(
        *[
            given[f.name].cast(f.dataType).alias(f.name)
            for f in CLEAN_TRADE.fields
            if f.name in given
        ]
    )
    derived = {
        "trade_value_usdt": X.trade_value(F.col("price"), F.col("quantity")),
        "trade_time": X.iso_utc(F.col("timestamp_ms")),
        "is_price_spike": F.lit(False),
        "source": F.lit("synthetic"),
    }
    return base.select(
        *[F.col(n) if n in given else derived[n].alias(n) for n in CLEAN_TRADE.names],
        X.event_time(F.col("timestamp_ms")).alias("event_time"),
    )


def events_as_trades(events: DataFrame) -> DataFrame:
    return as_trades(
        events,
        symbol="upper(event_type)",
        price="value",
        quantity="cast(1 + user_id % 10 as double)",
        timestamp_ms="unix_millis(cast(ts as timestamp))",
        is_buyer_maker="user_id % 2 = 0",
        trade_id="event_id",
    )


def lineitem_as_trades(lineitem: DataFrame) -> DataFrame:
    return as_trades(
        lineitem,
        symbol="l_returnflag",
        price="l_extendedprice / l_quantity",
        quantity="l_quantity",
        trade_value_usdt="round(l_extendedprice, 6)",
        timestamp_ms="unix_millis(cast(l_shipdate as timestamp))",
        is_buyer_maker="l_linestatus = 'O'",
        trade_id="l_orderkey * 10 + l_linenumber",
    )


def trades_as_messages(trades: DataFrame) -> DataFrame:
    """Raw messages (column ``value``) that carry the trades."""
    data = F.struct(
        F.lit("trade").alias("e"),
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("quantity").cast("string").alias("q"),
        F.col("timestamp_ms").alias("T"),
        F.col("is_buyer_maker").alias("m"),
        F.col("trade_id").alias("t"),
    )
    return trades.select(F.to_json(F.struct(data.alias("data"))).alias("value"))
