"""Cleaning and event-time window tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X
from ..schemas import CLEAN_TRADE
from . import blocks as B
from .dedup import KEY, keep_first
from .spikes import ARRIVAL


def parse_clean_trades(df: DataFrame, json_col: str = "json_str") -> DataFrame:
    """Clean trades from JSON text, with upper-case symbol and ``event_time``."""
    trade = F.from_json(F.col(json_col).cast("string"), CLEAN_TRADE)
    parsed = df.select(trade.alias("trade"))
    fields = {f.name: F.col("trade")[f.name] for f in CLEAN_TRADE.fields}
    fields["symbol"] = X.clean_symbol(fields["symbol"])
    fields["event_time"] = X.event_time(fields["timestamp_ms"])
    return parsed.select(*[value.alias(name) for name, value in fields.items()])


def valid_trades(df: DataFrame, reject_non_finite: bool = True) -> DataFrame:
    """Recast to the clean types and keep rows with a symbol and positive numbers."""
    kinds = {f.name: f.dataType for f in CLEAN_TRADE.fields}
    recast = {
        name: F.col(name).try_cast(kinds[name]) if name in kinds else F.col(name)
        for name in df.columns
    }
    recast["symbol"] = X.clean_symbol(F.col("symbol"))
    if "event_time" not in recast:
        recast["event_time"] = X.event_time(F.col("timestamp_ms").try_cast("bigint"))
    price, quantity = F.col("price"), F.col("quantity")
    valid = (F.col("symbol") != "") & (price > 0) & (quantity > 0) & (F.col("timestamp_ms") > 0)
    if reject_non_finite:
        valid = valid & X.is_finite(price) & X.is_finite(quantity)
    return df.select(*[value.alias(name) for name, value in recast.items()]).filter(valid)


def clean_trades(
    df: DataFrame,
    watermark: str = C.WATERMARK,
    dedup: str | None = "unbounded",
    order_by: Sequence[str] = ARRIVAL,
    reject_non_finite: bool = True,
) -> DataFrame:
    """Valid trades, one per (symbol, trade_id).

    On a stream: behind a watermark; ``unbounded`` remembers every id, ``within_watermark``
    only for as long as the watermark reaches, which bounds the state. In batch the survivor is
    the first row in ``order_by``. ``None`` keeps all rows.
    """
    trades = valid_trades(df, reject_non_finite)
    if df.isStreaming:
        trades = trades.withWatermark("event_time", watermark)
        if dedup == "within_watermark":
            return trades.dropDuplicatesWithinWatermark(list(KEY))
        return trades.dropDuplicates(list(KEY)) if dedup else trades
    return keep_first(trades, KEY, B.total_order(trades, order_by)) if dedup else trades


def _measures(*names: str) -> list[Column]:
    known = {
        "trade_count": F.count("*"),
        "avg_price": F.avg("price"),
        "min_price": F.min("price"),
        "max_price": F.max("price"),
        "sum_qty": F.sum("quantity"),
        "sum_value": F.sum("trade_value_usdt"),
        "spike_count": F.count_if("is_price_spike"),
    }
    return [known[name].alias(name) for name in names]


def _window_columns(grouped: DataFrame, *measures: Column | str) -> DataFrame:
    start = F.col("w.start")
    return grouped.select(
        start.alias("window_start"),
        F.col("w.end").alias("window_end"),
        "symbol",
        *measures,
        F.to_date(start).alias("event_date"),
    )


def aggregate_tumbling(df: DataFrame, width: str = C.TUMBLING_WIDTH) -> DataFrame:
    """Count, mean price, quantity, value and spikes per symbol and fixed window."""
    names = ("trade_count", "avg_price", "sum_qty", "sum_value", "spike_count")
    grouped = df.groupBy(F.window("event_time", width).alias("w"), "symbol").agg(*_measures(*names))
    return _window_columns(grouped, *names)


def aggregate_sliding(
    df: DataFrame,
    width: str = C.SLIDING_WIDTH,
    slide: str = C.SLIDING_SLIDE,
    from_partials: bool | None = None,
) -> DataFrame:
    """Count, mean, least and greatest price and value per symbol and sliding window.

    In batch, where the slide divides the width, each trade is aggregated once into its slide
    and the slides are combined into windows, instead of copying each trade into every window.
    """
    names = ("trade_count", "avg_price", "min_price", "max_price", "sum_value")
    divides = X.seconds(width) % X.seconds(slide) == 0
    if from_partials is None:
        from_partials = divides and not df.isStreaming
    elif from_partials and not divides:
        raise ValueError("the slide must divide the width")
    if not from_partials:
        window = F.window("event_time", width, slide).alias("w")
        return _window_columns(df.groupBy(window, "symbol").agg(*_measures(*names)), *names)
    slides = df.groupBy(F.window("event_time", slide).alias("s"), "symbol").agg(
        *_measures("trade_count", "min_price", "max_price", "sum_value"),
        F.sum("price").alias("sum_price"),
    )
    window = F.window(F.col("s.start"), width, slide).alias("w")
    grouped = slides.groupBy(window, "symbol").agg(
        F.sum("trade_count").alias("trade_count"),
        (F.sum("sum_price") / F.sum("trade_count")).alias("avg_price"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("sum_value").alias("sum_value"),
    )
    return _window_columns(grouped, *names)
