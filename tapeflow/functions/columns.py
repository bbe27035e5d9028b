"""Column helpers shared by the operators."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def seconds(interval: str) -> int:
    """Length of a fixed interval such as "5 minutes"."""
    return int(pd.Timedelta(interval).total_seconds())


def clean_symbol(symbol: Column) -> Column:
    return F.upper(symbol)


def event_time(timestamp_ms: Column) -> Column:
    """Event time with its milliseconds."""
    return F.timestamp_millis(timestamp_ms)


def iso_utc(timestamp_ms: Column) -> Column:
    """ISO-8601 text in UTC with six fraction digits, whatever the session zone."""
    utc = F.to_utc_timestamp(F.timestamp_millis(timestamp_ms), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def trade_value(price: Column, quantity: Column) -> Column:
    return F.round(price * quantity, C.VALUE_DECIMALS)


def is_finite(number: Column) -> Column:
    """False for NaN and +-infinity (NaN sorts above every number)."""
    infinity = F.lit(float("inf"))
    return (number < infinity) & (number > -infinity)


def pct_change(value: Column, previous: Column) -> Column:
    """Change against the previous value in percent; 0 where there is none."""
    return F.coalesce(F.try_divide(value - previous, previous), F.lit(0.0)) * 100


def per_trade(amount: Column, trade_count: Column) -> Column:
    """Amount per trade, where an empty window divides by one."""
    return amount / F.when(trade_count == 0, 1).otherwise(trade_count)


def is_spike(price: Column, previous: Column, threshold_pct: float) -> Column:
    """Strictly more than ``threshold_pct`` percent away from the previous price."""
    change = F.try_divide(F.abs(price - previous), previous) * 100
    return F.coalesce((change > threshold_pct) & ~F.isnan(change), F.lit(False))


def direction(predicted: Column, price: Column) -> Column:
    return F.when(predicted >= price, "up").otherwise("down")
