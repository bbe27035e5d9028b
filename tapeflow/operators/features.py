"""Features of window tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as X
from ..session import durable
from . import blocks as B


def framed(df: DataFrame, columns: Mapping, before: int, after: int, block: str | None) -> DataFrame:
    """Add columns that need a row frame over ``avg_price`` per symbol in window order.

    ``columns`` maps a name to a function from the window specification to a column.
    """
    keep = [c for c in df.columns if c not in columns]
    key = ["symbol"]
    rows = df.select(*keep)
    if block:
        rows = rows.withColumn(B.BLOCK, B.time_block(F.col("window_start"), block))
        rows = B.with_halo(rows, key, ["window_start"], ["avg_price"], before, after)
        key.insert(0, B.BLOCK)
    order = Window.partitionBy(*key).orderBy("window_start")
    rows = rows.withColumns({name: make(order) for name, make in columns.items()})
    if block:
        rows = rows.filter(~F.col(B.HALO))
    return rows.select(*keep, *columns)


def window_features(df: DataFrame, block: str | None = "1 day") -> DataFrame:
    """Price change against the previous window of the symbol in percent, value per trade and
    share of spikes (0 without a ``spike_count`` column).

    ``block`` cuts each symbol by time into tasks; ``None`` keeps a symbol in one task.
    """
    price = F.col("avg_price")
    changed = framed(
        df,
        {"price_change_pct": lambda w: X.pct_change(price, F.lag(price).over(w))},
        before=1,
        after=0,
        block=block,
    )
    trades = F.col("trade_count")
    spikes = F.col("spike_count") if "spike_count" in df.columns else F.lit(0.0)
    return changed.withColumns(
        {
            "value_per_trade": X.per_trade(F.col("sum_value"), trades),
            "spike_rate": X.per_trade(spikes, trades).cast("double"),
        }
    )


def price_features(df: DataFrame, block: str | None = "1 day") -> DataFrame:
    """Rolling means and deviation, price change, volume z-score and the next window's price
    (``next_price``, the target) per symbol.

    The z-score uses the whole history of the symbol, later windows included.
    """
    price = F.col("avg_price")
    rolled = framed(
        df,
        {
            "rolling_mean_5": lambda w: F.avg(price).over(w.rowsBetween(-4, 0)),
            "rolling_mean_10": lambda w: F.avg(price).over(w.rowsBetween(-9, 0)),
            "rolling_std_5": lambda w: F.coalesce(
                F.stddev_samp(price).over(w.rowsBetween(-4, 0)), F.lit(0.0)
            ),
            "price_change": lambda w: F.coalesce(price - F.lag(price).over(w), F.lit(0.0)),
            "price_change_pct": lambda w: X.pct_change(price, F.lag(price).over(w)),
            "next_price": lambda w: F.lead(price).over(w),
        },
        before=9,
        after=1,
        block=block,
    )
    # Partially aggregated per symbol and joined back: no frame over a whole symbol. Stored first,
    # so that the join is planned with its size.
    volume = durable(
        df.groupBy("symbol").agg(
            F.avg("sum_value").alias("_mean"), F.stddev_samp("sum_value").alias("_std")
        )
    )
    zscore = (F.col("sum_value") - F.col("_mean")) / F.col("_std")
    return (
        rolled.join(volume, "symbol")
        .withColumn("volume_zscore", F.coalesce(F.when(F.col("_std") > 0, zscore), F.lit(0.0)))
        .drop("_mean", "_std")
    )


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column is scaled by 1."""
    zero = F.lit(0.0)
    stats = df.agg(
        *[F.avg(F.coalesce(F.col(c), zero)).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.coalesce(F.col(c), zero)).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (stats[f"m_{c}"], stats[f"s_{c}"] or 1.0) for c in columns}


def standardize(
    df: DataFrame,
    columns: Sequence[str],
    scaler: Mapping[str, tuple[float, float]] | None = None,
    suffix: str = "_scaled",
) -> DataFrame:
    """Add each column shifted and scaled over the whole table; null counts as 0."""
    scaler = scaler or fit_scaler(df, columns)
    return df.withColumns(
        {
            f"{c}{suffix}": (F.coalesce(F.col(c), F.lit(0.0)) - F.lit(mean)) / F.lit(std)
            for c, (mean, std) in scaler.items()
        }
    )
