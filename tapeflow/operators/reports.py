"""Reports over (scored) window tables and over trades."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X


def list_symbols(df: DataFrame) -> DataFrame:
    """Distinct symbols in order."""
    return df.select("symbol").distinct().orderBy("symbol")


def filter_symbols(df: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Rows of the given symbols; by default of the first two in order. An empty choice does not
    filter. The filter is a plain predicate, so it reaches the scan."""
    if symbols is None:
        symbols = [row.symbol for row in list_symbols(df).limit(2).collect()]
    return df.filter(F.col("symbol").isin(list(symbols))) if symbols else df


def latest_window(df: DataFrame) -> DataFrame:
    """The row of the latest window; the last symbol in order where several share it."""
    row = F.struct(*df.columns)
    latest = df.agg(F.max_by(row, F.struct("window_start", "symbol")).alias("row"))
    return latest.filter("row is not null").select("row.*")


def kpi_summary(df: DataFrame) -> DataFrame:
    """One row: latest symbol and price, its prediction and direction, total trades and volume,
    anomaly count and status. Columns that the table lacks count as 0."""

    def column(name):
        return F.col(name) if name in df.columns else F.lit(0)

    latest = F.struct(
        F.col("symbol").alias("symbol"),
        F.coalesce(column("avg_price").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(column("predicted_price").cast("double"), F.lit(0.0)).alias("predicted"),
    )
    totals = df.agg(
        F.max_by(latest, F.struct("window_start", "symbol")).alias("latest"),
        F.coalesce(F.sum(column("trade_count").cast("bigint")), F.lit(0)).alias("total_trades"),
        F.coalesce(F.sum(column("sum_value").cast("double")), F.lit(0.0)).alias("total_volume"),
        F.count_if(column("anomaly").cast("boolean")).alias("anomaly_count"),
    )
    price = F.coalesce(F.col("latest.price"), F.lit(0.0))
    predicted = F.coalesce(F.col("latest.predicted"), F.lit(0.0))
    return totals.select(
        F.coalesce(F.col("latest.symbol"), F.lit("")).alias("latest_symbol"),
        price.alias("latest_price"),
        predicted.alias("predicted_price"),
        X.direction(predicted, price).alias("direction"),
        "total_trades",
        "total_volume",
        "anomaly_count",
        F.when(F.col("anomaly_count") > 0, "anomalies").otherwise("normal").alias("status"),
    )


def split_anomalies(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normal, anomalous) windows."""
    return scored.filter(~F.col("anomaly")), scored.filter(F.col("anomaly"))


def anomaly_table(scored: DataFrame) -> DataFrame:
    """Anomalous windows with those report columns that exist."""
    columns = [c for c in C.ANOMALY_REPORT_COLUMNS if c in scored.columns]
    return split_anomalies(scored)[1].select(*columns)


def range_band(sliding: DataFrame) -> DataFrame:
    """Greatest, least and mean price by time for each symbol."""
    band = sliding.select("symbol", "window_start", "max_price", "min_price", "avg_price")
    return band.orderBy("symbol", "window_start")


def series_long(df: DataFrame, measures: Sequence[str] = C.SERIES_MEASURES) -> DataFrame:
    """The measures that exist as rows (symbol, window_start, measure, value), in one scan."""
    present = [c for c in measures if c in df.columns]
    doubles = df.select("symbol", "window_start", *[F.col(c).cast("double").alias(c) for c in present])
    return doubles.unpivot(["symbol", "window_start"], present, "measure", "value")


def peek_trades(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Trades of a topic for inspection, from JSON text in ``json_str``: absent fields get a
    default, spikes a marker. Works on streams and tables."""
    fields = (
        "symbol string, price double, quantity double, trade_value_usdt double, "
        "trade_time string, is_price_spike boolean"
    )
    trade = records.select(F.from_json("json_str", fields).alias("t"))
    shown = trade.select(
        F.coalesce("t.symbol", F.lit("?")).alias("symbol"),
        F.coalesce("t.price", F.lit(0.0)).alias("price"),
        F.coalesce("t.quantity", F.lit(0.0)).alias("quantity"),
        F.coalesce("t.trade_value_usdt", F.lit(0.0)).alias("value"),
        F.coalesce("t.trade_time", F.lit("?")).alias("time"),
        F.when(F.col("t.is_price_spike"), "SPIKE").otherwise("").alias("marker"),
    )
    return shown.limit(limit) if limit else shown


def message_count(records: DataFrame) -> DataFrame:
    """Number of messages."""
    return records.agg(F.count("*").alias("messages"))
