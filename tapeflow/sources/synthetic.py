"""Seeded window tables for trying out the analysis without a stream."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SLIDING_TABLE, TUMBLING_TABLE

# Symbols with their base price, and the ranges of the generated columns.
BASE_PRICES = {"BTCUSDT": 50000.0, "ETHUSDT": 3000.0, "BNBUSDT": 3000.0}
PRICE_DEVIATION = 200.0
TRADE_COUNTS = (50, 199)
QUANTITIES = (100, 499)
SPIKES = (0, 4)
PRICE_MARGIN = (50.0, 100.0)
MINUTES = 60
SEED = 42


def synth_window_tables(
    spark: SparkSession, start: datetime, minutes: int = MINUTES, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(tumbling, sliding) tables of ``minutes`` windows per symbol from ``start`` on.

    Values are drawn from a hash of (minute, symbol, column, seed), so that both tables agree and
    partitioning does not matter.
    """
    prices = F.create_map(*[F.lit(x) for pair in BASE_PRICES.items() for x in pair])

    def uniform(name: str):
        draw = F.xxhash64("minute", "symbol", F.lit(name), F.lit(seed))
        return (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / F.lit(float(1 << 53))

    def whole(name: str, bounds: tuple[int, int]):
        low, high = bounds
        return (F.floor(uniform(name) * (high - low + 1)) + low).cast("bigint")

    normal = F.sqrt(-2 * F.ln(uniform("radius"))) * F.cos(2 * F.pi() * uniform("angle"))
    low, high = PRICE_MARGIN
    rows = (
        spark.range(minutes)
        .withColumnRenamed("id", "minute")
        .withColumn("symbol", F.explode(F.map_keys(prices)))
        .withColumn(
            "window_start",
            F.timestamp_add("MINUTE", F.col("minute"), F.lit(start).cast("timestamp")),
        )
        .withColumn("avg_price", prices[F.col("symbol")] + PRICE_DEVIATION * normal)
        .withColumn("trade_count", whole("trade_count", TRADE_COUNTS))
        .withColumn("sum_qty", whole("sum_qty", QUANTITIES).cast("double"))
        .withColumn("spike_count", whole("spike_count", SPIKES))
        .withColumn("sum_value", F.col("trade_count") * F.col("avg_price"))
        .withColumn("min_price", F.col("avg_price") - (low + (high - low) * uniform("min")))
        .withColumn("max_price", F.col("avg_price") + (low + (high - low) * uniform("max")))
        .withColumn("event_date", F.to_date("window_start"))
    )

    def table(schema, length: int) -> DataFrame:
        ends = rows.withColumn("window_end", F.timestamp_add("MINUTE", F.lit(length), "window_start"))
        return ends.select(*schema.names)

    return table(TUMBLING_TABLE, 1), table(SLIDING_TABLE, 5)
