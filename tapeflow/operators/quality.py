"""Success criteria of the pipeline as rows (check_name, ok, value)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def quality_report(
    trades: DataFrame, windows: DataFrame, expected_symbols: Sequence[str] = C.EXPECTED_SYMBOLS
) -> DataFrame:
    """Expected symbols present; windows, counts and mean prices advance; no price or quantity
    at or below zero; spikes of the trades counted in the windows.

    One aggregate over each table; the two single rows are stacked as check rows.
    """
    bad = F.count_if((F.col("price") <= 0) | (F.col("quantity") <= 0))
    spikes = F.count_if("is_price_spike")
    missing = F.lit(len(expected_symbols))
    for symbol in expected_symbols:
        missing = missing - F.coalesce(F.max((F.col("symbol") == symbol).cast("int")), F.lit(0))

    def check(name, ok, value):
        return F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(ok, F.lit(False)).alias("ok"),
            value.cast("bigint").alias("value"),
        )

    trade_checks = trades.agg(
        F.array(
            check("non_positive_rows", bad == 0, bad),
            check("spikes_flagged", spikes > 0, spikes),
        ).alias("checks")
    )
    starts = F.unix_seconds(F.max("window_start")) - F.unix_seconds(F.min("window_start"))
    counted = F.coalesce(F.sum("trade_count"), F.lit(0))
    priced = F.count_if(F.col("avg_price") > 0)
    in_windows = F.coalesce(F.sum("spike_count"), F.lit(0))
    window_checks = windows.agg(
        F.array(
            check("missing_symbols", missing == 0, missing),
            check("window_span_seconds", starts > 0, starts),
            check("trades_counted", counted > 0, counted),
            check("windows_priced", priced > 0, priced),
            check("spikes_in_windows", in_windows > 0, in_windows),
        ).alias("checks")
    )
    return trade_checks.union(window_checks).select(F.inline("checks"))
