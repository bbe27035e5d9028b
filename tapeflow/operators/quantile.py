"""Exact quantile of a column without sorting it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BINS = 4096


def _order_statistic(df: DataFrame, column: str, rank: int) -> float:
    """The value at ``rank`` (from 0). Each pass counts rows per bin of the remaining range, so
    that only bin counts reach the driver, and narrows to the bin that holds the rank."""
    value = F.col(column)
    low, high = df.agg(F.min(value), F.max(value)).first()
    while low < high:
        width = (high - low) / _BINS
        if width == 0:
            # The range is too narrow to split further; its values are neighbouring doubles.
            number = F.when(value <= low, 0).otherwise(1)
        else:
            number = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(_BINS))
        bins = (
            df.filter(value.between(low, high))
            .groupBy(number.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        )
        for row in sorted(bins.collect()):
            if rank < row["n"]:
                low, high = row["low"], row["high"]
                break
            rank -= row["n"]
    return low


def exact_quantile(df: DataFrame, column: str, share: float, rows: int | None = None) -> float:
    """Quantile with linear interpolation between the two nearest rows."""
    rows = df.count() if rows is None else rows
    place = share * (rows - 1)
    lower = int(place)
    value = _order_statistic(df, column, lower)
    if place == lower:
        return value
    above = F.col(column) > value
    up_to, following = df.agg(F.count_if(~above), F.min(F.when(above, F.col(column)))).first()
    upper = value if up_to > lower + 1 else following
    return value + (place - lower) * (upper - value)
