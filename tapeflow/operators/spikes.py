"""Price spikes against the previous trade of the symbol."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X
from ..session import durable
from . import blocks as B

ARRIVAL = ("timestamp_ms", "trade_id")


def flag_spikes(
    df: DataFrame,
    threshold_pct: float = C.SPIKE_THRESHOLD_PCT,
    order_by: Sequence[str] = ARRIVAL,
    split: bool = True,
) -> DataFrame:
    """Add ``is_price_spike``: price more than ``threshold_pct`` percent off the previous trade.

    All rows are put in order once, cut by row count; each part hands the price of its last row to
    the next, so neither a hot symbol nor a hot moment makes a long task. Ties in ``order_by``
    are broken by the other columns. The order reads ``df`` three times: hand over a stored
    table. ``split=False`` is the plain window, for data with small symbols.
    """
    columns = [c for c in df.columns if c != "is_price_spike"]
    df = df.select(*columns)
    order = B.total_order(df, list(order_by))
    if split:
        parts = B.range_parts(df, ["symbol", *[c for c in order if c != "symbol"]])
        rows = B.with_previous(parts, "symbol", "price", "_previous")
    else:
        before = F.lag("price").over(Window.partitionBy("symbol").orderBy(*order))
        rows = df.withColumn("_previous", before)
    spike = X.is_spike(F.col("price"), F.col("_previous"), threshold_pct)
    return rows.select(*columns, spike.alias("is_price_spike"))


def flag_placed(parts: DataFrame, threshold_pct: float = C.SPIKE_THRESHOLD_PCT) -> DataFrame:
    """The same for rows of :func:`blocks.range_parts` by symbol that have ``is_duplicate``, in the order they are in: against
    the previous trade of the symbol that is not a duplicate. A duplicate is no spike."""
    kept = ~F.col("is_duplicate")
    rows = B.with_previous(parts.drop("is_price_spike"), "symbol", "price", "_previous", kept)
    spike = kept & X.is_spike(F.col("price"), F.col("_previous"), threshold_pct)
    return rows.withColumn("is_price_spike", spike).drop("_previous")


def flag_across(parts: DataFrame, threshold_pct: float = C.SPIKE_THRESHOLD_PCT) -> DataFrame:
    """The same for parts in any order, in which symbols alternate: a part hands the last price of each of its symbols on."""
    kept = ~F.col("is_duplicate")
    columns = [c for c in parts.columns if c != "is_price_spike"]
    tails = parts.filter(kept).groupBy(B.PART, "symbol").agg(F.max_by("price", B.POS).alias("_edge"))
    edge = F.lag("_edge").over(Window.partitionBy("symbol").orderBy(B.PART))
    edges = durable(tails.select(F.col(B.PART).alias("_at"), F.col("symbol").alias("_symbol"), edge.alias("_edge")))
    inside = Window.partitionBy(B.PART, "symbol").orderBy(B.POS).rowsBetween(Window.unboundedPreceding, -1)
    near = F.last(F.when(kept, F.struct("price")), ignorenulls=True).over(inside)
    same = (F.col(B.PART) == F.col("_at")) & F.col("symbol").eqNullSafe(F.col("_symbol"))
    rows = parts.select(*columns, near.alias("_near")).join(edges, same, "left")
    previous = F.when(F.col("_near").isNull(), F.col("_edge")).otherwise(F.col("_near.price"))
    spike = kept & X.is_spike(F.col("price"), previous, threshold_pct)
    return rows.select(*columns, spike.alias("is_price_spike"))
