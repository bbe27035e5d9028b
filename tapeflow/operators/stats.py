"""Running statistics per symbol."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X
from ..session import durable
from . import blocks as B
from .spikes import ARRIVAL, flag_across

_ORDER = ("symbol", "is_duplicate", "price", "quantity")
_COUNT = "_accepted"
_SUMS = ("trades", "_price_sum", "total_value", "duplicates", "spikes")


def _running(frame) -> dict:
    """Totals over a window frame."""
    least, greatest = F.min("min_price").over(frame), F.max("max_price").over(frame)
    return {c: F.sum(c).over(frame) for c in _SUMS} | {"min_price": least, "max_price": greatest}


def symbol_stats(clean: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """Trades, mean/least/greatest price, total value and spikes per symbol, and how many of its
    messages were duplicates or otherwise dropped."""
    no_reason = F.lit(None).cast("string").alias("reason")
    rows = clean.select("symbol", "price", "trade_value_usdt", "is_price_spike", no_reason)
    if rejects is not None:
        none = F.lit(None)
        rows = rows.union(
            rejects.filter("symbol is not null").select(
                "symbol",
                none.cast("double"),
                none.cast("double"),
                none.cast("boolean"),
                "reject_reason",
            )
        )
    return _stats(rows)


def totals_stats(carried: DataFrame) -> DataFrame:
    """The same from the totals that :func:`running_totals` carries."""
    mean = F.coalesce(F.try_divide("_price_sum", "trades"), F.lit(0.0)).alias("avg_price")
    return carried.select("symbol", "trades", mean, "min_price", "max_price", "total_value", "duplicates", "spikes")


def _stats(rows: DataFrame) -> DataFrame:
    accepted = F.col("reason").isNull()
    return rows.groupBy("symbol").agg(
        F.count_if(accepted).alias("trades"),
        F.coalesce(F.avg("price"), F.lit(0.0)).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.coalesce(F.sum("trade_value_usdt"), F.lit(0.0)).alias("total_value"),
        F.count_if(F.col("reason") == C.DUPLICATE).alias("duplicates"),
        F.count_if(F.col("is_price_spike")).alias("spikes"),
        F.count_if(~accepted & (F.col("reason") != C.DUPLICATE)).alias("dropped"),
    )


def place_trades(
    marked: DataFrame, threshold_pct: float = C.SPIKE_THRESHOLD_PCT, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Trades with ``is_duplicate`` as :func:`running_totals` takes them without sorting again: as parts in ``order_by``
    with ``is_price_spike`` and the accepted trades of the part so far. Hand over a stored table, and store the result."""
    order = list(dict.fromkeys([*order_by, *_ORDER]))
    return count_placed(B.range_parts(marked.select(*order), order), threshold_pct)


def count_placed(parts: DataFrame, threshold_pct: float = C.SPIKE_THRESHOLD_PCT) -> DataFrame:
    """The same for trades that are such parts already, with all their columns."""
    inside = Window.partitionBy(B.PART).orderBy(B.POS).rowsBetween(Window.unboundedPreceding, 0)
    return flag_across(parts.withColumn(_COUNT, F.sum((~F.col("is_duplicate")).cast("bigint")).over(inside)), threshold_pct)


class Totals(NamedTuple):
    """Statistics of a batch of trades: the intervals in which they hold, and what the next batch goes on from."""

    intervals: DataFrame
    carried: DataFrame


def running_totals(
    marked: DataFrame,
    interval: int = C.STATS_INTERVAL,
    order_by: Sequence[str] = ARRIVAL,
    span: int = 10_000,
    carried: DataFrame | None = None,
) -> Totals:
    """Statistics of every symbol after each ``interval``-th accepted trade, counted over all symbols in ``order_by``.

    ``marked`` holds the valid trades with ``is_duplicate`` and ``is_price_spike``, or is the result of
    :func:`place_trades` or :func:`count_placed` with the same order; hand over a stored table. A symbol has one row for each snapshot that found it changed, valid ``from_trades`` to ``to_trades`` (null while
    nothing newer is known). ``carried`` is what an earlier batch left: the count goes on from there.

    The count comes from range parts and their offsets, and totals are carried over spans of ``span`` snapshots, so no
    task sees more than a part or a span.
    """
    # Only what the statistics use; rows that tie in all of it are interchangeable.
    order = list(dict.fromkeys([*order_by, *_ORDER, "is_price_spike"]))
    placed = _COUNT in marked.columns
    parts = marked if placed else B.range_parts(marked.select(*order), order)
    accepted = (~F.col("is_duplicate")).cast("bigint")
    offsets = B.part_offsets(parts, accepted)
    before = 0 if carried is None else carried.agg(F.sum("trades")).first()[0] or 0
    total = before + (parts.agg(F.sum(accepted)).first()[0] or 0)
    snapshots = total // interval

    inside = Window.partitionBy(B.PART).orderBy(B.POS).rowsBetween(Window.unboundedPreceding, 0)
    in_part = F.col(_COUNT) if placed else F.sum(accepted).over(inside)
    counted = parts.join(offsets, B.PART).withColumn("_count", F.lit(before) + F.col("_offset") + in_part)
    # A duplicate that follows the last trade of a snapshot belongs to the next one.
    number = F.floor((F.col("_count") - F.when(F.col("is_duplicate"), 0).otherwise(1)) / interval)
    price = F.when(~F.col("is_duplicate"), F.col("price"))
    value = F.when(~F.col("is_duplicate"), X.trade_value(F.col("price"), F.col("quantity")))
    steps = (
        counted.withColumn("_step", number)
        .groupBy("symbol", "_step")
        .agg(
            F.sum(accepted).alias("trades"),
            F.coalesce(F.sum(price), F.lit(0.0)).alias("_price_sum"),
            F.coalesce(F.sum(value), F.lit(0.0)).alias("total_value"),
            F.count_if("is_duplicate").alias("duplicates"),
            F.count_if(F.col("is_price_spike") & ~F.col("is_duplicate")).alias("spikes"),
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
        )
    )
    merged = [F.sum(c).alias(c) for c in _SUMS]
    merged += [F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price")]
    if carried is not None:
        # A symbol that changed behind the last snapshot is due for the next one.
        due = F.when(F.col("pending"), F.lit(before // interval)).otherwise(-1)
        steps = steps.unionByName(carried.withColumn("_step", due).drop("pending")).groupBy("symbol", "_step").agg(*merged)
    steps = durable(steps.withColumn("_span", F.floor(F.col("_step") / span)))
    pending = (F.max("_step") >= snapshots).alias("pending")
    left = steps.groupBy("symbol").agg(*merged, pending)

    # What a symbol brings into a span, and where it changes after it.
    spans = Window.partitionBy("symbol").orderBy("_span")
    ahead = spans.rowsBetween(Window.unboundedPreceding, -1)
    brought = steps.groupBy("symbol", "_span").agg(*merged, F.min("_step").alias("_first")).select(
        "symbol",
        "_span",
        F.lead("_first").over(spans).alias("_next"),
        F.struct(*[c.alias(n) for n, c in _running(ahead).items()]).alias("_ahead"),
    )
    step = Window.partitionBy("symbol", "_span").orderBy("_step")
    so_far = _running(step.rowsBetween(Window.unboundedPreceding, 0))
    until = F.coalesce(F.lead("_step").over(step), F.col("_next")) - 1
    rows = steps.join(durable(brought), ["symbol", "_span"]).select(
        "symbol",
        "_step",
        until.alias("_until"),
        *[(F.coalesce(F.col("_ahead")[n], F.lit(0)) + so_far[n]).alias(n) for n in _SUMS],
        F.least(F.col("_ahead.min_price"), so_far["min_price"]).alias("min_price"),
        F.greatest(F.col("_ahead.max_price"), so_far["max_price"]).alias("max_price"),
    )
    intervals = rows.filter((F.col("_step") >= 0) & (F.col("_step") < snapshots)).select(
        "symbol",
        ((F.col("_step") + 1) * interval).alias("from_trades"),
        ((F.col("_until") + 1) * interval).alias("to_trades"),
        "trades",
        F.coalesce(F.try_divide("_price_sum", "trades"), F.lit(0.0)).alias("avg_price"),
        "min_price",
        "max_price",
        "total_value",
        "duplicates",
        "spikes",
    )
    return Totals(intervals, left)


def stats_at(intervals: DataFrame, after_trades: int) -> DataFrame:
    """The statistics of every symbol as of a number of accepted trades: the newest interval that had begun."""
    begun = intervals.filter(F.col("from_trades") <= after_trades)
    names = [c for c in intervals.columns if c not in ("symbol", "from_trades", "to_trades")]
    newest = begun.groupBy("symbol").agg(F.max_by(F.struct(*names), "from_trades").alias("_row"))
    return newest.select(F.lit(after_trades).cast("bigint").alias("after_trades"), "symbol", "_row.*")


def stats_snapshots(
    marked: DataFrame,
    interval: int = C.STATS_INTERVAL,
    order_by: Sequence[str] = ARRIVAL,
    span: int = 10_000,
) -> DataFrame:
    """The intervals of :func:`running_totals` written out: a row for every symbol seen so far at every snapshot. That is
    symbols times snapshots rows; to look something up, use the intervals."""
    intervals = durable(running_totals(marked, interval, order_by, span).intervals)
    return every_snapshot(intervals, interval)


def every_snapshot(intervals: DataFrame, interval: int = C.STATS_INTERVAL) -> DataFrame:
    """A row for each symbol and snapshot that the intervals cover, up to the last one."""
    last = intervals.agg(F.max(F.greatest("from_trades", F.coalesce("to_trades", F.lit(0))))).first()[0] or 0
    newest = F.lead("from_trades").over(Window.partitionBy("symbol").orderBy("from_trades"))
    until = F.coalesce("to_trades", newest - interval, F.lit(last))
    rows = intervals.withColumn("to_trades", until)
    moments = F.sequence("from_trades", "to_trades", F.lit(interval).cast("bigint"))
    columns = [c for c in rows.columns if c not in ("symbol", "from_trades", "to_trades")]
    return rows.select(F.explode(moments).alias("after_trades"), "symbol", *columns)
