"""The batch form of the whole path: messages to clean trades, window tables and scores."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.blocks import PART, POS, total_order
from ..operators.dedup import mark_duplicates, place_duplicates
from ..operators.forest import detect_anomalies
from ..operators.ingest import enrich_trades, split_rejects, unwrap_messages, validate_trades
from ..operators.regression import predict_prices, prediction_error
from ..operators.reports import filter_symbols
from ..operators.spikes import ARRIVAL, flag_placed, flag_spikes
from ..operators.stats import place_trades
from ..operators.windows import aggregate_sliding, aggregate_tumbling, clean_trades
from ..session import durable


class Ingested(NamedTuple):
    clean: DataFrame
    rejects: DataFrame


def mark_trades(
    valid: DataFrame,
    horizon: int | None = None,
    threshold_pct: float = C.SPIKE_THRESHOLD_PCT,
    order_by: Sequence[str] = ARRIVAL,
    placed: bool = False,
) -> DataFrame:
    """Valid trades with ``is_duplicate`` and ``is_price_spike``, the batch form of the keyed
    stream state: a spike is measured against the previous trade that is not a duplicate. ``placed`` gives the columns
    that running statistics use, by :func:`stats.place_trades`, with one sort for spikes and totals."""
    if placed:
        return place_trades(durable(mark_duplicates(valid, horizon, order_by)), threshold_pct, order_by)
    if horizon is not None:  # one sort is enough for both
        placed = place_duplicates(valid, horizon, total_order(valid, order_by))
        return durable(flag_placed(placed, threshold_pct).drop(PART, POS))
    marked = durable(mark_duplicates(valid, horizon, order_by))
    kept = flag_spikes(marked.filter(~F.col("is_duplicate")), threshold_pct, order_by)
    copies = marked.filter("is_duplicate").withColumn("is_price_spike", F.lit(False))
    return kept.unionByName(copies)


def ingest_messages(
    messages: DataFrame,
    value: str = "value",
    horizon: int | None = None,
    threshold_pct: float = C.SPIKE_THRESHOLD_PCT,
    order_by: Sequence[str] = ARRIVAL,
    source: str = C.SOURCE_NAME,
) -> Ingested:
    """Clean trades and rejects (with ``reject_reason``, duplicates included) of a table of
    messages. Messages are parsed once: the checked rows are written out before they branch."""
    checked = validate_trades(unwrap_messages(messages, value)).drop(value, "raw", "parse_ok")
    accepted, refused = split_rejects(durable(checked))
    marked = mark_trades(accepted, horizon, threshold_pct, order_by)
    copies = marked.filter("is_duplicate").drop("is_duplicate", "is_price_spike")
    rejects = refused.unionByName(
        copies.withColumn("reject_reason", F.lit(C.DUPLICATE)), allowMissingColumns=True
    )
    return Ingested(enrich_trades(marked.filter(~F.col("is_duplicate")), source), rejects)


class WindowTables(NamedTuple):
    tumbling: DataFrame
    sliding: DataFrame


def window_tables(clean: DataFrame, dedup: str | None = "unbounded") -> WindowTables:
    """Both window tables of a table of clean trades."""
    trades = durable(clean_trades(clean, dedup=dedup))
    return WindowTables(aggregate_tumbling(trades), aggregate_sliding(trades))


def score_windows(
    windows: DataFrame, symbols: Sequence[str] | None = None, block: str | None = "1 day"
) -> DataFrame:
    """The window table with anomaly flag and score, predicted price and prediction error; of all
    symbols, or of those given."""
    chosen = durable(windows if symbols is None else filter_symbols(windows, symbols))
    scored = durable(detect_anomalies(chosen, block=block))
    predicted = durable(predict_prices(scored, block))
    return prediction_error(predicted, block)
