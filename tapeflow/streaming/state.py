"""Memory per symbol, carried as a table from one micro-batch to the next: recent trade ids and the last price."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.blocks import PART, POS, total_order
from ..operators.dedup import duplicates_across, place_duplicates
from ..operators.spikes import ARRIVAL, flag_placed
from ..operators.stats import count_placed
from ..session import durable

#: The last accepted trades of each symbol; ``_seq`` ascends with their order.
MEMORY = "symbol string, _seq bigint, trade_id bigint, price double"
_PAST_PARTS = 64


class Marked(NamedTuple):
    trades: DataFrame
    memory: DataFrame


def no_memory(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MEMORY)


def mark_batch(
    valid: DataFrame,
    memory: DataFrame,
    horizon: int = C.DEDUP_HORIZON,
    threshold_pct: float = C.SPIKE_THRESHOLD_PCT,
    order_by: Sequence[str] = ARRIVAL,
) -> Marked:
    """Add ``is_duplicate`` (id among the last ``horizon`` accepted ids of the symbol) and ``is_price_spike`` (against the
    previous accepted trade) to a batch of valid trades, and give the memory to carry on.

    The remembered trades go ahead of the batch as if they were part of it; batch operators do the rest, so a hot symbol is
    cut into parts like any table. They are sorted once, for ids, prices and memory. The memory holds ``horizon`` rows a
    symbol at most. The order reads ``valid`` three times: hand over a stored table.

    Trades that have ``_part`` and ``_pos``, as they arrived, are in order already and are not sorted; the result keeps
    both, and :func:`stats.running_totals` takes it as it is.
    """
    placed = PART in valid.columns
    past = memory.withColumn("_new", F.lit(False))
    if placed:  # all remembered trades of a symbol in one part, ahead of those of the batch
        part = -1 - F.pmod(F.xxhash64("symbol"), F.lit(_PAST_PARTS))
        past = past.withColumns({PART: part, POS: F.col("_seq")})
    rows = valid.withColumn("_new", F.lit(True)).unionByName(past, allowMissingColumns=True)
    if placed:
        marked = durable(count_placed(duplicates_across(rows, horizon), threshold_pct))
        result = marked.filter("_new").drop("_new", "_seq")
    else:
        order = total_order(rows, ["_new", "_seq", *order_by])
        marked = durable(flag_placed(place_duplicates(rows, horizon, order), threshold_pct))
        result = marked.filter("_new").drop("_new", "_seq", PART, POS)
    # Spark keeps so many rows of a symbol in each task before they meet.
    newest = Window.partitionBy("symbol").orderBy(F.col(PART).desc(), F.col(POS).desc())
    kept = marked.filter("not is_duplicate").withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= horizon)
    kept = kept.select("symbol", (-F.col("_age")).cast("bigint").alias("_seq"), "trade_id", "price")
    return Marked(result, kept)
