"""The price regression as a state that new windows are merged into.

A fit needs counts, means and centred products of a symbol's training rows, and these can be merged: a refresh
reads the new windows and the few before them, not the history. Volumes enter as they are; their z-score, which changes for
all past rows with every new one, is the same column up to shift and scale, so it gives the same predictions.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import durable
from .features import price_features
from .regression import solve_moments

#: The features with the volume in place of its z-score, then the target.
_X = tuple("sum_value" if c == "volume_zscore" else c for c in C.PRICE_FEATURES)
_V = (*_X, "next_price")
_PAIRS = [(i, j) for i in range(len(_V)) for j in range(i, len(_V))]
_FRAME = 9  # windows before a window that its features reach
MOMENTS = "symbol string, n bigint, means array<double>, products array<double>"
TAIL = "symbol string, window_start timestamp, avg_price double, sum_value double"


class PriceState(NamedTuple):
    """``moments`` of the training rows of each symbol, and its last windows as ``tail``, the newest of them not trained on
    yet, since the window behind it is not known."""

    moments: DataFrame
    tail: DataFrame


def no_prices(spark: SparkSession) -> PriceState:
    return PriceState(spark.createDataFrame([], MOMENTS), spark.createDataFrame([], TAIL))


def out_of_order(state: PriceState, windows: DataFrame) -> DataFrame:
    """The symbols that have windows not later than the tail; these cannot be merged."""
    newest = state.tail.groupBy("symbol").agg(F.max("window_start").alias("_newest"))
    first = windows.groupBy("symbol").agg(F.min("window_start").alias("_first"))
    return first.join(newest, "symbol").filter("_first <= _newest").select("symbol")


def merge_windows(state: PriceState, windows: DataFrame, block: str | None = "1 day") -> PriceState:
    """The state after new windows, all of them later than the tail of their symbol. Both tables of the state are read
    several times: hand over stored tables."""
    columns = ["symbol", "window_start", "avg_price", "sum_value"]
    newest = Window.partitionBy("symbol").orderBy(F.col("window_start").desc())
    place = F.row_number().over(newest)
    past = state.tail.withColumn("_known", place > 1)  # trained on already
    rows = durable(past.select(*columns, "_known").union(windows.select(*columns, F.lit(False))))
    features = price_features(rows, block).filter("NOT _known AND next_price IS NOT NULL")
    fresh = features.groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(c) for c in _V]).alias("means"),
        F.array(*[F.covar_pop(_V[i], _V[j]) * F.count("*") for i, j in _PAIRS]).alias("products"),
    )
    # Of a symbol that brings nothing new the tail stays. Every task keeps the last rows of a symbol only.
    tail = rows.withColumn("_place", place).filter(F.col("_place") <= _FRAME + 1).select(*columns)
    return PriceState(merge_moments(state.moments, fresh), tail)


def merge_moments(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts, means and centred products of two sets of rows taken together."""
    a, b = ([F.col(f"{side}.{c}") for c in ("n", "means", "products")] for side in ("a", "b"))
    total = a[0] + b[0]

    def apart(k: Column | int) -> Column:
        return b[1][k] - a[1][k]

    means = F.array(*[a[1][k] + apart(k) * b[0] / total for k in range(len(_V))])
    products = [a[2][p] + b[2][p] + apart(i) * apart(j) * a[0] * b[0] / total for p, (i, j) in enumerate(_PAIRS)]
    both = old.alias("a").join(new.alias("b"), F.col("a.symbol") == F.col("b.symbol"), "full")
    lonely = [F.coalesce(x, y) for x, y in zip(a, b)]
    merged = [total, means, F.array(*products)]
    known = F.col("a.n").isNotNull() & F.col("b.n").isNotNull()
    columns = [F.when(known, m).otherwise(o).alias(c) for c, m, o in zip(("n", "means", "products"), merged, lonely)]
    return both.select(F.coalesce("a.symbol", "b.symbol").alias("symbol"), *columns)


def price_models(state: PriceState) -> DataFrame:
    """(symbol, intercept, weights) of the symbols with enough training rows; the weights belong to :data:`_X`."""
    enough = state.moments.filter(F.col("n") >= C.PREDICT_MIN_TRAINING_ROWS)
    last = len(_X)

    def products(pairs: Sequence[tuple[int, int]]) -> Column:
        return F.array(*[F.col("products")[_PAIRS.index(p)] / F.col("n") for p in pairs])

    inner = [(i, j) for i, j in _PAIRS if j < last]
    moments = enough.select(
        "symbol",
        "n",
        F.col("means")[last].alias("mean"),
        F.slice("means", 1, last).alias("means"),
        products(inner).alias("products"),
        products([(i, last) for i in range(last)]).alias("targets"),
    )
    return solve_moments(moments)


def predict_from_state(state: PriceState, windows: DataFrame, block: str | None = "1 day") -> DataFrame:
    """``windows`` with ``predicted_price`` from the models of the state; the price itself for symbols without one. Features
    reach back to the windows given, so give those of the tail with new ones."""
    features = durable(price_features(windows, block))
    models = durable(price_models(state))
    linear = F.col("intercept")
    for k, name in enumerate(_X):
        linear = linear + F.col("weights")[k] * F.col(name)
    scored = features.join(models, "symbol", "left").withColumn("predicted_price", F.coalesce(linear, F.col("avg_price")))
    return scored.select(*windows.columns, "predicted_price")
