"""Price of the next window by linear regression per symbol."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import durable
from .features import framed, price_features

_X = C.PRICE_FEATURES
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i, len(_X))]
# Squared singular values below this share of the largest count as zero.
_CUTOFF = 1e-12


def fit_prices(features: DataFrame) -> DataFrame:
    """Ordinary least squares of ``next_price`` on the six features, one row per symbol:
    symbol, intercept, weights. Symbols with too few training rows are absent.

    One aggregate gathers means and centred products; Spark merges partial results, so the size
    of a symbol does not matter. Python only solves one 6x6 system per symbol.
    """
    training = features.filter(F.col("next_price").isNotNull())
    moments = training.groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.avg("next_price").alias("mean"),
        F.array(*[F.avg(c) for c in _X]).alias("means"),
        F.array(*[F.covar_pop(_X[i], _X[j]) for i, j in _PAIRS]).alias("products"),
        F.array(*[F.covar_pop(c, "next_price") for c in _X]).alias("targets"),
    )
    return solve_moments(moments.filter(F.col("n") >= C.PREDICT_MIN_TRAINING_ROWS))


def solve_moments(moments: DataFrame) -> DataFrame:
    """(symbol, intercept, weights) from a row of moments for each symbol: ``mean`` of the target, ``means`` of the
    features, their covariances pair by pair (``products``) and with the target (``targets``)."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            products = np.stack(batch["products"].to_numpy())
            targets = np.stack(batch["targets"].to_numpy())
            means = np.stack(batch["means"].to_numpy())
            gram = np.zeros((len(batch), len(_X), len(_X)))
            for k, (i, j) in enumerate(_PAIRS):
                gram[:, i, j] = gram[:, j, i] = products[:, k]
            scale = np.sqrt(np.diagonal(gram, axis1=1, axis2=2))
            scale = np.where(scale > 0, scale, 1.0)
            gram = gram / (scale[:, :, None] * scale[:, None, :])
            inverse = np.linalg.pinv(gram, rcond=_CUTOFF, hermitian=True)
            weights = np.einsum("nij,nj->ni", inverse, targets / scale) / scale
            intercept = batch["mean"].to_numpy() - (weights * means).sum(axis=1)
            yield pd.DataFrame(
                {"symbol": batch["symbol"], "intercept": intercept, "weights": list(weights)}
            )

    return moments.mapInPandas(solve, "symbol string, intercept double, weights array<double>")


def predict_prices(
    df: DataFrame, block: str | None = "1 day", least: int = C.PREDICT_MIN_ROWS
) -> DataFrame:
    """Add ``predicted_price``, the expected price of the next window, and the feature columns.

    Under ``least`` rows in all, or under 10 training rows in a symbol, the price itself is given;
    the columns are the same.
    """
    price = F.col("avg_price")
    features = durable(price_features(df, block))
    if features.count() < least:
        return features.withColumn("predicted_price", price).drop("next_price")
    # The models are written out, so that their size is known when the join is planned.
    models = durable(fit_prices(features))
    linear = F.col("intercept")
    for k, name in enumerate(_X):
        linear = linear + F.col("weights")[k] * F.col(name)
    return (
        features.join(models, "symbol", "left")
        .withColumn("predicted_price", F.coalesce(linear, price))
        .drop("intercept", "weights", "next_price")
    )


def prediction_error(df: DataFrame, block: str | None = "1 day") -> DataFrame:
    """Add ``pred_error`` (prediction less this window's price) and ``pred_error_aligned`` (less
    the price of the window that was predicted; null for the last one)."""
    price = F.col("avg_price")
    ahead = framed(df, {"_next": lambda w: F.lead(price).over(w)}, before=0, after=1, block=block)
    return ahead.withColumns(
        {
            "pred_error": F.col("predicted_price") - price,
            "pred_error_aligned": F.col("predicted_price") - F.col("_next"),
        }
    ).drop("_next")
