import datetime as dt
import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeflow import constants as C
from tapeflow.operators import features as FE
from tapeflow.operators import forest as FO
from tapeflow.operators.quantile import exact_quantile
from tapeflow.plans.pipelines import score_windows
from tapeflow.operators.regression import predict_prices, prediction_error

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def windows(spark):
    """Window table: rows per symbol, with gaps in time."""

    def make(seed=1, minutes=200, spike_count=True, **rows_per_symbol):
        draw = random.Random(seed)
        rows = []
        for symbol, count in rows_per_symbol.items():
            for minute in sorted(draw.sample(range(minutes), count)):
                start = START + dt.timedelta(minutes=minute)
                trades = draw.randrange(1, 50)
                price = draw.gauss(3000, 50)
                rows.append(
                    (start, start + dt.timedelta(minutes=1), symbol, trades, price, 1.0,
                     price * trades * draw.uniform(0.5, 2), draw.randrange(3))
                )
        table = spark.createDataFrame(
            rows,
            "window_start timestamp, window_end timestamp, symbol string, trade_count bigint, "
            "avg_price double, sum_qty double, sum_value double, spike_count bigint",
        )
        return table if spike_count else table.drop("spike_count")

    return make


def expected_features(frame):
    out = []
    for _, own in frame.groupby("symbol"):
        own = own.sort_values("window_start").copy()
        price, value = own["avg_price"], own["sum_value"]
        own["rolling_mean_5"] = price.rolling(5, min_periods=1).mean()
        own["rolling_mean_10"] = price.rolling(10, min_periods=1).mean()
        own["rolling_std_5"] = price.rolling(5, min_periods=1).std().fillna(0)
        own["price_change"] = price.diff().fillna(0)
        own["price_change_pct"] = price.pct_change().fillna(0) * 100
        std = value.std()
        own["volume_zscore"] = (value - value.mean()) / std if std > 0 else 0.0
        own["next_price"] = price.shift(-1)
        out.append(own)
    return pd.concat(out).sort_values(["symbol", "window_start"]).reset_index(drop=True)


@pytest.mark.parametrize("block", [None, "7 minutes", "1 hour"])
def test_price_features_against_pandas(windows, block):
    table = windows(A=120, B=15, D=1)
    got = FE.price_features(table, block).toPandas()
    got = got.sort_values(["symbol", "window_start"]).reset_index(drop=True)
    want = expected_features(table.toPandas())
    for name in (*C.PRICE_FEATURES, "next_price"):
        np.testing.assert_allclose(got[name], want[name], rtol=1e-9, atol=1e-7, err_msg=name)


def test_window_features(windows):
    got = FE.window_features(windows(A=50), "5 minutes").orderBy("window_start").toPandas()
    change = got["avg_price"].pct_change().fillna(0) * 100
    np.testing.assert_allclose(got["price_change_pct"], change, atol=1e-9)
    np.testing.assert_allclose(got["value_per_trade"], got["sum_value"] / got["trade_count"])
    np.testing.assert_allclose(got["spike_rate"], got["spike_count"] / got["trade_count"])
    without = FE.window_features(windows(A=5, spike_count=False).withColumn("trade_count", F.lit(0)))
    assert {r.spike_rate for r in without.collect()} == {0.0}
    assert all(r.value_per_trade == r.sum_value for r in without.collect())


def test_constant_volume_has_no_zscore(windows):
    table = windows(A=12).withColumn("sum_value", F.lit(5.0))
    assert {r.volume_zscore for r in FE.price_features(table).collect()} == {0.0}


def test_standardize(windows):
    table = windows(A=30).withColumn("same", F.lit(4.0)).withColumn(
        "holes", F.when(F.col("trade_count") > 20, F.col("avg_price"))
    )
    got = FE.standardize(table, ["avg_price", "same", "holes"]).toPandas()
    price = got["avg_price"]
    np.testing.assert_allclose(got["avg_price_scaled"], (price - price.mean()) / price.std(ddof=0))
    assert (got["same_scaled"] == 0).all()
    holes = got["holes"].fillna(0)
    np.testing.assert_allclose(got["holes_scaled"], (holes - holes.mean()) / holes.std(ddof=0))


def least_squares(own):
    features = own[list(C.PRICE_FEATURES)].to_numpy()
    train = own["next_price"].notna().to_numpy()
    if train.sum() < 10:
        return own["avg_price"].to_numpy()
    mean, std = features[train].mean(axis=0), features[train].std(axis=0)
    scaled = (features - mean) / np.where(std > 0, std, 1)
    target = own["next_price"].to_numpy()[train]
    weights, *_ = np.linalg.lstsq(scaled[train], target - target.mean(), rcond=None)
    return scaled @ weights + target.mean()


def test_prediction_against_least_squares(windows):
    table = windows(A=150, B=40, D=10, E=11)
    got = predict_prices(table, "20 minutes").toPandas().sort_values(["symbol", "window_start"])
    want = expected_features(table.toPandas())
    want = np.concatenate([least_squares(own) for _, own in want.groupby("symbol")])
    np.testing.assert_allclose(got["predicted_price"], want, rtol=1e-6)
    short = got[got["symbol"] == "D"]
    assert (short["predicted_price"] == short["avg_price"]).all()


def test_rank_deficient_symbol(windows):
    # A constant volume: one feature has no spread.
    table = windows(A=60).withColumn("sum_value", F.lit(5.0))
    got = predict_prices(table).toPandas().sort_values("window_start")
    want = least_squares(expected_features(table.toPandas()))
    np.testing.assert_allclose(got["predicted_price"], want, rtol=1e-6)


def test_too_few_rows_for_a_prediction(windows):
    rows = predict_prices(windows(A=14)).collect()
    assert all(r.predicted_price == r.avg_price for r in rows)


def test_columns_do_not_depend_on_the_number_of_rows(windows):
    few, many = windows(A=4), windows(A=40)
    assert predict_prices(few).columns == predict_prices(many).columns
    assert FO.detect_anomalies(few).columns == FO.detect_anomalies(many, trees=5).columns


def test_all_symbols_are_scored(windows):
    table = windows(A=20, B=20, C=20, D=20, E=20)
    assert {r.symbol for r in score_windows(table).collect()} == set("ABCDE")


@pytest.mark.parametrize("rows", [3, 100, 30_000])
def test_every_tree_draws_a_ring_of_rows(spark, rows):
    stored = spark.range(rows).select(F.lit("A").alias("symbol"), F.col("id").alias("_micros"), F.col("id").cast("double").alias("_x0"))
    taken, trees = min(64, rows), 20
    drawn = FO.draw_samples(stored, rows, trees, taken, 1).collect()
    by_tree = {t: {int(r._x0) for r in drawn if r.tree == t} for t in range(trees)}
    ring = 1 << 52
    places = [int(hashlib.md5(f"1:A:{i}".encode()).hexdigest()[:13], 16) for i in range(rows)]
    for t, found in by_tree.items():
        start = t * ring // trees
        assert found == set(sorted(range(rows), key=lambda i: (places[i] - start) % ring)[:taken])


def test_prediction_error(windows):
    table = windows(A=20).withColumn("predicted_price", F.lit(3000.0))
    rows = prediction_error(table, "10 minutes").orderBy("window_start").collect()
    prices = [r.avg_price for r in rows]
    assert [r.pred_error for r in rows] == [3000.0 - p for p in prices]
    assert [r.pred_error_aligned for r in rows] == [*[3000.0 - p for p in prices[1:]], None]


def test_exact_quantile(spark):
    draw = random.Random(3)
    for values in (
        [draw.gauss(0, 1) for _ in range(1000)],
        [draw.choice([0.5, 0.25, 7.0]) for _ in range(300)],
        [1.0, 1.0 + 2**-52, 1.0 + 2**-51],
        [4.0],
    ):
        table = spark.createDataFrame([(v,) for v in values], "v double")
        for share in (0.0, 0.05, 0.5, 0.999, 1.0):
            assert exact_quantile(table, "v", share) == pytest.approx(
                float(np.percentile(values, share * 100)), rel=1e-15
            )


def walk(tree, row):
    nodes = {n: (f, t, length) for n, f, t, length in tree.itertuples(index=False)}
    node = 0
    while True:
        feature, threshold, length = nodes[node]
        if feature < 0:
            return length
        node = 2 * node + (1 if row[feature] <= threshold else 2)


def grown_plainly(points, tree, seed, depth):
    """One tree by a loop, node by node."""

    def drawn(node, what):
        return int(hashlib.md5(f"{seed}:{tree}:{node}:{what}".encode()).hexdigest()[:13], 16)

    nodes, open_nodes = {}, [(0, 0, points)]
    while open_nodes:
        node, level, inside = open_nodes.pop()
        low, high = inside.min(0), inside.max(0)
        varying = np.flatnonzero(high > low)
        if level == depth or not len(varying):
            nodes[node] = (-1, 0.0, level + float(FO.mean_path(len(inside))))
            continue
        k = varying[drawn(node, "feature") % len(varying)]
        cut = low[k] + drawn(node, "cut") / 2.0**52 * (high[k] - low[k])
        cut = cut if cut < high[k] else low[k]
        nodes[node] = (int(k), float(cut), 0.0)
        left = inside[:, k] <= cut
        open_nodes += [(2 * node + 1, level + 1, inside[left]), (2 * node + 2, level + 1, inside[~left])]
    return nodes


def test_trees_and_scores_against_a_loop(spark):
    rng = np.random.default_rng(7)
    trees, depth, seed = 4, 6, 42
    points = rng.normal(size=(trees, 64, 3)).round(2)
    points[:, :, 2] = 1.0
    points[1, :40] = points[1, 0]
    rows = [(t, *map(float, x)) for t in range(trees) for x in points[t]]
    drawn = spark.createDataFrame(rows, "tree bigint, _x0 double, _x1 double, _x2 double")
    got = {(r.tree, r.node): (r.feature, r.threshold, pytest.approx(r.length)) for r in FO.grow(drawn, 3, depth, seed).collect()}
    plain = [grown_plainly(points[t], t, seed, depth) for t in range(trees)]
    assert got == {(t, n): v for t in range(trees) for n, v in plain[t].items()}

    shape = (trees, 2 ** (depth + 1) - 1)
    feature, threshold, length = np.full(shape, -1), np.zeros(shape), np.zeros(shape)
    for t, nodes in enumerate(plain):
        for n, values in nodes.items():
            feature[t, n], threshold[t, n], length[t, n] = values
    every = points.reshape(-1, 3)
    scores = FO.raw_scores(every, feature, threshold, length, 64, depth)
    normal = float(FO.mean_path(64))
    frames = [pd.DataFrame([(n, *v) for n, v in nodes.items()]) for nodes in plain]
    want = [-(2 ** (-np.mean([walk(f, row) for f in frames]) / normal)) for row in every]
    np.testing.assert_allclose(scores, want)


def test_mean_path():
    np.testing.assert_allclose(FO.mean_path([0, 1, 2]), [0, 0, 1])
    assert FO.mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_planted_outliers_score_lowest(windows):
    # Far off in volume and in price.
    planted = F.minute("window_start") == 17
    table = windows(A=150, B=100).withColumns(
        {
            "sum_value": F.when(planted, F.lit(1e9)).otherwise(F.col("sum_value")),
            "avg_price": F.when(planted, F.lit(9000.0)).otherwise(F.col("avg_price")),
        }
    )
    scored = FO.detect_anomalies(table).toPandas().sort_values("anomaly_score")
    planted = (scored["sum_value"] == 1e9).to_numpy()
    assert planted.sum() and planted[: planted.sum()].all()
    assert (scored["anomaly"] == (scored["anomaly_score"] < 0)).all()
    assert scored["anomaly"].sum() == pytest.approx(0.05 * len(scored), abs=1)


def test_scores_do_not_depend_on_partitioning(windows):
    table = windows(A=80, B=40)

    def scores(t):
        rows = FO.detect_anomalies(t, trees=20).collect()
        return {(r.symbol, r.window_start): r.anomaly_score for r in rows}

    one, many = scores(table.coalesce(1)), scores(table.repartition(7))
    assert one.keys() == many.keys()
    assert all(many[k] == pytest.approx(v, abs=1e-9) for k, v in one.items())


def test_under_five_rows_nothing_is_flagged(windows):
    rows = FO.detect_anomalies(windows(A=4)).collect()
    assert [(r.anomaly, r.anomaly_score) for r in rows] == [(False, 0.0)] * 4
