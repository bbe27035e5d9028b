"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) over window tables."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import durable
from .features import window_features
from .quantile import exact_quantile

_BITS = 52  # of a drawn number: exact in a double


def mean_path(count):
    """Mean length of an unsuccessful search among ``count`` rows."""
    count = np.asarray(count, dtype=float)
    harmonic = np.log(np.maximum(count - 1, 1)) + np.euler_gamma
    long = 2 * harmonic - 2 * (count - 1) / np.maximum(count, 1)
    return np.where(count > 2, long, np.where(count == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as dense arrays (tree, node) in breadth-first numbering, the features they cut and the sample size: node k has
    children 2k+1 and 2k+2. A leaf has feature -1 and the path length of a row that ends there."""

    feature: np.ndarray
    threshold: np.ndarray
    length: np.ndarray
    columns: tuple[str, ...]
    sample: int
    depth: int


def raw_scores(rows: np.ndarray, feature, threshold, length, sample: int, depth: int) -> np.ndarray:
    """-2^(-mean path / c(sample)); lower is more anomalous."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for splits, cuts, lengths in zip(feature, threshold, length):
        node = np.zeros(len(rows), dtype=np.int64)
        for _ in range(depth):
            split = splits[node]
            right = rows[every, np.maximum(split, 0)] > cuts[node]
            node = np.where(split >= 0, 2 * node + 1 + right, node)
        total += lengths[node]
    return -np.exp2(-total / len(feature) / float(mean_path(sample)))


def drawn_number(*parts: Column) -> Column:
    """A whole number below 2^52 from a digest of the parts, the same in every engine."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("bigint")


def plain(name: str) -> Column:
    """A feature; null and NaN count as 0."""
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0))


def fit_forest(
    features: DataFrame,
    columns: list[str],
    trees: int = C.FOREST_TREES,
    sample: int = C.FOREST_SAMPLE,
    seed: int = C.FOREST_SEED,
) -> Forest:
    """Grow the forest; the driver gets the grown trees, ``trees`` times fewer than two ``sample`` nodes.

    All trees grow at once, level by level, the rows of a tree in one task. A cut is a drawn
    fraction of a feature's range in the node, so scaling the features would not change a tree. Draws are
    digests of seed, tree and node, and the rows of a tree follow from digests of (symbol, window), so
    partitioning changes nothing and SQL can repeat it.
    """
    stored = durable(
        features.select(
            "symbol",
            F.unix_micros("window_start").alias("_micros"),
            *[plain(c).alias(f"_x{k}") for k, c in enumerate(columns)],
        )
    )
    rows = stored.count()
    taken = min(sample, rows)
    depth = int(np.ceil(np.log2(max(taken, 2))))
    drawn = draw_samples(stored, rows, trees, taken, seed)
    grown = grow(drawn, len(columns), depth, seed).toPandas()
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int64)
    threshold = np.zeros((trees, nodes))
    length = np.zeros((trees, nodes))
    at = (grown["tree"].to_numpy(), grown["node"].to_numpy())
    feature[at], threshold[at], length[at] = grown["feature"], grown["threshold"], grown["length"]
    return Forest(feature, threshold, length, tuple(columns), taken, depth)


def draw_samples(stored: DataFrame, rows: int, trees: int, taken: int, seed: int) -> DataFrame:
    """``tree`` and the row: ``taken`` rows for each tree.

    Rows stand on a ring by their digest, trees at equal distances; a tree takes the first rows behind its
    place. So one digest a row gives every tree a random sample; the samples of neighbours overlap if the rows are
    fewer than ``trees`` times ``taken``, and are apart if they are many more. Only rows in an arc that should hold a
    few more than needed are shuffled; the arcs widen if a tree comes out short.
    """
    whole = 1 << _BITS
    ring = stored.withColumn("_u", drawn_number(F.lit(seed), F.col("symbol"), F.col("_micros")))
    spare = 1.5
    while True:
        arc = min(whole, int(whole * spare * taken / max(rows, 1)) + 1)
        # The last tree at or before a row, and as many before it as an arc can span.
        last = F.floor(F.col("_u") * trees / F.lit(whole))
        reach = min(trees - 1, arc * trees // whole + 1)
        each = ring.withColumn("tree", F.explode(F.sequence(last - reach, last)))
        each = each.withColumn("tree", F.pmod("tree", F.lit(trees)))
        place = F.floor(F.col("tree") * F.lit(whole) / trees)
        each = each.withColumn("_behind", F.pmod(F.col("_u") - place, F.lit(whole))).filter(F.col("_behind") < arc)
        order = Window.partitionBy("tree").orderBy("_behind", "symbol", "_micros", *[c for c in stored.columns if c[:2] == "_x"])
        ranked = each.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= taken)
        ranked = durable(ranked.drop("_u", "_behind", "_rank", "symbol", "_micros"))
        if ranked.count() == trees * taken or arc == whole:
            return ranked
        spare *= 2


def grow(drawn: DataFrame, features: int, depth: int, seed: int) -> DataFrame:
    """(tree, node, feature, threshold, length) of all nodes. The windows of all levels work on one exchange by tree.

    Every level is the same three projections, with its number in a column, so Spark compiles their code once.
    """
    names = [f"_x{k}" for k in range(features)]
    node = "OVER (PARTITION BY tree, node)"
    ranges = ", ".join(f"named_struct('k', {k}, 'low', min({c}) {node}, 'high', max({c}) {node})" for k, c in enumerate(names))
    varying = "filter(_ranges, r -> r.high > r.low)"

    def drawn_at(what: str) -> str:
        text = f"concat_ws(':', '{seed}', tree, node, '{what}')"
        return f"CAST(conv(substring(md5({text}), 1, {_BITS // 4}), 16, 10) AS BIGINT)"

    place = f"CAST(pmod({drawn_at('feature')}, greatest(size({varying}), 1)) + 1 AS INT)"
    cut = "_cut.low + _share * (_cut.high - _cut.low)"
    at = f"CASE WHEN {cut} < _cut.high THEN {cut} ELSE _cut.low END"  # both sides keep a row
    euler = float(np.euler_gamma)
    many = f"2 * (ln(greatest(_n - 1, 1)) + {euler}D) - 2 * (_n - 1) / _n"
    leaf = f"_level + CASE WHEN _n > 2 THEN {many} WHEN _n = 2 THEN 1D ELSE 0D END"
    entry = (
        "named_struct('node', node, 'feature', coalesce(_cut.k, -1), "
        f"'threshold', coalesce({at}, 0D), 'length', CASE WHEN _cut IS NULL THEN {leaf} ELSE 0D END)"
    )
    value = f"element_at(array({', '.join(names)}), coalesce(_cut.k + 1, 1))"
    kind = "array<struct<node:bigint,feature:int,threshold:double,length:double>>"
    rows = drawn.repartition("tree").selectExpr(
        "tree", *names, "0L AS node", "0D AS _level", "true AS _open", f"CAST(array() AS {kind}) AS _path"
    )
    kept = ("tree", *names)
    for _ in range(depth + 1):
        rows = rows.selectExpr("*", f"count(*) {node} AS _n", f"array({ranges}) AS _ranges")
        rows = rows.selectExpr(
            *kept,
            "node",
            "_level",
            "_open",
            "_path",
            "_n",
            f"CASE WHEN _open AND _level < {depth} THEN try_element_at({varying}, {place}) END AS _cut",
            f"{drawn_at('cut')} / {float(1 << _BITS)!r}D AS _share",
        )
        rows = rows.selectExpr(
            *kept,
            f"CASE WHEN _cut IS NULL THEN node ELSE 2 * node + CASE WHEN {value} <= {at} THEN 1 ELSE 2 END END AS node",
            "_level + 1 AS _level",
            "_cut IS NOT NULL AS _open",
            f"CASE WHEN _open THEN array_append(_path, {entry}) ELSE _path END AS _path",
        )
    return rows.select("tree", F.inline("_path")).distinct()


def score_rows(features: DataFrame, forest: Forest) -> DataFrame:
    """Add ``_raw``, the raw score of each row."""
    trees = (forest.feature, forest.threshold, forest.length, forest.sample, forest.depth)
    shared = features.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def raw(x: pd.DataFrame) -> pd.Series:
        return pd.Series(raw_scores(x.to_numpy(dtype=float), *shared.value))

    return features.withColumn("_raw", raw(F.struct(*[plain(c).alias(c) for c in forest.columns])))


def detect_anomalies(
    df: DataFrame,
    contamination: float = C.FOREST_CONTAMINATION,
    trees: int = C.FOREST_TREES,
    sample: int = C.FOREST_SAMPLE,
    seed: int = C.FOREST_SEED,
    block: str | None = "1 day",
    least: int = C.ANOMALY_MIN_ROWS,
) -> DataFrame:
    """Add ``anomaly`` and ``anomaly_score`` (lower is more anomalous, negative is flagged) and
    the feature columns. The forest is fitted over all symbols together. Under
    ``least`` rows nothing is flagged; the columns are the same.
    """
    features = durable(window_features(df, block))
    columns = [c for c in C.ANOMALY_FEATURES if c in features.columns]
    rows = features.count()
    if rows < least:
        return features.withColumns({"anomaly": F.lit(False), "anomaly_score": F.lit(0.0)})
    forest = fit_forest(features, columns, trees, sample, seed)
    scored = durable(score_rows(features, forest))
    offset = exact_quantile(scored, "_raw", contamination, rows)
    score = F.col("_raw") - F.lit(offset)
    return scored.withColumns({"anomaly": score < 0, "anomaly_score": score}).drop("_raw")
