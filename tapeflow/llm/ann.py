"""Nearest neighbours by collision-counting hashing.

Every vector is projected on a number of random lines; on each line the vectors of a block stand in a sorted
array. A query opens a window around its own place on every line, of a width that belongs to a radius. As the
radius grows (virtual rehashing: no table is built again) the windows take in the next strips at both ends, and only these are read: a vector's
collisions are counted on. Within the radius a vector collides on a known share of the lines on average; one that has collided
on so many, less a margin for chance, is verified on the original vectors, and no other is. A query is done when its
k-th neighbour so far is no farther than the radius.

Vectors and queries are cut into blocks, each pair of blocks is one group, and the blocks' nearest are
merged by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable


@dataclass(frozen=True)
class Settings:
    lines: int = 160
    width: float = 1.0  # half width of a window, in radii
    margin: float = 0.6  # below the collisions expected at the radius, in standard deviations
    start: float = 0.6  # first half width, in standard deviations of the projections
    growth: float = 1.06  # of the radius
    rows_per_block: int = 8192
    queries_per_block: int = 1024
    seed: int = 3

    @property
    def least(self) -> int:
        """Collisions that a vector is verified for: at the radius, all but a few vectors have more."""
        share = math.erf(self.width / math.sqrt(2))
        return max(1, int(self.lines * share - self.margin * math.sqrt(self.lines * share * (1 - share))))


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Block:
    """The sorted arrays of some vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, settings: Settings):
        self.vectors, self.ids, self.settings = vectors, ids, settings
        n, dims = vectors.shape
        self.lines = np.random.default_rng(settings.seed).standard_normal((dims, settings.lines))
        placed = (vectors @ self.lines).T
        order = np.argsort(placed, axis=1, kind="stable")
        self.along = np.take_along_axis(placed, order, 1)
        self.order = order.ravel()  # line by line
        self.start = np.arange(settings.lines) * n

    def edges(self, centres: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """First place inside and first behind the window, by query and line."""
        low = np.stack([np.searchsorted(a, c - width, "left") for a, c in zip(self.along, centres.T)], 1)
        return low, np.stack([np.searchsorted(a, c + width, "right") for a, c in zip(self.along, centres.T)], 1)

    def strips(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The vectors at the places from ``begin`` to ``end`` of every line."""
        sizes = end - begin
        shift = np.repeat(self.start + begin - np.cumsum(sizes) + sizes, sizes)
        return self.order[np.arange(len(shift)) + shift]

    def nearest(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(query, ids, distances, how many were verified) of the ``k`` nearest found for each query."""
        n, least = len(self.ids), self.settings.least
        centres = queries @ self.lines
        low, high = self.edges(centres, 0.0)
        high = low.copy()
        counts = np.zeros((len(queries), n), np.uint16)
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        seen = np.zeros(len(queries), np.int64)
        # A vector can hardly collide often enough while the windows hold a smaller share of the vectors than that.
        spread = float(np.sqrt((self.along.std(1) ** 2).mean())) or float(np.abs(self.along[:, :1] - centres.T).max()) or 1.0
        radius, active = self.settings.start * spread / self.settings.width, np.arange(len(queries))
        while len(active):
            new_low, new_high = self.edges(centres[active], radius * self.settings.width)
            open_queries = []
            for at, query in enumerate(active):
                found = np.concatenate(
                    [self.strips(new_low[at], low[query]), self.strips(high[query], new_high[at])]
                )
                low[query], high[query] = new_low[at], new_high[at]
                more = np.bincount(found, minlength=n)
                count = counts[query]
                before = count >= least
                count += more.astype(np.uint16)
                reached = np.flatnonzero((count >= least) & ~before)
                reached = reached[self.ids[reached] != query_ids[query]]
                if len(reached):
                    seen[query] += len(reached)
                    away = np.sqrt(((self.vectors[reached] - queries[query]) ** 2).sum(1))
                    names, scores = np.append(best[query][0], self.ids[reached]), np.append(best[query][1], away)
                    first = np.lexsort((names, scores))[:k]
                    best[query] = (names[first], scores[first])
                scores = best[query][1]
                if (len(scores) == k and scores[-1] <= radius) or (not low[query].any() and (high[query] == n).all()):
                    yield int(query), *best[query], int(seen[query])
                else:
                    open_queries.append(query)
            active = np.array(open_queries, np.int64)
            radius *= self.settings.growth


def neighbours(
    table: DataFrame, queries: DataFrame, k: int = 10, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest vectors found, by Euclidean distance in
    double precision, ties to the smaller id; all others, if there are fewer.

    Vectors that are null, zero, or hold null or non-finite components take no part, on either side; vectors are
    compared with those of their own length only. Rows with the query's own id are not its neighbours. Rows with
    one id are separate candidates, and every query row has a ranking of its own, also where an id or a whole row is given
    twice. Other columns are left out, empty tables give an empty result.
    """

    def narrow(df: DataFrame) -> DataFrame:
        rows = df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast("array<double>").alias("vector"))
        return rows.where(usable(F.col("vector")) & F.col("id").isNotNull()).withColumn("dims", F.size("vector"))

    vectors = durable(narrow(table))
    asked = narrow(queries).groupBy("id", "vector", "dims").agg(F.count("*").alias("times"))
    asked = durable(asked.withColumn("ask", F.monotonically_increasing_id()))
    blocks = max(1, -(-vectors.count() // settings.rows_per_block))
    parts = max(1, -(-asked.count() // settings.queries_per_block))
    every = {name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for name, n in (("block", blocks), ("part", parts))}
    # Rows are dealt by a hash of the whole row, so that rows of one id do not meet.
    home = {name: F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int") for name, n in (("block", blocks), ("part", parts))}
    left = vectors.withColumn("block", home["block"]).withColumn("part", every["part"])
    right = asked.withColumn("part", home["part"]).withColumn("block", every["block"])

    def search(data: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(ask):
            block = Block(np.array(data["vector"].tolist()), data["id"].to_numpy(), settings)
            numbers = ask["ask"].to_numpy()
            for query, ids, scores, _ in block.nearest(np.array(ask["vector"].tolist()), ask["id"].to_numpy(), k):
                found.append((np.full(len(ids), numbers[query]), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pd.DataFrame(dict(zip(("ask", "vec_id", "score"), columns)))

    keys = ["dims", "block", "part"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "ask long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("ask").orderBy("score", "vec_id"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= k)
    names = asked.select("ask", F.col("id").alias("query_id"), "times")
    each = near.join(names, "ask").withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return each.select("query_id", "rank", "vec_id", "score")
