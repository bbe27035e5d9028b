"""Near-duplicate documents by a multi-index Hamming join of min-hash signatures.

A signature has ``components`` values of b bits, each the low bits of a minimum over the shingles; at
similarity s a component differs with probability 1 - s at most, so a bound on the number of differing
components follows from the binomial law. Signatures are split into chunks such that, by the
pigeonhole principle, two signatures within the bound differ in at most one component of some chunk. The chunk
errors are enumerated: a chunk gives one key for every component left out. Signatures within the bound
thus share a key; nothing within the bound is lost. Links are confirmed on the full shingle sets.

Groups of copies are never expanded into pairs. Equal shingle sets are one node. In every bucket
of a key all nodes are first compared with one of them. Then those outside the bucket's largest component are
compared with all nodes of other components, in blocks. Only pairs within the bound go on to the confirmation, and of
these only such as a bitmap of the shingles, a strict bound on the size of their difference, lets pass.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, map_rows, text_of, with_key

BLOCK, LARGE, BITS = 1024, 32, 1024
BASE = 0x9E3779B97F4A7C15  # odd
SPACES = [9, 10, 11, 12, 13, 32]
GAP = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    components: int = 64
    miss: float = 1e-5  # chance that a pair at exactly the similarity exceeds the bound
    seed: int = 5

    @property
    def bound(self) -> int:
        """Least number of differing components that a linked pair exceeds with probability ``miss`` at most."""
        n, p = self.components, 1 - self.similarity
        tail = [sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(t + 1, n + 1)) for t in range(n)]
        return next((t for t, chance in enumerate(tail) if chance <= self.miss), n - 1)

    @property
    def chunks(self) -> list[range]:
        """Parts of the signature: with so many, one of them has one error at most."""
        parts = self.bound // 2 + 1
        cuts = [round(i * self.components / parts) for i in range(parts + 1)]
        return [range(a, b) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(raw: bytes, least: int = 1 << 20) -> Iterator[bytes]:
    """The text in pieces of about ``least`` bytes that end at white space."""
    start = 0
    while start < len(raw):
        gap = GAP.search(raw, start + least)
        end = gap.start() if gap else len(raw)
        yield raw[start:end]
        start = end


class Shingles:
    """Sorted distinct 64-bit digests of the word shingles of a text.

    A word's digest is a polynomial in a random number for each byte (one for both cases of an ASCII letter), read
    off the running sums of its piece of text, so that no word becomes an object.
    """

    def __init__(self, settings: Settings):
        self.size = settings.shingle
        self.places = multipliers(settings.shingle, settings.seed + 1)
        self.codes = multipliers(256, settings.seed + 2).copy()
        self.codes[65:91] = self.codes[97:123]
        self.gaps = np.isin(np.arange(256), SPACES)
        self.powers = self.inverses = np.ones(0, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.powers):
            for name, base in (("powers", BASE), ("inverses", pow(BASE, -1, 1 << 64))):
                steps = np.full(1 << max(n.bit_length(), 14), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def words(self, piece: bytes) -> np.ndarray:
        raw = np.frombuffer(piece, np.uint8)
        self.grow(len(raw))
        gap = np.ones(len(raw) + 2, np.int8)
        gap[1:-1] = self.gaps[raw]
        edges = np.flatnonzero(np.diff(gap))
        starts, ends = edges[0::2], edges[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.codes[raw] * self.powers[: len(raw)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def __call__(self, text: str) -> np.ndarray:
        parts = [self.words(piece) for piece in pieces(text.encode("utf-8", "replace"))]
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(h):
            return h
        short = len(h) < self.size
        n = 1 if short else len(h) - self.size + 1
        total = np.full(n, len(h) if short else 0, np.uint64)
        for i, a in enumerate(self.places[: len(h)]):
            total += h[i : i + n] * a
        total = np.sort(mixed(total))
        return total[np.append(True, total[1:] != total[:-1])]


def signature(shingles: np.ndarray, settings: Settings) -> bytes:
    a = multipliers(settings.components, settings.seed)
    low = np.full(settings.components, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[start : start + 4096, None] * a[None, :]).min(0))
    return mixed(low).astype(np.uint16).tobytes()


def bitmap(shingles: np.ndarray) -> bytes:
    """A bit for each value that the top bits of a shingle take."""
    marks = np.zeros(BITS, bool)
    marks[(shingles >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


@dataclass
class Sketches:
    """Signatures, bitmaps and sizes of some nodes as arrays."""

    sig: np.ndarray
    bits: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, sig: list[bytes], bits: list[bytes], size: list[int]) -> Sketches:
        n = len(sig)
        return cls(
            np.frombuffer(b"".join(sig), np.uint16).reshape(n, -1),
            np.frombuffer(b"".join(bits), np.uint64).reshape(n, -1),
            np.array(size, np.int64),
        )

    def __getitem__(self, at: np.ndarray) -> Sketches:
        return Sketches(self.sig[at], self.bits[at], self.size[at])


def close(x: Sketches, y: Sketches, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of x and y (or the one row of y) can be linked, and which components differ in each of those.

    Sets of similarity t differ in (1 - t) / (1 + t) of the sum of their sizes at most, and in no
    fewer shingles than their bitmaps in bits; so the bitmaps leave out no linked pair.
    """
    percent = round(100 * settings.similarity)
    apart = np.bitwise_count(x.bits ^ y.bits).sum(1, dtype=np.int64)
    may = np.flatnonzero((100 + percent) * apart <= (100 - percent) * (x.size + y.size))
    differ = x.sig[may] != (y.sig[may] if len(y.sig) == len(x.sig) else y.sig)
    good = np.flatnonzero(differ.sum(1) <= settings.bound)
    return may[good], differ[good]


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Jaccard similarity in whole per cent, without rounding."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= round(100 * similarity) * (len(a) + len(b) - both)


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit digest of a shingle set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, node, sig, bits) per document; node is a 64-bit digest of the shingle
    set; the last three are null for an empty one."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        shingles = Shingles(settings)
        for part in parts:
            sets = [shingles(text) for text in part["text"]]
            nodes = [node_of(s) if len(s) else None for s in sets]
            sigs = [signature(s, settings) if len(s) else None for s in sets]
            yield [part["id"], [len(s) for s in sets], nodes, sigs, [bitmap(s) if len(s) else None for s in sets]]

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return map_rows(narrow, run, f"id {kind}, n_shingles bigint, node bigint, sig binary, bits binary")


def chunk_keys(nodes: DataFrame, settings: Settings) -> DataFrame:
    """(slot, key, node): for every chunk one key for each component left out; slot is that component."""

    def part(start: int, stop: int) -> Column:
        return F.substring("sig", 2 * start + 1, 2 * (stop - start))

    keys = [
        F.xxhash64(F.lit(at), part(chunk.start, at), part(at + 1, chunk.stop)) for chunk in settings.chunks for at in chunk
    ]
    return nodes.select(F.posexplode(F.array(*keys)).alias("slot", "key"), "node")


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are similar. Texts are read for their nodes only."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "rep"), "node")
    texts = docs.select(docs[id_col].alias("rep"), text_of(docs, text_col).alias("text")).join(used, "rep")
    texts = texts.select("node", "text")

    def run(parts: Iterator[dict]) -> Iterator[list]:
        shingles = Shingles(settings)
        memo: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray | None:
            if node not in memo:
                if len(memo) > 200:
                    memo.clear()
                found = shingles(text)
                if node_of(found) != node:  # the text of another document with the same id
                    return None
                memo[node] = found
            return memo[node]

        for part in parts:
            good = []
            for a, b, ta, tb in zip(part["a"], part["b"], part["ta"], part["tb"]):
                x, y = of(a, ta), of(b, tb)
                if x is not None and y is not None and similar(x, y, settings.similarity):
                    good.append((a, b))
            yield [[a for a, _ in good], [b for _, b in good]]

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    both = both.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return durable(map_rows(both.select("a", "b", "ta", "tb"), run, "a bigint, b bigint"))


def near(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose signatures are within the bound and whose bitmaps allow a link."""

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            x, y = (Sketches.of(part["sig_" + s], part["bits_" + s], part["size_" + s]) for s in "ab")
            at, _ = close(x, y, settings)
            yield [[part["a"][i] for i in at], [part["b"][i] for i in at]]

    both = pairs
    for s in "ab":
        both = both.join(nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("sig", "bits", "size")]), s)
    return map_rows(both, run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of the links: root is the same for all nodes that links connect.

    Every node points to its smallest neighbour, links move to what their ends point to, until none is
    left. The tables of a round are written, so that no plan grows with the rounds.
    """
    edges = links.select("a", "b").distinct()
    roots = durable(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")))
    edges = durable(edges)
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy(F.col("a").alias("from")).agg(F.min(F.least("a", "b")).alias("to"))
        twice = step.select(F.col("from").alias("to"), F.col("to").alias("then"))
        step = durable(step.join(twice, "to", "left").select("from", F.least("to", F.coalesce("then", "to")).alias("to")))
        roots = durable(
            roots.join(step, roots["root"] == step["from"], "left").select("node", F.coalesce("to", "root").alias("root"))
        )
        moved = edges.join(step.withColumnsRenamed({"from": "a", "to": "pa"}), "a", "left")
        moved = moved.join(step.withColumnsRenamed({"from": "b", "to": "pb"}), "b", "left")
        ends = moved.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).where("a != b")
        edges = durable(ends.distinct())
    return roots


def across(keys: DataFrame, nodes: DataFrame, roots: DataFrame, settings: Settings, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) that can be linked and share a bucket but not a component, each pair once; with ``nearest`` for
    each node outside a bucket's largest component only the closest one of each block.

    The nodes of a bucket live in blocks. Those outside its largest component also visit every block and meet there
    whoever lives in it; two nodes of the largest component need not meet. Visitors are dealt into slices, so that a
    task has one block and one slice: a block is held in memory, its visitors come one by one. Of all the keys that two
    nodes share, the first one gives the pair.
    """
    rooted = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counted = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = counted.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("roots"))

    def parts(n: Column) -> Column:
        return F.ceil(n / BLOCK).cast("int")

    split = largest.where("roots > 1").select(
        "key", parts(F.col("n")).alias("blocks"), parts(F.col("n") - F.col("top.n")).alias("slices"), F.col("top.root").alias("main")
    )
    rows = rooted.join(split, "key").withColumn("visits", F.col("root") != F.col("main"))
    rows = rows.join(nodes.select("node", "sig", "bits", "size"), "node")

    def cells(of: str, other: str, cell) -> Column:
        mine = F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
        return F.transform(F.sequence(F.lit(0), F.col(other) - 1), lambda at: cell(mine, at))

    home = cells("blocks", "slices", lambda block, slice: F.struct(F.lit(False).alias("guest"), (block * F.col("slices") + slice).alias("cell")))
    visited = cells("slices", "blocks", lambda slice, block: F.struct(F.lit(True).alias("guest"), (block * F.col("slices") + slice).alias("cell")))
    rows = rows.select("*", F.inline(F.when(F.col("visits"), F.concat(home, visited)).otherwise(home)))
    columns = ("key", "cell", "guest", "visits", "slot", "node", "root", "sig", "bits", "size")
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = rows.select(*columns).repartition(n, "key", "cell").sortWithinPartitions("key", "cell", "guest")
    chunks = settings.chunks
    chunk_starts = np.array([c.start for c in chunks])

    def first_slots(differ: np.ndarray) -> np.ndarray:
        """The component left out in the first key that two signatures share, by the components that differ."""
        errors = np.add.reduceat(differ.astype(np.int16), chunk_starts, axis=1)
        chunk = (errors <= 1).argmax(1)
        out = chunk_starts[chunk].copy()
        for row in np.flatnonzero(errors[np.arange(len(chunk)), chunk] == 1):
            part = chunks[chunk[row]]
            out[row] = part.start + int(differ[row, part.start : part.stop].argmax())
        return out

    class Block:
        def __init__(self, rows: list[tuple]):
            self.visits, self.node, self.root = (np.array([r[i] for r in rows]) for i in (0, 1, 2))
            self.sketches = Sketches.of(*([r[i] for r in rows] for i in (3, 4, 5)))

        def meet(self, slot: int, node: int, root: int, guest: Sketches) -> np.ndarray:
            """The nodes of the block that give a pair with the guest."""
            others = self.root != root
            if not nearest:  # two guests meet in the home of either
                others &= ~self.visits | (self.node > node)
            others = np.flatnonzero(others)
            hits, differ = close(self.sketches[others], guest, settings)
            if not len(hits):
                return self.node[:0]
            found = differ.sum(1).argmin(keepdims=True) if nearest else first_slots(differ) == slot
            return self.node[others[hits[found]]]

    def run(parts: Iterator[dict]) -> Iterator[list]:
        at, living, block = None, [], None
        for part in parts:
            a, b = [], []
            for key, number, guest, visits, slot, node, root, sig, bits, size in zip(*(part[c] for c in columns)):
                if at != (key, number):
                    at, living, block = (key, number), [], None
                if not guest:
                    living.append((visits, node, root, sig, bits, size))
                    continue
                block = block or (Block(living) if living else None)
                if block:
                    for other in block.meet(slot, node, root, Sketches.of([sig], [bits], [size])).tolist():
                        a.append(min(node, other))
                        b.append(max(node, other))
            yield [a, b]

    pairs = map_rows(grouped, run, "a bigint, b bigint")
    return pairs.distinct() if nearest else pairs


def classes(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id that links reach), kept (the first of its class).

    Documents are linked if the Jaccard similarity of their shingle sets is at least ``similarity``. A
    text with fewer words than a shingle is one shingle; an empty or null text has none and stands alone. Repeated
    rows are copies; of rows with one id, all are kept or none. Other columns are left out, an empty table gives
    an empty result.
    """
    found = durable(sketches(docs, settings, id_col, text_col))
    firsts = [F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("sig", "bits")], F.first("n_shingles").alias("size")]
    nodes = durable(found.where("node IS NOT NULL").groupBy("node").agg(*firsts))
    every = chunk_keys(nodes, settings)
    sizes = durable(every.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1"))
    keys = durable(every.join(sizes.select("key"), "key", "left_semi"))
    stars = keys.join(sizes.select("key", "first"), "key").where("node != first")  # first is the smaller
    pairs = durable(near(stars.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), nodes, settings))
    links = confirmed(pairs, docs, nodes, settings, id_col, text_col)
    # In large buckets the closest nodes of other components first: that joins most of a group of copies.
    large = sizes.where(F.col("n") > LARGE).select("key")
    nearest = across(keys.join(large, "key", "left_semi"), nodes, components(links), settings, nearest=True)
    nearest = durable(nearest.join(pairs, ["a", "b"], "left_anti"))
    links = links.union(confirmed(nearest, docs, nodes, settings, id_col, text_col))
    rest = across(keys, nodes, components(links), settings)
    rest = durable(rest.join(pairs.union(nearest), ["a", "b"], "left_anti"))
    roots = components(links.union(confirmed(rest, docs, nodes, settings, id_col, text_col)))
    placed = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_node = durable(placed.join(lowest, "root").select("node", "component_id"))
    out = found.select("id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept")
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of near-duplicates, with all its columns: that with the smallest id, null last, and among
    rows of one id that with the smallest digest.

    Repeated rows are copies of each other. Texts without words are in no class and all stay. Columns may have any
    names. An empty table gives an empty result.
    """
    rows = with_key(docs)
    names = dict(zip(docs.columns, rows.columns))
    found = classes(rows, settings, "key", names[text_col])
    ids = rows.select("key", F.col(names[id_col]).alias("id")).distinct()
    of_class = found.where("n_shingles > 0").select("key", "component_id").distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "key")).alias("first")
    kept = durable(of_class.join(ids, "key").groupBy("component_id").agg(first).select(F.col("first.key").alias("key")))
    # Equal rows share a key; where the join has dealt the rows by key, numbering them moves nothing.
    again = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    has_words = text_of(rows, names[text_col]).rlike(r"[^\x20\x09-\x0D]")
    chosen = rows.where(has_words).join(kept, "key", "left_semi").withColumn("again", again).where("again = 1")
    return chosen.select(*names.values()).union(rows.where(~has_words).select(*names.values())).toDF(*docs.columns)
