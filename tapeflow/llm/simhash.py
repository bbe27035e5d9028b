"""Near-duplicates by SimHash and anchor-point covering.

Fingerprints within t bits of each other differ in few bits of one of their two halves (in t // 2 of the
first, or in t - t // 2 - 1 of the second). Of each half the anchors are a covering code: the words of the
(31, 26) Hamming code with the last bit free, such that every half has an anchor at distance 1 at most, its
home. A fingerprint is copied to every anchor within 1 + t' bits of a half, t' being the bits that may differ there;
so of two halves that differ in t' bits each visits the other's home. Fingerprints are compared anchor by anchor:
those at home with the visitors, on all 64 bits.

Equal fingerprints are one node, and an anchor gives a forest of its links and not all pairs. An anchor with
many residents is cut into blocks of residents and slices of visitors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, map_rows, shuffle_parts, text_of
from .neardup import components, pieces

RADIUS = 1  # every half has an anchor as near as this
BLOCK = 2048  # residents of an anchor that are held together
PAIRS = 1 << 21  # comparisons made at a time


# Fingerprints ---------------------------------------------------------------------------------


def bit_counts(digests: bytes) -> np.ndarray:
    """How often each of 64 bits, the highest first, is set among 8-byte digests."""
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).view(np.uint64).reshape(-1, 8)
    # Eight counters of a byte each in a word hold 255 rows.
    some = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
    return some.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)


def fingerprint(text: str, size: int = 4, seed: int = 42) -> int:
    """A bit is set if it is set in more than half of the XXH64 digests of the word shingles, repeats included. With
    fewer words than a shingle all of them are one; without words it is 0."""
    counts, n, carried = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_digest
    for piece in pieces(text.encode("utf-8", "replace")):
        words = carried + piece.lower().split()
        carried = words[max(len(words) - size + 1, 0) :]
        if len(words) < size:
            continue
        joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths - 1
        ends = (starts + lengths)[size - 1 :].tolist()
        found = b"".join([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends)])
        counts += bit_counts(found)
        n += len(ends)
    if not n and carried:
        counts, n = bit_counts(digest(b" ".join(carried), seed)), 1
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print): the fingerprint as a signed number."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            yield [part["id"], [fingerprint(text, size) for text in part["text"]]]

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return map_rows(narrow, run, f"id {kind}, print bigint")


# Anchors --------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _syndromes() -> np.ndarray:
    """By byte of a half and its value: the exclusive or of the places (1 to 31) of its bits; the last bit has none."""
    place = np.append(np.arange(1, 32), 0)
    values = np.arange(256)
    table = np.zeros((4, 256), np.int64)
    for byte in range(4):
        for bit in range(8):
            table[byte] ^= np.where(values >> bit & 1, place[8 * byte + bit], 0)
    return table


def syndrome(half: np.ndarray) -> np.ndarray:
    table = _syndromes()
    return table[0][half & 255] ^ table[1][half >> 8 & 255] ^ table[2][half >> 16 & 255] ^ table[3][half >> 24]


def home(half: np.ndarray) -> np.ndarray:
    """The anchor at distance 1 at most."""
    s = syndrome(half)
    return np.where(s > 0, half ^ (1 << np.maximum(s - 1, 0)), half)


@lru_cache(maxsize=4)
def _differences(radius: int) -> list[np.ndarray]:
    """By syndrome: what takes a half of that syndrome to an anchor within the radius."""
    masks = [sum(1 << b for b in bits) for weight in range(radius + 1) for bits in combinations(range(32), weight)]
    masks = np.array(masks, np.int64)
    s = syndrome(masks)
    return [masks[s == k] for k in range(32)]


def anchors(half: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for all anchors within the radius of each half."""
    s = syndrome(half)
    rows, found = [], []
    for k, masks in enumerate(_differences(radius)):
        at = np.flatnonzero(s == k)
        rows.append(np.repeat(at, len(masks)))
        found.append((half[at, None] ^ masks).ravel())
    return np.concatenate(rows), np.concatenate(found)


def halves(prints: np.ndarray, distance: int) -> list[tuple[int, np.ndarray, int]]:
    """(number, half, bits that may differ there): two fingerprints within the distance agree so far in one half."""
    whole = prints.view(np.uint64)
    both = ((whole >> np.uint64(32)).astype(np.int64), (whole & np.uint64(0xFFFFFFFF)).astype(np.int64))
    apart = (distance // 2, distance - distance // 2 - 1)
    return [(i, half, most) for i, (half, most) in enumerate(zip(both, apart)) if most >= 0]


def copies(prints: DataFrame, distance: int, guests: bool) -> DataFrame:
    """(anchor, print): every fingerprint at home, or as a guest at every anchor near enough, its home among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy()
            for start in range(0, len(every), 2048):
                some = every[start : start + 2048]
                for number, half, most in halves(some, distance):
                    if guests:
                        rows, found = anchors(half, RADIUS + most)
                    else:
                        rows, found = np.arange(len(some)), home(half)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found | number << 32), pa.array(some[rows])], names=["anchor", "print"]
                    )

    return prints.select("print").mapInArrow(run, "anchor bigint, print bigint")


# Links ----------------------------------------------------------------------------------------


def forest(place: np.ndarray, other: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which links (guest, resident) to keep: the first one of each guest, and those that join residents not joined so far.

    ``place`` ascends; ``labels`` says which residents are known to be joined and is brought up to date.
    """
    own = labels[other]
    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    first = np.repeat(own[start], np.diff(np.append(start, len(place))))
    keep = np.zeros(len(place), bool)
    keep[start] = True
    apart = np.flatnonzero(own != first)
    if len(apart):
        _, one = np.unique(first[apart] * len(labels) + own[apart], return_index=True)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        for at in apart[one]:
            a, b = root(int(first[at])), root(int(own[at]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                keep[at] = True
        for x in list(parent):
            parent[x] = root(x)
        if parent:
            table = np.arange(len(labels))
            table[list(parent)] = list(parent.values())
            labels[:] = table[labels]
    return keep


def links(prints: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links between fingerprints (column ``print``, distinct) within the distance; all that are linked are
    connected by these, but links that only repeat a connection are left out."""
    prints = prints.select("print").repartition(shuffle_parts(prints), "print")
    residents = durable(copies(prints, distance, guests=False))
    crowded = residents.groupBy("anchor").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts")).where("cuts > 1")
    crowded = durable(crowded)

    def placed(rows: DataFrame, guest: bool) -> DataFrame:
        """Cut by a hash into blocks (residents) or slices (guests), each copied to all slices (blocks)."""
        rows = rows.join(crowded, "anchor", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
        mine = F.pmod(F.xxhash64("print"), F.col("cuts")).cast("int")
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        cell = F.col("other") * F.col("cuts") + mine if guest else mine * F.col("cuts") + F.col("other")
        return rows.select("anchor", cell.alias("cell"), F.lit(guest).alias("guest"), "print")

    both = placed(residents, False).union(placed(copies(prints, distance, guests=True), True))
    both = both.repartition(shuffle_parts(prints), "anchor", "cell").sortWithinPartitions("anchor", "cell", "guest")

    def compared(batch: pa.RecordBatch, held: tuple) -> tuple[tuple, list[pa.RecordBatch]]:
        """Links of the guests of a batch, and the residents of its last cell, for the guests in the next."""
        anchor, cell, value = (batch.column(i).to_numpy() for i in (0, 1, 3))
        at_home = ~batch.column(2).to_numpy(zero_copy_only=False)
        if held is not None:
            anchor, cell, value = (np.append(x, y) for x, y in zip(held, (anchor, cell, value)))
            at_home = np.append(np.ones(len(held[0]), bool), at_home)
        lives = np.flatnonzero(at_home)
        if not len(lives):
            return None, []
        keys = np.stack([anchor[lives], cell[lives]])
        new = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(lives)))
        # The cell of residents last seen before each guest; the guest's own if the keys agree.
        last = np.cumsum(np.isin(np.arange(len(anchor)), lives[begin])) - 1
        guests = np.flatnonzero(~at_home & (last >= 0))
        of = last[guests]
        same = (anchor[guests] == keys[0][begin[of]]) & (cell[guests] == keys[1][begin[of]])
        guests, of = guests[same], of[same]
        tail = lives[begin[-1] :]
        kept = (anchor[tail], cell[tail], value[tail]) if (anchor[-1], cell[-1]) == (anchor[tail[0]], cell[tail[0]]) else None
        labels, out = np.arange(len(lives)), []
        width = np.cumsum(count[of])
        start = 0
        while start < len(guests):
            stop = max(start + 1, int(np.searchsorted(width, (width[start - 1] if start else 0) + PAIRS, "right")))
            n = count[of[start:stop]]
            row = np.repeat(np.arange(start, stop), n)
            other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[of[row]]
            x, y = value[guests[row]], value[lives[other]]
            near = np.flatnonzero((x > y) & (np.bitwise_count((x ^ y).view(np.uint64)) <= distance))
            if len(near):
                near = near[forest(row[near], other[near], labels)]
                out.append(pa.RecordBatch.from_arrays([pa.array(y[near]), pa.array(x[near])], names=["a", "b"]))
            start = stop
        return kept, out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                held, out = compared(batch, held)
                yield from out

    return both.mapInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame, distance: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (the smallest id that links reach), kept (the
    first of its class).

    Documents are linked if their fingerprints differ in ``distance`` bits at most. A text without words, an
    empty or a null one, has the fingerprint 0, linked like any other. Repeated rows are copies of each other. A row with
    a null id takes part; its class is null only if no member has an id. Other columns are left out, an empty table gives
    an empty result.
    """
    found = durable(fingerprints(docs, shingle, id_col, text_col))
    known = durable(found.groupBy("print").agg(F.min("id").alias("first")))
    near = durable(links(known, distance))
    joined = known.join(components(near).withColumnRenamed("node", "print"), "print", "left")
    joined = joined.withColumn("root", F.coalesce("root", "print"))
    lowest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = durable(joined.join(lowest, "root").select("print", "component_id"))
    text = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.join(of_print, "print").select(
        F.col("id").alias(id_col), text.alias("fingerprint"), "component_id", (F.col("component_id") == F.col("id")).alias("kept")
    )
