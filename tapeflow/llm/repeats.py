"""Exact removal of repeated byte strings.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere else as well. Every start of such
a string, a window, is keyed by the smallest digest of its ``gram``-byte strings, which depends on the bytes of the
window alone: equal windows have equal keys. Neighbouring windows with one key form a run, and runs are what
is shuffled, about one per 90 bytes. A key with a single run is done. Runs that are equal as a whole are
repeated as a whole. Only different runs under one key are compared window by window.

The README says why this stands in place of external induced sorting.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, map_rows, text_of
from .neardup import mixed

FACTOR = np.uint64(0x9E3779B97F4A7C15)
LETTERS = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 32
    group: int = 4096  # keys with more different runs are compared through a shuffle of their windows


def power(n: int) -> np.uint64:
    return np.uint64(pow(int(FACTOR), n, 1 << 64))


def digests(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """64-bit digests of all strings of each size, put together from those of powers of two."""
    powers = {1: LETTERS[data]}
    while 2 * max(powers) <= max(sizes):
        n = max(powers)
        powers[2 * n] = powers[n][:-n] * power(n) + powers[n][n:]
    out = []
    for size in sizes:
        count, at, total = len(data) - size + 1, 0, np.zeros(len(data) - size + 1, np.uint64)
        for n in sorted(powers, reverse=True):
            if size - at >= n:
                total = total * power(n) + powers[n][at : at + count]
                at += n
        out.append(total)
    return out


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    rest = width - n
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def runs_of(data: np.ndarray, settings: Settings):
    """(key, digest, start, windows) of the runs of a text, then the stretches of windows that recur in it."""
    gram, window = digests(data, (settings.gram, settings.length))
    width = settings.length - settings.gram + 1
    key = lowest(mixed(gram), width)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    if sizes.max() > width:  # cut, so that first and last window of a run cover it
        parts = -(-sizes // width)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + within * width
        sizes = np.minimum(np.repeat(sizes, parts) - within * width, width)
    digest = mixed(window[starts] * FACTOR + window[starts + sizes - 1]) + sizes.astype(np.uint64)
    ordered = np.sort(window)
    same = ordered[1:] == ordered[:-1]
    inner = stretches(np.isin(window, ordered[1:][same])) if same.any() else (np.zeros(0, np.int64),) * 2
    return (key[starts], digest, starts, sizes), inner


def all_runs(docs: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, key, digest, start, windows); rows without a key are stretches that recur in their text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            for one, text_key, text in zip(part["id"], part["text_key"], part["text"]):
                data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                if len(data) < settings.length:
                    continue
                (key, digest, start, size), (a, b) = runs_of(data, settings)
                n = len(key) + len(a)
                none = [None] * len(a)
                yield [
                    [one] * n,
                    [text_key] * n,
                    key.view(np.int64).tolist() + none,
                    digest.view(np.int64).tolist() + none,
                    np.concatenate([start, a]).astype(np.int32),
                    np.concatenate([size, b - a]).astype(np.int32),
                ]

    schema = f"id {kind}, text_key bigint, key bigint, digest bigint, start int, windows int"
    return map_rows(keyed(docs, id_col, text_col), run, schema)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents by id and a digest of the text, since an id may occur twice."""
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, data) with the texts compressed for the shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            yield [part["id"], part["text_key"], [zlib.compress(t.encode("utf-8", "replace"), 1) for t in part["text"]]]

    return map_rows(keyed(docs, id_col, text_col), run, f"id {kind}, text_key bigint, data binary")


def recurring(segments: list[bytes], settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of some texts, the stretches of windows that occur in another one of them."""
    found = [digests(np.frombuffer(s, np.uint8), (settings.length,))[0] for s in segments]
    each = np.concatenate([np.unique(w) for w in found])
    values, counts = np.unique(each, return_counts=True)
    twice = values[counts > 1]
    return [stretches(np.isin(w, twice)) for w in found]


def compared(segments: DataFrame, settings: Settings, kind: str) -> DataFrame:
    """(id, text_key, start, windows) from the different runs under one key, (key, id, text_key, start, single, data)."""
    sizes = segments.groupBy("key").agg(F.count("*").alias("n"))
    many = durable(sizes.where(F.col("n") > settings.group))
    schema = f"id {kind}, text_key bigint, start int, windows int"
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def found_in(group: list[tuple]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for (_, one, text_key, start, single, _), (a, b) in zip(group, recurring([g[5] for g in group], settings)):
            if single:
                out[0] += [one] * len(a)
                out[1] += [text_key] * len(a)
                out[2] += (a + start).tolist()
                out[3] += (b - a).tolist()
        return out

    def run(parts: Iterator[dict]) -> Iterator[list]:
        group: list[tuple] = []
        for part in parts:
            for row in zip(*(part[c] for c in ("key", "id", "text_key", "start", "single", "data"))):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        yield found_in(group)
                    group = []
                group.append(row)
        if len(group) > 1:
            yield found_in(group)

    few = segments.join(many.select("key"), "key", "left_anti").repartition(n, "key").sortWithinPartitions("key")
    small = map_rows(few.select("key", "id", "text_key", "start", "single", "data"), run, schema)

    def windows_of(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            for key, one, text_key, start, single, data in zip(*(part[c] for c in ("key", "id", "text_key", "start", "single", "data"))):
                values, first = np.unique(digests(np.frombuffer(data, np.uint8), (settings.length,))[0], return_index=True)
                n = len(values)
                yield [[key] * n, [one] * n, [text_key] * n, (first + start).astype(np.int32), [single] * n, values.view(np.int64)]

    wide = f"key bigint, id {kind}, text_key bigint, start int, single boolean, window bigint"
    exploded = map_rows(
        segments.join(many.select("key"), "key", "left_semi").select("key", "id", "text_key", "start", "single", "data"), windows_of, wide
    )
    twice = exploded.groupBy("key", "window").count().where("count > 1").select("key", "window")
    large = exploded.where("single").join(twice, ["key", "window"], "left_semi")
    return small.unionByName(large.select("id", "text_key", "start", F.lit(1).alias("windows")))


def repeated(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, start, windows): stretches of window starts that occur elsewhere too, for each document."""
    kind = docs.schema[id_col].dataType.simpleString()
    every = durable(all_runs(docs, settings, id_col, text_col))
    place = ["id", "text_key", "start", "windows"]
    keys = every.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    # Written first: a join whose sides come straight from a shuffle can be split where a key is hot.
    keys = durable(keys.where("n > 1").select("key", (F.col("low") == F.col("high")).alias("alike")))
    shared = durable(every.join(keys, "key"))
    different = shared.where(~F.col("alike"))
    kinds = durable(different.groupBy("key", "digest").agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("one")))
    copied = different.join(kinds.where("n > 1").select("key", "digest"), ["key", "digest"], "left_semi")
    probes = kinds.select("key", (F.col("n") == 1).alias("single"), "one.*")
    lists = probes.groupBy("id", "text_key").agg(F.collect_list(F.struct("key", "single", "start", "windows")).alias("runs"))

    def cut(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            for one, text_key, runs, data in zip(part["id"], part["text_key"], part["runs"], part["data"]):
                data = zlib.decompress(data)
                ends = [r["start"] + r["windows"] - 1 + settings.length for r in runs]
                yield [
                    [r["key"] for r in runs],
                    [one] * len(runs),
                    [text_key] * len(runs),
                    [r["start"] for r in runs],
                    [r["single"] for r in runs],
                    [data[r["start"] : end] for r, end in zip(runs, ends)],
                ]

    listed = packed(docs, id_col, text_col).join(lists, ["id", "text_key"]).select("id", "text_key", "runs", "data")
    segments = durable(
        map_rows(listed, cut, f"key bigint, id {kind}, text_key bigint, start int, single boolean, data binary").dropDuplicates(
            ["key", "id", "text_key", "start"]
        )
    )
    return (
        every.where("key IS NULL")
        .select(*place)
        .unionByName(shared.where("alike").select(*place))
        .unionByName(copied.select(*place))
        .unionByName(compared(segments, settings, kind))
    )


def cleaned(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", with_data: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and the bytes that stay if asked for.

    Texts are taken as UTF-8; a null text is empty. Texts shorter than ``length`` lose nothing. Matches do not
    cross documents, and strings are judged on the input. Copies lose all their bytes that lie in windows. Rows
    with one id and different texts are separate documents. Other columns are left out, an empty table gives an
    empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spans = repeated(docs, settings, id_col, text_col).groupBy("id", "text_key")
    lists = durable(spans.agg(F.collect_list(F.struct("start", "windows")).alias("spans")))

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            out: list[list] = [[] for _ in range(6)]
            for one, packed_data, spans in zip(part["id"], part["data"], part["spans"]):
                data = np.frombuffer(zlib.decompress(packed_data), np.uint8)
                gone = np.zeros(len(data) + 1, np.int32)
                for span in spans or ():
                    gone[span["start"]] += 1
                    gone[span["start"] + span["windows"] - 1 + settings.length] -= 1
                marks = np.cumsum(gone[:-1]) > 0
                kept = data[~marks].tobytes()
                row = (one, len(data), int(marks.sum()), len(stretches(marks)[0]), hashlib.sha256(kept).hexdigest(), kept)
                for column, value in zip(out, row):
                    column.append(value)
            yield out if with_data else out[:5]

    schema = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    listed = packed(docs, id_col, text_col).join(lists, ["id", "text_key"], "left").select("id", "data", "spans")
    return map_rows(listed, run, schema + (", kept binary" if with_data else ""))
