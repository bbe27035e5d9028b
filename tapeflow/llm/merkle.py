"""A Merkle manifest of a table by bitmap ranks.

Every row is a leaf; the leaves of a group stand in the order of their ids. Where a leaf stands is found without a
sort: the ids of a group are a bitmap, of which only words that hold an id are kept, and a directory of counts over
words, over runs of words, and so on up says how many ids come before a word. The place of an id, its
slot, is the count before its word and the popcount below its bit. Only rows whose id is null or given twice in
their group are put in order, among the rows of their words.

Slots make the tree local: the slots of one array (2^10 of them) are a whole subtree, reduced by whoever holds the
array; its top is one slot of an array above. A proof is the siblings inside the array, then what is above
the array, which all its slots share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_sql, durable, map_rows, numbered, shuffle_parts

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARRAY_BITS = 10  # slots of an array, as a power of two
RUN_BITS = 12  # entries of the directory below one entry of the next level
NO_ID = -(1 << 60)  # the word of null ids: below every other


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(digests: list[str], levels: int) -> list[list[str]]:
    """The rows of a tree from the given one up: two neighbours, or a last one alone, become their digest."""
    rows = [digests]
    for _ in range(levels):
        last = rows[-1]
        rows.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return rows


def siblings(rows: list[list[str]], at: int) -> list[str]:
    """The other node of the run on each level below the top, empty where there is none."""
    path = []
    for row in rows[:-1]:
        path.append(row[at ^ 1] if at ^ 1 < len(row) else "")
        at >>= 1
    return path


def fold(digest: str, at: int, path: Sequence[str]) -> str:
    """The top that a leaf at a slot and its siblings give."""
    for sibling in path:
        digest = sha(sibling + digest if at & 1 else digest + sibling)
        at >>= 1
    return digest


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of the values: ``-`` for null, else length in UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def height_of(size: Column) -> Column:
    """Levels above ``size`` leaves: the bits of ``size - 1``."""
    return F.when(size <= 1, 0).otherwise(F.length(F.bin(size - 1)))


def directory(words: DataFrame) -> DataFrame:
    """(tree, word, bits, n, before): ``before`` rows of the tree are in smaller words.

    Counts are summed over runs of 2^12 words, runs of runs and so on, until a tree has so few entries that
    they are one run; no sum sees more than a run.
    """
    known = words.where(F.col("word") != NO_ID)
    ends = known.agg(F.min("word").alias("low"), F.max("word").alias("high")).first()
    levels, entries, shift = [], known.select("tree", F.col("word").alias("entry"), "n"), 0
    while True:
        top = ends["low"] is None or (ends["high"] >> shift) - (ends["low"] >> shift) < 1 << RUN_BITS
        run = F.lit(0).cast("long") if top else F.shiftright("entry", RUN_BITS)
        order = Window.partitionBy("tree", "run").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum("n").over(order), F.lit(0))
        levels.append(entries.withColumn("run", run).withColumn("inside", inside))
        if top:
            break
        runs = entries.groupBy("tree", F.shiftright("entry", RUN_BITS).alias("entry")).agg(F.sum("n").alias("n"))
        entries, shift = durable(runs), shift + RUN_BITS
    unknown = words.where(F.col("word") == NO_ID).select("tree", F.col("n").alias("nulls"))
    placed = levels.pop().join(unknown, "tree", "left")
    placed = placed.select("tree", "entry", (F.col("inside") + F.coalesce("nulls", F.lit(0))).alias("before"))
    while levels:
        above = placed.select("tree", F.col("entry").alias("run"), F.col("before").alias("outside"))
        below = levels.pop().join(above, ["tree", "run"])
        placed = below.select("tree", "entry", (F.col("outside") + F.col("inside")).alias("before"))
    first = unknown.select("tree", F.lit(NO_ID).alias("entry"), F.lit(0).cast("long").alias("before"))
    return words.join(placed.union(first).withColumnRenamed("entry", "word"), ["tree", "word"])


def slotted(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with ``slot`` and ``height`` of their tree, sizes of the trees). Null ids come first, rows with one id
    stand in the order of their leaves."""
    columns = leaves.columns
    leaves = leaves.withColumn("word", F.coalesce(F.shiftright("id", 6), F.lit(NO_ID)))
    bit = F.expr("shiftleft(1L, CAST(id & 63 AS INT))")
    words = durable(leaves.groupBy("tree", "word").agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n")))
    sizes = words.groupBy("tree").agg(F.sum("n").alias("size"))
    sizes = durable(sizes.withColumn("height", height_of(F.col("size"))))
    found = leaves.join(directory(words), ["tree", "word"])
    alone = F.coalesce(F.col("n") == F.bit_count("bits"), F.lit(False))
    below = F.expr("bit_count(bits & ~shiftleft(-1L, CAST(id & 63 AS INT)))")
    plain = found.where(alone).withColumn("slot", F.col("before") + below)
    crowded = durable(found.where(~alone).select(*columns, "word", "before"))
    if not crowded.isEmpty():
        order = ["tree", "word", "id", *[c for c in columns if c not in ("tree", "id")]]
        inside = durable(numbered(crowded, order, crowded.columns))
        starts = inside.groupBy("tree", "word").agg(F.min("index").alias("start"))
        inside = inside.join(starts, ["tree", "word"])
        inside = inside.withColumn("slot", F.col("before") + F.col("index") - F.col("start"))
        plain = plain.select(*columns, "slot").union(inside.select(*columns, "slot"))
    return durable(plain.select(*columns, "slot").join(sizes.select("tree", "height"), "tree")), sizes


def by_array(rows: DataFrame) -> DataFrame:
    """Rows with a ``slot``, dealt by the array of the slot and in the order of slots within it."""
    rows = rows.withColumn("array", F.shiftright("slot", ARRAY_BITS))
    return rows.repartition(shuffle_parts(rows), "tree", "array").sortWithinPartitions("tree", "array", "slot")


def arrays(parts: Iterator[dict]) -> Iterator[tuple[str, int, list[dict]]]:
    """(tree, array, rows) for each array of a task, one at a time."""
    at, rows = None, []
    for part in parts:
        names = list(part)
        for values in zip(*part.values()):
            row = dict(zip(names, values))
            if at != (row["tree"], row["array"]):
                if rows:
                    yield (*at, rows)
                at, rows = (row["tree"], row["array"]), []
            rows.append(row)
    if rows:
        yield (*at, rows)


def batched(rows: Iterator[tuple], size: int = 4096) -> Iterator[list]:
    """Rows as lists of columns."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield list(zip(*held))
            held = []
    if held:
        yield list(zip(*held))


@dataclass(frozen=True)
class Tree:
    """Trees as tables of nodes (tree, slot, digest, height): ``stages[0]`` holds the leaves, each next one a node for
    an array of the one before. ``roots``: (tree, root)."""

    stages: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame, highest: int) -> Tree:
    """Reduce the trees of ``leaves`` (tree, slot, digest, height) array by array, ``highest`` being the greatest height."""

    def tops(parts: Iterator[dict]) -> Iterator[list]:
        def rows():
            for tree, array, nodes in arrays(parts):
                height = nodes[0]["height"]
                done = levels_of([n["digest"] for n in nodes], min(height, ARRAY_BITS))
                yield tree, array, done[-1][0], max(height - ARRAY_BITS, 0), height <= ARRAY_BITS

        yield from batched(rows())

    stages, roots = [leaves], []
    while True:
        schema = "tree string, slot bigint, digest string, height int, whole boolean"
        reduced = durable(map_rows(by_array(stages[-1].select("tree", "slot", "digest", "height")), tops, schema))
        roots.append(reduced.where("whole").select("tree", F.col("digest").alias("root")))
        highest -= ARRAY_BITS
        if highest <= 0:
            return Tree(stages, reduce(DataFrame.union, roots))
        stages.append(reduced.where("NOT whole").drop("whole"))


def paths(tree: Tree, above: DataFrame, stage: int) -> DataFrame:
    """(tree, slot, path): the siblings from each node of a stage up. ``above`` has (tree, path), what is over the roots.

    The path of an array comes first among its slots, so that a task holds one array and its path.
    """

    def down(parts: Iterator[dict]) -> Iterator[list]:
        def rows():
            for name, _, nodes in arrays(parts):
                over, nodes = nodes[0]["path"], nodes[1:]
                done = levels_of([n["digest"] for n in nodes], min(nodes[0]["height"], ARRAY_BITS))
                for at, node in enumerate(nodes):
                    yield name, node["slot"], siblings(done, at) + over

        yield from batched(rows(), 512)

    found = None
    for nodes in reversed(tree.stages[stage:]):
        rows = with_heads(nodes.select("tree", "slot", "digest", "height"), heads_of(nodes, found, above))
        found = durable(map_rows(rows, down, "tree string, slot bigint, path array<string>"))
    return found


def heads_of(nodes: DataFrame, over: DataFrame | None, above: DataFrame) -> DataFrame:
    """(tree, array, path) for the arrays of a stage: the path of their node in the stage ``over``, or what is above
    the root where the array is the whole tree."""
    whole = nodes.where((F.col("height") <= ARRAY_BITS) & (F.col("slot") == 0)).select("tree")
    heads = whole.join(above, "tree").select("tree", F.lit(0).cast("long").alias("array"), "path")
    return heads if over is None else heads.union(over.select("tree", F.col("slot").alias("array"), "path"))


def with_heads(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes by array in the order of slots, each array behind its head."""
    heads = heads.withColumns({"slot": F.shiftleft("array", ARRAY_BITS), "turn": F.lit(0)})
    rows = nodes.withColumns({"array": F.shiftright("slot", ARRAY_BITS), "turn": F.lit(1)})
    both = rows.unionByName(heads, allowMissingColumns=True).repartition(shuffle_parts(rows), "tree", "array")
    return both.sortWithinPartitions("tree", "array", "turn", "slot").drop("turn")


def manifest(
    docs: DataFrame,
    presented: Mapping[str, Column] | None = None,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: id, group, slot, leaf, subroot, root, proof (the siblings), proof_sha256,
    folded_root, verified.

    ``leaf`` is the digest of ``fields``. The leaves of a group by ascending id give its ``subroot``, the
    subroots by group (null first, then bytewise) the ``root``: while nodes remain, two neighbours become their
    digest, a last one alone becomes its own digest. ``presented`` replaces fields by what somebody presents of
    them; ``folded_root`` is the root that the presented leaf and the proof give, ``verified`` whether it is the root.

    Ids are integers; null ids come first. Rows with one id in one group, repeated rows too, are leaves of their
    own, in the order of their digests. Nulls, empty and long texts are hashed like any other value. An empty table
    gives an empty result. Other columns of any name are not looked at.
    """
    shown = [(presented or {}).get(name, docs[name]) for name in fields]
    leaf, claimed = leaf_of([docs[name] for name in fields]), leaf_of(shown)
    group = docs[group_col].cast("string")
    tree = F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group))
    both = docs.select(tree.alias("tree"), docs[id_col].cast("long").alias("id"), leaf.alias("digest"), claimed.alias("claimed"))
    leaves, sizes = slotted(durable(both.withColumn("claimed", F.nullif("claimed", "digest"))))

    groups = grow(leaves, sizes.agg(F.max("height")).first()[0] or 0)
    # The groups are the leaves of one more tree.
    ranks = durable(numbered(groups.roots, ["tree"], ["tree", "root"]))
    height = max(ranks.count() - 1, 0).bit_length()
    subroots = ranks.select(F.lit("").alias("tree"), F.col("index").alias("slot"), F.col("root").alias("digest"))
    top = grow(durable(subroots.withColumn("height", F.lit(height))), height)
    root = top.roots.first()  # one row
    over_root = top.roots.select("tree", F.array().cast("array<string>").alias("path"))
    above = paths(top, over_root, 0).select(F.col("slot").alias("rank"), "path")
    above = durable(above.join(ranks.select(F.col("index").alias("rank"), "tree", F.col("root").alias("subroot")), "rank"))
    upper = paths(groups, above, 1) if len(groups.stages) > 1 else None
    heads = heads_of(leaves, upper, above.select("tree", "path")).join(above.select("tree", "rank", "subroot"), "tree")

    def prove(parts: Iterator[dict]) -> Iterator[list]:
        def rows():
            for tree, _, nodes in arrays(parts):
                head, nodes = nodes[0], nodes[1:]
                done = levels_of([n["digest"] for n in nodes], min(nodes[0]["height"], ARRAY_BITS))
                group = tree[1:] if tree else None
                for at, node in enumerate(nodes):
                    path = siblings(done, at) + head["path"]
                    # Above the root of the group the place is that of the group.
                    place = node["slot"] | head["rank"] << node["height"]
                    folded = fold(node["claimed"] or node["digest"], place, path)
                    proof = [x for x in path if x]
                    yield node["id"], group, node["slot"], node["digest"], head["subroot"], root["root"], proof, sha("".join(proof)), folded, folded == root["root"]

        yield from batched(rows(), 512)

    schema = "id bigint, group string, slot bigint, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, folded_root string, verified boolean"
    rows = map_rows(with_heads(leaves, heads), prove, schema)
    kept = ["slot", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"]
    return rows.select(F.col("id").alias(id_col), F.col("group").alias(group_col), *kept)


def tampered(docs: DataFrame, id_col: str = "doc_id", size_col: str = "n_chars", every: int = 7) -> dict[str, Column]:
    """A presentation of ``docs`` in which the size is one too large wherever ``every`` divides the CRC-32 of the id
    in decimal; a null stays null."""
    hit = F.crc32(docs[id_col].cast("string").cast("binary")) % every == 0
    more = docs[size_col].cast("decimal(20,0)") + 1
    return {size_col: F.when(hit, more.cast("string")).otherwise(docs[size_col].cast("string"))}


def _leaf_sql(columns: Mapping[str, str]) -> str:
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR END" for v in columns.values()]
    return f"sha256({' || '.join(parts)})"


_AS_IS = {name: name for name in FIELDS}
_TAMPERED = _AS_IS | {"n_chars": f"CASE WHEN {crc32_sql('doc_id')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END"}

#: The manifest of a table ``documents`` held against its tampered presentation, in SQL.
SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS slot,
         count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf_sql(_AS_IS)} AS leaf, {_leaf_sql(_TAMPERED)} AS claimed FROM documents)),
up AS (
  SELECT lang, 0 AS level, slot, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, slot // 2, sha256(string_agg(digest, '' ORDER BY slot)), (n + 1) // 2
  FROM up WHERE n > 1 GROUP BY lang, level, slot // 2, n),
subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS groups
  FROM up WHERE n = 1),
over AS (
  SELECT 0 AS level, place AS slot, subroot AS digest, groups AS n FROM subroots
  UNION ALL
  SELECT level + 1, slot // 2, sha256(string_agg(digest, '' ORDER BY slot)), (n + 1) // 2
  FROM over WHERE n > 1 GROUP BY level, slot // 2, n),
inside AS (
  SELECT doc_id, lang, leaf, 0 AS level, slot, n, claimed AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT i.doc_id, i.lang, i.leaf, i.level + 1, i.slot // 2, (i.n + 1) // 2,
         sha256(CASE WHEN u.digest IS NULL THEN folded WHEN i.slot % 2 = 1 THEN u.digest || folded ELSE folded || u.digest END),
         proof || coalesce(u.digest, '')
  FROM inside i LEFT JOIN up u ON u.lang IS NOT DISTINCT FROM i.lang AND u.level = i.level AND u.slot = xor(i.slot, 1)
  WHERE i.n > 1),
above AS (
  SELECT doc_id, leaf, subroot, 0 AS level, place AS slot, groups AS n, folded, proof
  FROM inside i JOIN subroots s ON s.lang IS NOT DISTINCT FROM i.lang WHERE n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, a.level + 1, a.slot // 2, (a.n + 1) // 2,
         sha256(CASE WHEN o.digest IS NULL THEN folded WHEN a.slot % 2 = 1 THEN o.digest || folded ELSE folded || o.digest END),
         proof || coalesce(o.digest, '')
  FROM above a LEFT JOIN over o ON o.level = a.level AND o.slot = xor(a.slot, 1)
  WHERE a.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM above, (SELECT digest AS root FROM over WHERE n = 1) WHERE n = 1
"""
