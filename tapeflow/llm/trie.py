"""A prefix trie of conversations as a burst trie.

A container holds what conversations say behind a common beginning. All start in one container. A
container of too many turns bursts: what its members still have in common becomes a chain of nodes (the trie's
heads), and each next turn gets a container of its own, until all containers are small. A small
container is held by one task, which sorts its suffixes and sweeps over them: neighbours in the order share the
nodes up to their first difference. Totals of the containers then go up the heads.

Conversations stay in rows of one turn; only small containers are gathered, so neither a long conversation nor a
common beginning has to fit in a task. A burst takes a container to the place where its members differ, however far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, crc32_sql, durable, map_rows, numbered, shuffle_parts

LIMIT = 512  # turns and members that a container may hold
CHAIN_BITS = 12  # nodes of a chain that are summed in one place, as a power of two
LIST = 256  # ids of a piece of a list of members
NODE = (
    "box binary, top boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turns_in_order(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv, index, turn, words): the turns as digests of role and text, ``index`` ascending inside a conversation
    by turn (null first), then role, then text. Null role and text are empty."""
    role = F.coalesce(conversations["role"].cast("string"), F.lit(""))
    text = F.coalesce(conversations["text"].cast("string"), F.lit(""))
    rows = conversations.select(
        conversations[id_col].cast("long").alias("conv"), conversations["turn"].alias("at"), role.alias("role"), text.alias("text")
    ).where("conv IS NOT NULL")
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = rows.withColumn("turn", F.unhex(F.sha2(whole, 256)))
    rows = rows.withColumn("words", F.regexp_count("text", F.lit(WORD)).cast("long"))
    return numbered(rows, ["conv", "at", "role", "text"], ["conv", "turn", "words"])


def own_turns(conversations: DataFrame, id_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (members (conv, len), rows (conv, pos, turn, words))."""
    ordered = durable(turns_in_order(conversations, id_col))
    found = durable(ordered.groupBy("conv").agg(F.min("index").alias("first"), F.count("*").alias("len")))
    rows = ordered.join(found, "conv").withColumn("pos", F.col("index") - F.col("first"))
    return found.select("conv", "len"), durable(rows.select("conv", "pos", "turn", "words"))


def rebuilt_turns(conversations: DataFrame, every: int = 20, most: int = 4, id_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Conversations with a borrowed beginning: the first h turns of conversation ``c - c % every``, then the own ones
    after the first h; h is the CRC-32 of the id in decimal modulo ``most``. What is not there is not borrowed."""
    known, rows = own_turns(conversations, id_col)
    borrowed = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    plan = known.select("conv", "len", borrowed, (F.col("conv") - F.col("conv") % every).alias("base"))
    bases = known.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("len").alias("there"))
    plan = plan.join(bases, "base", "left").withColumn("kept", F.least("h", F.coalesce("there", F.lit(0))))
    plan = durable(plan.select("conv", "base", "h", "kept", "len"))
    heads = rows.where((F.col("conv") % every == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv", "base")
    heads = plan.where("kept > 0").select("conv", "base", "kept").join(heads, "base").where("pos < kept")
    tails = rows.join(plan.select("conv", "h", "kept"), "conv").where("pos >= h")
    tails = tails.withColumn("pos", F.col("pos") - F.col("h") + F.col("kept"))
    columns = ("conv", "pos", "turn", "words")
    length = F.col("kept") + F.greatest(F.col("len") - F.col("h"), F.lit(0))
    return plan.select("conv", length.alias("len")), durable(heads.select(*columns).union(tails.select(*columns)))


@dataclass
class Node:
    words: int
    ends: list[int] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)
    depth: int = 0
    conv: int | None = None
    count: int = 0
    leaves: int = 0
    saved: int = 0

    def close(self) -> None:
        """Sums over the subtree, when all children are closed."""
        ids = self.ends + [c.conv for c in self.children]
        self.conv = min(ids) if ids else None
        self.count = len(self.ends) + sum(c.count for c in self.children)
        self.leaves = sum(c.leaves for c in self.children) or 1
        self.saved = (self.count - 1) * self.words + sum(c.saved for c in self.children)

    def row(self, box: bytes, top: bool, parent: int | None) -> tuple:
        ends = hashlib.sha256(",".join(map(str, sorted(self.ends))).encode()).hexdigest()
        return box, top, self.conv, self.depth, parent, self.count, len(self.children), self.leaves, self.saved, ends


def sweep(box: bytes, start: int, members: dict[int, list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """The nodes of a small container whose suffixes begin at depth ``start``."""
    suffixes = sorted(([turn for turn, _ in turns], conv) for conv, turns in members.items())
    base = Node(0, depth=start)
    open_nodes, last = [base], []

    def close(until: int) -> Iterator[tuple]:
        while len(open_nodes) > until + 1:
            node = open_nodes.pop()
            node.close()
            for child in node.children:
                yield child.row(box, False, node.conv)
                child.children = []

    for turns, conv in suffixes:
        same = next((i for i, (x, y) in enumerate(zip(turns, last)) if x != y), min(len(turns), len(last)))
        yield from close(same)
        for i in range(same, len(turns)):
            node = Node(members[conv][i][1], depth=start + i + 1)
            open_nodes[-1].children.append(node)
            open_nodes.append(node)
        open_nodes[-1].ends.append(conv)
        last = turns
    yield from close(0)
    base.close()
    if not box:  # the first container's base is the root itself
        for child in base.children:
            yield child.row(box, False, base.conv)
        yield base.row(box, True, None)
    else:
        for child in base.children:
            yield child.row(box, True, None)


def swept(rows: DataFrame) -> DataFrame:
    """Nodes of all small containers. ``rows``: (box, start, conv, pos, turn, words), a member's own row at ``pos`` -1."""
    n = shuffle_parts(rows)
    grouped = rows.repartition(n, "box").sortWithinPartitions("box", "conv", "pos")

    def run(parts: Iterator[dict]) -> Iterator[list]:
        out: list[tuple] = []
        at, members = None, {}
        for part in parts:
            for box, start, conv, pos, turn, words in zip(*(part[c] for c in ("box", "start", "conv", "pos", "turn", "words"))):
                if at is None or at[0] != box:
                    if at is not None:
                        out.extend(sweep(*at, members))
                    at, members = (box, start), {}
                if pos < 0:
                    members[conv] = []
                else:
                    members[conv].append((turn, words))
                if len(out) > 4096:
                    yield list(zip(*out))
                    out = []
        if at is not None:
            out.extend(sweep(*at, members))
        for i in range(0, len(out), 4096):
            yield list(zip(*out[i : i + 4096]))

    return map_rows(grouped, run, NODE)


def sum_behind(rows: DataFrame, key: list[str], place: str, value: str) -> DataFrame:
    """``rows`` with ``behind``, the sum of ``value`` from a row to the end of its key, over blocks of places."""
    rows = rows.withColumn("block", F.shiftright(place, CHAIN_BITS))
    inside = Window.partitionBy(*key, "block").orderBy(F.col(place).desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(*key).orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*key, "block").agg(F.sum(value).alias("of_block"))
    blocks = blocks.withColumn("of_later", F.coalesce(F.sum("of_block").over(later), F.lit(0))).drop("of_block")
    rows = rows.withColumn("of_rest", F.sum(value).over(inside)).join(blocks, [*key, "block"])
    return rows.withColumn("behind", F.col("of_rest") + F.col("of_later")).drop("block", "of_rest", "of_later")


def list_digests(members: DataFrame) -> DataFrame:
    """(box, ends_sha256): SHA-256 of the decimal ``conv`` of each box, ascending, joined by commas.

    A digest is taken in order, so the list of a box passes through one task, as pieces of 256 ids of which
    one is held at a time.
    """
    placed = numbered(members.select("box", "conv"), ["box", "conv"], ["box", "conv"])
    piece = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = placed.groupBy("box", F.floor(F.col("index") / LIST).alias("piece")).agg(piece.alias("ids"))
    pieces = pieces.repartition(shuffle_parts(members), "box").sortWithinPartitions("box", "piece")

    def run(parts: Iterator[dict]) -> Iterator[list]:
        at, digest = None, None
        for part in parts:
            done = []
            for box, ids in zip(part["box"], part["ids"]):
                if box == at:
                    digest.update(("," + ids).encode())
                    continue
                if digest:
                    done.append((at, digest.hexdigest()))
                at, digest = box, hashlib.sha256(ids.encode())
            yield [[x for x, _ in done], [x for _, x in done]]
        if digest:
            yield [[at], [digest.hexdigest()]]

    return map_rows(pieces, run, "box binary, ends_sha256 string")


@dataclass
class Burst:
    """One round: containers, and of those that burst the chain, the members that end with it and how many go on."""

    boxes: DataFrame  # box, parent, start, n_convs, conv_id, size
    chain: DataFrame | None = None  # box, depth, words
    cuts: DataFrame | None = None  # box, cut
    ends: DataFrame | None = None  # box, conv


def burst(members: DataFrame, rows: DataFrame, limit: int) -> tuple[list[Burst], DataFrame]:
    """Burst containers until all are small: the rounds, and the rows of the small ones."""
    nothing = F.unhex(F.lit(""))
    at_root = {"box": nothing, "parent": F.lit(None).cast("binary"), "start": F.lit(0).cast("long")}
    members = durable(members.withColumns(at_root))
    rows = durable(rows.join(members.select("conv", "len"), "conv").withColumn("box", nothing))
    rounds, small = [], []
    while True:
        held = F.sum(F.col("len") - F.col("start")) + F.count("*")
        boxes = members.groupBy("box", "parent", "start").agg(
            F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"), held.alias("size")
        )
        boxes = durable(boxes)
        done = Burst(boxes)
        rounds.append(done)
        sizes = boxes.select("box", "start", "n_convs", (F.col("size") > limit).alias("large"))
        fits = sizes.where("NOT large").select("box", "start")
        own = {"pos": F.lit(-1).cast("long"), "turn": F.lit(None).cast("binary"), "words": F.lit(0).cast("long")}
        columns = ("box", "start", "conv", "pos", "turn", "words")
        small.append(members.drop("start").join(fits, "box").withColumns(own).select(*columns))
        small.append(rows.join(fits, "box").select(*columns))
        large = sizes.where("large").drop("large")
        if large.isEmpty():
            return rounds, reduce(DataFrame.union, small)
        active = rows.join(large.select("box"), "box")
        least = [F.count("*").alias("n"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.max("words").alias("words")]
        spine = durable(active.groupBy("box", "pos").agg(*least).join(large, "box"))
        shared = (F.col("n") == F.col("n_convs")) & (F.col("low") == F.col("high"))
        cut = F.coalesce(F.min(F.when(~shared, F.col("pos"))), F.max("pos") + 1).alias("cut")
        cuts = large.join(spine.groupBy("box").agg(cut), "box", "left")
        done.cuts = durable(cuts.select("box", F.coalesce("cut", "start").alias("cut")))
        done.chain = spine.join(done.cuts, "box").where("pos < cut").select("box", (F.col("pos") + 1).alias("depth"), "words")
        done.ends = durable(members.drop("start").join(done.cuts, "box").where("len = cut").select("box", "conv"))
        onward = active.join(done.cuts, "box").where("pos >= cut")
        child = F.unhex(F.md5(F.concat("box", "turn"))).alias("box")
        members = durable(
            onward.where("pos = cut").select("conv", "len", child, F.col("box").alias("parent"), F.col("cut").alias("start"))
        )
        onward = onward.drop("box", "cut").join(members.select("conv", "box"), "conv")
        rows = durable(onward.select("conv", "pos", "turn", "words", "len", "box"))


def nodes(members: DataFrame, rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of conversations: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``members``: (conv, len); ``rows``: (conv, pos from 0, turn, words). A node is a distinct sequence of first
    turns, its members the conversations that begin so; the root is the empty one. ``n_leaves`` counts the
    childless nodes of its subtree, itself included; ``saved_tokens`` sums, over its subtree, the words of a node's last
    turn times its members but one; ``ends_sha256`` is the digest of the members that end there.
    """
    rounds, small = burst(members, rows, limit)
    found = durable(swept(small))
    tops = found.where("top").select("box", "n_leaves", "saved_tokens")
    heads, totals = [], None
    for done in reversed(rounds):
        placed = done.boxes.select("box", "parent")
        of_round = placed.join(tops, "box")
        if done.chain is not None:
            kids = totals.groupBy(F.col("parent").alias("box")).agg(
                F.count("*").alias("kids"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below")
            )
            own = done.boxes.join(done.cuts, "box").join(kids, "box", "left").select(
                "box",
                "parent",
                "start",
                "cut",
                "n_convs",
                "conv_id",
                F.coalesce("kids", F.lit(0)).alias("kids"),
                F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
                F.coalesce("below", F.lit(0)).alias("below"),
            )
            own = durable(own)
            spent = done.chain.groupBy("box").agg(F.sum("words").alias("words"))
            saved = F.col("below") + (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))
            burst_boxes = own.join(spent, "box", "left").select("box", "parent", "n_leaves", saved.alias("saved_tokens"))
            of_round = of_round.union(burst_boxes)
            heads.append((own, done.chain, done.ends))
        totals = durable(of_round)

    names = reduce(DataFrame.union, [r.boxes.select("box", "parent", "conv_id") for r in rounds])
    first = names.select(F.col("box").alias("parent"), F.col("conv_id").alias("above"))
    of_parent = durable(names.select("box", "parent").join(first, "parent").select("box", "above"))
    out = found.join(of_parent, "box", "left").withColumn(
        "parent_conv_id", F.when(F.col("top"), F.col("above")).otherwise(F.col("parent_conv_id"))
    )
    result = out.select(*COLUMNS)
    if heads:
        own = durable(reduce(DataFrame.union, [o for o, _, _ in heads]))
        chain = reduce(DataFrame.union, [c for _, c, _ in heads])
        root = own.where(F.col("parent").isNull()).select("box", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"))
        chain = durable(chain.union(root).join(own, "box").join(of_parent, "box", "left"))
        chain = sum_behind(chain.withColumn("spent", (F.col("n_convs") - 1) * F.col("words")), ["box"], "depth", "spent")
        ends = list_digests(durable(reduce(DataFrame.union, [e for _, _, e in heads])))
        last = F.col("depth") == F.col("cut")
        chain = chain.join(ends, "box", "left")
        parent = F.when(F.col("depth") == 0, None).when(F.col("parent").isNotNull() & (F.col("depth") == F.col("start") + 1), F.col("above"))
        chain = chain.select(
            "conv_id",
            "depth",
            parent.otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.when(last, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
            "n_leaves",
            (F.col("behind") + F.col("below")).alias("saved_tokens"),
            F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
        result = result.union(chain)
    return result


def rebuilt_nodes(conversations: DataFrame, limit: int = LIMIT, id_col: str = "conv_id") -> DataFrame:
    """The trie of rebuilt conversations (see :func:`rebuilt_turns`, :func:`nodes`).

    Turns with equal numbers, or null ones, which come first, stand in the order of role, then text; repeated rows are turns of
    their own. Null roles and texts are empty. Rows without a conversation id belong to none and are left out. An empty
    table has no conversation and gives no node, not even a root. Other columns are not looked at.
    """
    return nodes(*rebuilt_turns(conversations, id_col=id_col), limit)


#: The trie of rebuilt conversations of a table ``conversations`` in SQL.
SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS seq, {crc32_sql('conv_id')} % 4 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.seq[1:o.h], []), o.seq[o.h + 1:]) AS seq
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
members AS (SELECT conv_id, seq[1:d] AS node, len(seq) = d AS ends FROM rebuilt, unnest(range(len(seq) + 1)) AS t(d)),
nodes AS (
  SELECT node, len(node) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         (n_convs - 1) * len(regexp_extract_all(coalesce(n.node[n.depth].text, ''), '{WORD}')) AS own
  FROM nodes n LEFT JOIN children USING (node)),
subtrees AS (
  SELECT node[1:d] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM counted, unnest(range(depth + 1)) AS t(d) GROUP BY 1)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (node) LEFT JOIN nodes p ON c.depth > 0 AND p.node = c.node[1:c.depth - 1]
"""
