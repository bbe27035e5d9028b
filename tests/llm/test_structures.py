"""The manifest, the trie and the anchors of fingerprints against plain versions, and on odd input."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tapeflow.llm import merkle, queries, simhash, trie
from tapeflow.llm.common import durable, numbered

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_numbers_of_rows_with_a_hot_key(spark):
    table = durable(spark.range(3000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"), "id"))
    rows = numbered(table, ["k"], ["k"]).orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(3000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


# The manifest ---------------------------------------------------------------------------------

FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = "tree string, word int, slot int, id int, digest string, path string, array int, height int"
PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def plain_manifest(rows):
    def leaf(row):
        return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    groups = {}
    for row in rows:
        shown = dict(row)
        if row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0:
            shown["n_chars"] += 1
        key = (row["doc_id"] is not None, row["doc_id"] or 0)
        groups.setdefault(row["lang"], []).append((key, leaf(row), leaf(shown)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[1] for x in sorted(groups[g])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    for place, name in enumerate(names):
        for slot, ((known, doc_id), own, shown) in enumerate(sorted(groups[name])):
            proof, folded = "", shown
            for levels, at in ((trees[name], slot), (top, place)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    proof += other
                    folded = sha(other + folded if at & 1 else folded + other)
                    at >>= 1
            yield doc_id if known else None, own, trees[name][-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0]


def check_manifest(docs):
    rows = [r.asDict() for r in docs.select(*merkle.FIELDS).collect()]
    got = [tuple(r) for r in merkle.manifest(docs, merkle.tampered(docs)).select(*PROOF).collect()]
    assert in_order(got) == in_order(plain_manifest(rows))
    return got


def test_manifest_of_odd_rows(spark):
    draw = random.Random(1)
    ids = [lambda: None, lambda: draw.randrange(-50, 50), lambda: draw.randrange(-(10**18), 10**18), lambda: draw.randrange(3000)]
    rows = [
        (draw.choice(ids)(), draw.choice([None, "", "x", "äö " * 3, "long " * 20_000 if i == 7 else "y"]), draw.choice([None, "", "a", "ä", "=", chr(0x10400)]),
         draw.choice([None, "s"]), draw.choice([None, 3, 2**63 - 1]), "q", 1, 2, 3, "d", "p", 1, 2)
        for i in range(1500)
    ]
    rows += [rows[0]] * 400  # a third of a group is one row
    found = check_manifest(spark.createDataFrame(rows, f"{FIELDS}, {CLASHES}"))
    assert {r[-1] for r in found} == {True, False}


def test_manifest_of_many_groups_and_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ARRAY_BITS", 2)
    monkeypatch.setattr(merkle, "RUN_BITS", 1)
    check_manifest(spark.createDataFrame([(i * 37, "t", str(i % 70), "s", 1) for i in range(300)], FIELDS))
    check_manifest(spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(77)], FIELDS))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_manifest_of_few_rows(spark, n):
    check_manifest(spark.createDataFrame([(i, None, None, None, None) for i in range(n)], FIELDS))


def test_levels_and_folds():
    for n in range(1, 20):
        height = (n - 1).bit_length()
        levels = merkle.levels_of([str(i) for i in range(n)], height)
        assert len(levels[-1]) == 1
        assert all(merkle.fold(str(i), i, merkle.siblings(levels, i)) == levels[-1][0] for i in range(n))


# The trie -------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, box string, conv int, pos int, depth int"


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        borrowed = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:borrowed] + own[c][borrowed:])
    members, children = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[child] for child in children.get(node, [])]
        words = len(WORD.findall(node[-1][1])) if node else 0
        totals[node] = (sum(x for x, _ in below) or 1, (len(members[node]) - 1) * words + sum(x for _, x in below))
    for node, found in members.items():
        ends = ",".join(map(str, sorted(c for c in found if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        yield min(found), len(node), parent, len(found), len(children.get(node, [])), *totals[node], sha(ends)


def check_trie(table, limit):
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in trie.rebuilt_nodes(table, limit).collect()]
    assert in_order(got) == in_order(plain_trie(rows))
    return got


@pytest.fixture(scope="module")
def conversations(spark):
    draw = random.Random(1)
    rows = []
    for c in [*range(-30, 60), None]:
        for t in range(draw.choice([1, 2, 5])):
            turn, text = draw.choice([None, t, t, 1]), draw.choice([None, "", "a b", "a  c\td"])
            rows.append((c, turn, draw.choice([None, "", "u"]), text, "x", 1, 2, 3))
    for c in range(200, 240):  # copies, and rows given twice
        rows += [(c, t, "u", f"same {t}", "", 1, 1, 1) for t in range(6)]
    rows += [(230, 5, "u", "same 5", "", 1, 1, 1)] * 2
    for c in (1000, 1040):  # long ones
        rows += [(c, t, "u", f"long {t % 7}", "", 1, 1, 1) for t in range(300)]
    rows.append((77, 1, "u", "very long " * 50_000, "", 1, 1, 1))
    return spark.createDataFrame(rows, TURNS).cache()


@pytest.mark.parametrize("limit", [1, 10, 512])
def test_trie_at_any_size_of_containers(conversations, limit):
    check_trie(conversations, limit)


def test_chains_and_lists_in_pieces(conversations, monkeypatch):
    monkeypatch.setattr(trie, "CHAIN_BITS", 1)
    monkeypatch.setattr(trie, "LIST", 3)
    check_trie(conversations, 5)


@pytest.mark.parametrize("rows", [[], [(41, 0, "u", "x", "", 1, 1, 1)], [(43, 0, "u", "x", "", 1, 1, 1)], [(None, 0, "u", "x", "", 1, 1, 1)]])
@pytest.mark.parametrize("limit", [0, 100])
def test_trie_of_few_rows(spark, rows, limit):
    check_trie(spark.createDataFrame(rows, TURNS), limit)


# Fingerprints ---------------------------------------------------------------------------------


def plain_print(text):
    small = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(small))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    counts = [0] * 64
    for digest in (xxhash.xxh64_intdigest(s, 42) for s in shingles):
        for bit in range(64):
            counts[bit] += digest >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def roots_of(prints, distance):
    """The smallest print that links reach, by comparing all pairs."""
    unsigned = np.array(sorted(set(prints)), np.uint64)
    parent = {int(x): int(x) for x in unsigned}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, x in enumerate(unsigned):
        for y in unsigned[:i][np.bitwise_count(unsigned[:i] ^ x) <= distance]:
            a, b = sorted((root(int(x)), root(int(y))))
            parent[b] = a
    return {x: root(x) for x in parent}


def check_classes(docs, distance=4):
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    roots, lowest = roots_of([p for _, p in rows], distance), {}
    for doc_id, value in rows:
        if doc_id is not None:
            lowest[roots[value]] = min(doc_id, lowest.get(roots[value], doc_id))
    want = [(d, f"{p:016x}", lowest.get(roots[p])) for d, p in rows]
    got = simhash.classes(docs, distance).select("doc_id", "fingerprint", "component_id").collect()
    assert in_order(map(tuple, got)) == in_order(want)


def test_fingerprints_and_classes_of_odd_texts(spark):
    draw = random.Random(1)
    rows = []
    for i in range(400):
        n = draw.choice([0, 1, 3, 4, 5, 60])
        text = draw.choice([None, "", " ".join(draw.choice("aBcÄde") for _ in range(n)), "\t".join(f"w{draw.randrange(5)}" for _ in range(n))])
        rows.append((draw.choice([None, i, i]), text, "x", 1, 2, 3))
    rows += [rows[5]] * 50 + [(7000, "a very long Text " * 80_000, "x", 1, 2, 3), (7001, "x" * 3_000_000, "x", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, print string, root int, anchor int, id int")
    check_classes(docs)
    check_classes(docs, 1)
    check_classes(docs.where("false"))


def test_a_text_in_pieces_has_the_fingerprint_of_the_whole(monkeypatch):
    text = " ".join(f"Word{i % 97}" for i in range(4000))
    whole = simhash.fingerprint(text)
    plain = simhash.pieces
    monkeypatch.setattr(simhash, "pieces", lambda raw: plain(raw, 50))
    assert simhash.fingerprint(text) == whole == np.array([plain_print(text)], np.uint64).view(np.int64)[0]


def flipped(values, bits, draw):
    out = values.copy()
    for _ in range(bits):
        out ^= np.uint64(1) << draw.integers(0, 64, len(out)).astype(np.uint64)
    return out


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_links_of_planted_prints(spark, distance):
    draw = np.random.default_rng(distance)
    base = draw.integers(0, 2**63, 150).astype(np.uint64)
    blob = flipped(np.full(600, base[0]), 3, draw)
    prints = np.unique(np.concatenate([base, blob, *[flipped(base, k, draw) for k in (1, 2, 3, 4, 5, 6)], draw.integers(0, 2**14, 300).astype(np.uint64)]))
    table = durable(spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "print bigint"))
    want = roots_of(prints.tolist(), distance)
    for block in (2048, 16):
        found = simhash.components(durable(simhash.links(table, distance, block))).collect()
        got = {r["node"]: r["root"] for r in found}
        groups = {}
        for x, y in zip(prints.view(np.int64).tolist(), prints.tolist()):
            groups.setdefault(want[y], set()).add(got.get(x, x))
        assert all(len(names) == 1 for names in groups.values())
        assert len({next(iter(n)) for n in groups.values()}) == len(groups)


def test_every_half_has_an_anchor_near():
    draw = np.random.default_rng(2)
    half = draw.integers(0, 2**32, 500)
    near = simhash.home(half)
    assert np.bitwise_count((near ^ half).astype(np.uint64)).max() <= simhash.RADIUS and not simhash.syndrome(near).any()
    for radius in (1, 2, 3):
        rows, found = simhash.anchors(half[:40], radius)
        assert not simhash.syndrome(found).any()
        assert np.bitwise_count((found ^ half[rows]).astype(np.uint64)).max() <= radius
        other = half[:40] ^ (1 << draw.integers(0, 32, 40))
        if radius > 1:  # whoever is one bit away is at home at one of them
            assert all(int(h) in set(found[rows == i].tolist()) for i, h in enumerate(simhash.home(other)))


# The registered queries -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    draw = random.Random(3)
    words = ["the", "of", "käse", "Name", "x1", "zu", "et", "la"]
    docs = [
        (i, None if i == 3 else " ".join(draw.choice(words) for _ in range(draw.choice([0, 2, 30, 200]))), draw.choice(["en", "de", None]),
         f"s{i % 3}", None if i % 11 == 0 else i)
        for i in range(80)
    ]
    spark.createDataFrame([*docs, (90, docs[40][1], "en", "s1", 1)], FIELDS).write.parquet(f"{folder}/documents.parquet")
    turns = [(c, t, "u", draw.choice(["a", "a b", "c"])) for c in range(45) for t in range(draw.choice([1, 3, 6]))]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["op4_mixing", "op11_merkle", "op12_prefix_trie"])
def test_queries_against_their_sql(spark, tables, name):
    database = duckdb.connect()
    for table in ("documents", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet/*.parquet'")
    result = queries.QUERIES[name](spark, tables)
    want = database.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(result.columns)
    assert in_order(map(tuple, result.select(*names).collect())) == in_order(want.fetchall())


def test_fingerprint_query(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op13_simhash(spark, tables).collect()}
    rows = {r.doc_id: plain_print(r.text) for r in docs.collect()}
    roots = roots_of(list(rows.values()), 4)
    assert got == {d: (f"{p:016x}", min(e for e, q in rows.items() if roots[q] == roots[p])) for d, p in rows.items()}
    assert got[90] == got[40]
