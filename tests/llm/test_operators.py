"""Every operator against a plain version, and on odd input: nulls, empty and very long texts, repeated rows,
empty tables, extra columns with the names that the operators use themselves."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tapeflow.llm import ann, bpe, langid, mixing, neardup, pii, quality, repeats, tokencount, toxicity
from tapeflow.llm.common import bounded_sample, held_out

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, size long, node long, key long, start long, spans string, score double, kept boolean, __m string"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choice(["th", "er", "an", "ti", "éo", "ñu", "sch", "la"]) for _ in range(RNG.randint(1, 4))) for _ in range(300)]


def prose(words: int) -> str:
    return " ".join(RNG.choice(VOCABULARY) for _ in range(words)).capitalize() + ".\n"


def table(spark, texts, first=0):
    rows = [
        (first + i, text, ["en", "de", None][i % 3], ["a", "b", None, "ä"][i % 4], 7, 1, 2, 3, 4, 5, "x", 0.5, True, "y")
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    base, long = prose(120), prose(9000)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    odd = [None, "", " \t\n ", "one", "two words", "a" * 30_000, "1 " * 4000, "¿漢字? 🙂 \x00 \x85", "THE!! " * 80]
    return [base, base, near, long, *odd, base[:400] + prose(80), *[prose(90) for _ in range(12)]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = table(spark, texts)
    return rows.union(rows.where("doc_id IN (0, 4, 8)")).repartition(3).cache()  # repeated rows


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, []).where("false")


def collected(df):
    return [tuple(row) for row in df.collect()]


def test_bpe_gives_the_library_s_tokens(docs, empty):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    text_of = {row.doc_id: row.text or "" for row in docs.collect()}
    got = bpe.encode_documents(docs, path, pattern).collect()
    assert len(got) == docs.count()
    for row in got:
        assert list(memoryview(row.ids).cast("I")) == library.encode_ordinary(text_of[row.doc_id])
        assert row.n_tokens == len(row.ids) // 4 and row.decodes
    for row in bpe.digest_documents(docs, path, pattern).collect():
        assert row.decoded_sha256 == hashlib.sha256(text_of[row.doc_id].encode()).hexdigest()
    assert bpe.encode_documents(empty, path, pattern).count() == 0


def test_adjacent_tokens_by_definition():
    coder = bpe.pairs(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    tokens = sorted(coder.parts)
    for _ in range(3000):
        a, b = RNG.choice(tokens), RNG.choice(tokens)
        assert coder.compatible(a, b) == (bpe.merged(a + b, coder.ranks) == [a, b])


def test_token_counts_are_the_library_s(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    text_of = {row.doc_id: row.text or "" for row in docs.collect()}
    for row in tokencount.count_tokens(docs, path, limit=100).collect():
        text = text_of[row.doc_id]
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert row.n_bytes == len(text.encode()) and row.over_limit == (row.n_tokens > 100)
    assert tokencount.count_tokens(empty, path).count() == 0


def test_chunk_maps_compose_at_any_cut():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, counter = Tokenizer.from_file(path), tokencount.counter(path)
    pieces = ["a", "the", " ", "\n", "É", "é", "'s", "!", "ΑΣ", "<|endoftext|>", "<|", "9", "漢"]
    for _ in range(300):
        text = "".join(RNG.choice(pieces) for _ in range(RNG.randint(0, 40)))
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert [counter.count(text, chunk) for chunk in (1, 3, 7, 1000)] == [want] * 4


def test_mix_meets_its_targets(spark, docs, empty):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    sizes = Counter()
    text_of = {row.doc_id: row.text or "" for row in docs.collect()}
    for row in rows:
        assert row.size == len(WORD.findall(text_of[row.doc_id])) and 0 <= row.takes <= 2
        sizes[row.source] += row.size
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, free = 1.5 * sum(sizes.values()), {}, list(order)
    while True:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if 2 * sizes[s] <= level * weight[s]]
        if not full:
            break
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
            free.remove(s)
    target |= {s: level * weight[s] for s in free}
    taken, largest = Counter(), Counter()
    for row in rows:
        assert row.target == pytest.approx(target[row.source]) and row.source_size == sizes[row.source]
        taken[row.source] += row.takes * row.size
        largest[row.source] = max(largest[row.source], row.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1 for s in sizes)
    assert sorted(collected(mixing.mix_sources(docs.repartition(5))), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mix_sources(empty).count() == 0


def test_language_of_held_out_texts(spark, empty):
    words = {lang: [f"{a}{b}" for a in start for b in "aeiou"] for lang, start in {"xx": ["th", "wr", "sh"], "yy": ["ñu", "lla", "qu"]}.items()}
    made = [(i, " ".join(RNG.choice(words[lang]) for _ in range(30)), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    rows = spark.createDataFrame(made + [(900, None, "xx"), (901, "12 !", "yy"), (902, "", None), (903, "llañuquo", None)], "doc_id long, text string, lang string")
    model = langid.fit(rows.where(~held_out(F.col("doc_id"))))
    got = {row.doc_id: row for row in langid.predict(rows, model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in made)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "yy"]
    nothing = langid.fit(empty)
    assert langid.predict(empty, nothing).count() == 0
    assert {row.lang_pred for row in langid.predict(rows, nothing).collect()} == {"und"}


def test_toxic_words_are_learned_and_disguises_seen(spark, empty):
    made = []
    for i in range(400):
        text = prose(40)
        if i % 4 == 0:
            text += [" vile", " Vile!", " badgerish"][i % 3]
        made.append((i, text, int(i % 4 == 0)))
    rows = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    lexicon = toxicity.fit(rows, "toxic", toxicity.Settings(least=3))
    odd = [(900, None), (901, ""), (902, prose(30) + "v1le"), (903, prose(30) + "vіle"), (904, prose(30) + "servile"), (905, "v" * 20_000)]
    got = {r.doc_id: r for r in toxicity.score(rows.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string")), lexicon).collect()}
    right = sum(got[i].predicted == toxic for i, _, toxic in made)
    assert right >= 396 and all(0 <= r.score <= 1 for r in got.values())
    assert [got[i].predicted for i in (900, 901, 902, 903, 904, 905)] == [0, 0, 1, 1, 0, 0]
    assert toxicity.score(empty, toxicity.fit(empty, "size")).count() == 0


def test_exception_phrases_do_not_count():
    entries = {"vile ": 5.0}
    plain = toxicity.Matcher(toxicity.Lexicon(entries))
    spared = toxicity.Matcher(toxicity.Lexicon(entries, {("vile ", " play")}))
    assert plain.features("a vile play")[1] == 1 and spared.features("a vile play")[1] == 0
    assert spared.features("a vile day")[1] == 1


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(1)
    points = rng.standard_normal((3000, 16))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] + [1.0] * 15), (9003, [None] + [1.0] * 15), (9004, [])]
    rows += [(5000, rows[7][1]), (5001, rows[7][1]), (100_000, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.where("vec_id % 50 = 0 OR vec_id = 7")
    got = {}
    for row in ann.neighbours(table, asked, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    usable = {i: np.array(v) for i, v in rows if i < 9000}
    hits = 0
    for query, found in got.items():
        true = sorted((np.sqrt(((usable[query] - v) ** 2).sum()), i) for i, v in usable.items() if i != query)[:10]
        hits += len({i for _, i in true} & {i for i, _ in found})
        assert found == sorted(found, key=lambda x: (x[1], x[0])) and len(found) == 10
    assert hits / (10 * len(got)) >= 0.9
    assert [i for i, _ in got[7][:2]] == [5000, 5001]  # a tie goes to the smaller id
    assert not {9000, 9001, 9002, 9003, 9004, 100_000} & set(got)
    assert ann.neighbours(table.where("false"), asked).count() == 0


def test_neighbours_of_repeated_and_clashing_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(rng.standard_normal((400, 8)))]
    rows += [rows[3]] * 150  # a third is one row
    schema = "vec_id long, embedding array<double>, id string, block string, ask string, dims string"
    table = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    # One id with two vectors, one row twice, and a null row.
    asked = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in ((5, rows[5][1]), (5, rows[6][1]), rows[7], rows[7], (8, None))], schema)
    got = ann.neighbours(table, asked, k=4).orderBy("query_id", "score", "vec_id").collect()
    for query, vectors in ((5, [rows[5][1], rows[6][1]]), (7, [rows[7][1]] * 2)):
        mine = [(r["rank"], r.vec_id, r.score) for r in got if r.query_id == query]
        want = []
        for vector in vectors:
            away = sorted((float(np.sqrt(((np.array(vector) - np.array(v)) ** 2).sum())), i) for i, v in rows if i != query)[:4]
            want += [(rank, i, pytest.approx(d)) for rank, (d, i) in enumerate(away, 1)]
        assert len(mine) == len(want)
        assert sorted(mine, key=lambda r: (r[2], r[1], r[0])) == sorted(want, key=lambda r: (r[2].expected, r[1], r[0]))
    assert {r.query_id for r in got} == {5, 7}


def test_windows_read_each_place_once():
    rng = np.random.default_rng(5)
    points, ids = rng.standard_normal((500, 12)), np.arange(500)
    block, read = ann.Block(points, ids, ann.Settings()), []
    plain = block.strips

    def strips(begin, end):
        read.append((end - begin).sum())
        return plain(begin, end)

    block.strips = strips
    (query, found, away, seen), = block.nearest(points[:1], ids[:1], 500)
    assert len(found) == 499 and sum(read) == 500 * block.settings.lines and seen == 499
    np.testing.assert_allclose(away, np.sort(np.sqrt(((points[1:] - points[0]) ** 2).sum(1))))


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats_by_brute_force(docs, empty, group):
    rows, counts = docs.collect(), Counter()
    for row in rows:
        data = (row.text or "").encode()
        counts.update(data[i : i + 200] for i in range(len(data) - 199))

    def plain(text):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 199):
            if counts[data[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(data, gone) if not g)
        return len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()

    want = Counter((row.doc_id, *plain(row.text)) for row in rows)
    assert Counter(collected(repeats.cleaned(docs, repeats.Settings(group=group)))) == want
    assert repeats.cleaned(empty).count() == 0


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def classes_by_brute_force(rows, n):
    sets = {row.doc_id: shingles(row.text, n) for row in rows}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    return sets, root


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_by_brute_force(spark, docs, empty, texts, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "LARGE", 2 if block == 3 else 32)
    chain = texts[3].split()[:200]  # a chain of copies: the ends are linked only through the middle
    versions = [" ".join(chain[4 * i : 4 * i + 160]) for i in range(8)]
    rows = docs.union(table(spark, versions, first=500))
    sets, root = classes_by_brute_force(rows.collect(), 4)
    got = neardup.classes(rows, neardup.Settings(shingle=4)).collect()
    assert len(got) == rows.count()
    for row in got:
        assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), root[row.doc_id])
        assert row.kept == (row.doc_id == row.component_id)
    if block == 512:
        assert neardup.classes(empty).count() == 0


def test_signature_bound_loses_no_link():
    settings = neardup.Settings()
    chunks = settings.chunks
    assert 2 * len(chunks) - 1 >= settings.bound and sum(map(len, chunks)) == settings.components
    assert settings.bound < settings.components // 2


def test_shingles_of_a_long_text(texts):
    settings = neardup.Settings(shingle=4)
    words = [f"W{i % 70001}\u00e9" for i in range(300_000)]
    assert len(neardup.Shingles(settings)("\t \n".join(words))) == len(shingles(" ".join(words), 4)) > 70_000
    one = "x" * (3 << 20)  # a word longer than a piece
    assert len(neardup.Shingles(settings)(f"a b {one} c d")) == 2
    for text in filter(None, texts):
        digests = neardup.Shingles(settings)
        assert len(digests(text)) == len(shingles(text, 4))
        assert (digests(text.swapcase()) == digests(text.swapcase().lower())).all() or not text.isascii()


def test_bitmaps_leave_out_no_link():
    settings, rng = neardup.Settings(shingle=4), np.random.default_rng(1)
    for size in (1, 5, 30, 150, 900, 5000):
        for _ in range(30):
            both, left, right = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) for n in (size, rng.integers(0, size // 4 + 1), rng.integers(0, size // 8 + 1)))
            x, y = np.unique(np.append(both, left)), np.unique(np.append(both, right))
            pair = [neardup.Sketches.of([neardup.signature(s, settings)], [neardup.bitmap(s)], [len(s)]) for s in (x, y)]
            pair[1].sig = pair[0].sig  # only the bitmaps decide
            assert len(neardup.close(*pair, settings)[0]) or not neardup.similar(x, y, settings.similarity)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def luhn(digits):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0

    def valid(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_base_spans_by_brute_force(spark, docs, empty):
    pieces = ["a", "b.c", "@", "@x.", "x.y", "1", "22", "300", "255", ".", "-", " ", "+", "(", ")", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "é🙂", "\n", "+49 (30) 1234567"]
    made = ["".join(RNG.choice(pieces) for _ in range(RNG.randint(0, 30))) for _ in range(400)]
    made += ["write to jo.do@mail.example.com or call +1 (555) 010-9999 4111111111111111", "1.2.3.4 " * 700]
    rows = docs.union(table(spark, made, first=1000))
    text_of = {row.doc_id: row.text for row in rows.collect()}
    got = pii.report(rows).collect()
    assert len(got) == rows.count()
    for row in got:
        want = base_spans(text_of[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert set(want) <= set(row.spans.split(",")) | {""}
    assert pii.report(empty).count() == 0


def test_the_method_adds_spans_and_masks(spark):
    good = [f"Please call {a}{b} now and write to me{a}@mail.example.com today" for a in range(200, 260) for b in ("-555-0199",)]
    cards = [f"phone: +1 ({a}) 555-0{a} 4111111111111111 thanks" for a in range(200, 260)]
    rows = table(spark, good + cards + [None, "", "no data here"])
    found = {r.doc_id: r.spans for r in pii.report(rows).collect()}
    assert sum("phone" in s for s in found.values()) >= 110  # none of these is a base span
    masked = {r.doc_id: r.text for r in pii.masked(rows).collect()}
    assert "@" not in masked[0] and "<EMAIL>" in masked[0] and masked[0].startswith("Please call ")
    assert masked[120] is None and masked[121] == "" and masked[122] == "no data here"
    assert pii.masked(rows).columns == rows.columns


def test_quality_counts_by_brute_force(docs, empty):
    text_of = {row.doc_id: row.text or "" for row in docs.collect()}
    got = quality.assess(docs).collect()
    assert len(got) == docs.count()
    for row in got:
        words = WORD.findall(text_of[row.doc_id])
        places = {}
        for i in range(len(words) - 2):
            places.setdefault(tuple(words[i : i + 3]), []).append(i)
        covered = {i + d for at in places.values() if len(at) > 1 for i in at for d in range(3)}
        lines = [line for line in text_of[row.doc_id].split("\n") if WORD.search(line)]
        symbols = len(re.findall(r"[#*$%&|<>]", text_of[row.doc_id]))
        want = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
        assert tuple(row[c] for c in quality.COUNTS) == want
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert row.base_failed == failed and not (row.kept and failed)
    assert quality.assess(empty).count() == 0


def test_rules_tell_junk_from_prose(spark):
    common = ["the", "of", "and", "to"]
    clean = [" ".join(RNG.choice(VOCABULARY + common * 20) for _ in range(90)).replace("er ", "er. ") for _ in range(150)]
    junk = [" ".join(RNG.choice(VOCABULARY) + RNG.choice(["###", "***", "|"]) for _ in range(90)) for _ in range(25)]
    kept = {r.doc_id for r in quality.assess(table(spark, clean + junk)).where("kept").collect()}
    assert len(kept & set(range(150))) >= 145 and len(kept - set(range(150))) <= 2


def test_pipeline_stages(spark, docs, empty):
    before = {row.doc_id: row.text for row in docs.collect()}
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "").cache()
        assert rows.columns == docs.columns, name
        ids = [row.doc_id for row in rows.collect()]
        assert set(ids) <= set(before)
        if name == "near-duplicates":
            assert len(ids) == len(set(ids)) and not {0, 1} <= set(ids)
        if name == "source mix":
            assert max(Counter(ids).values()) <= 2
        assert stage(spark, empty, "").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, rows, "")
    assert last.count() == rows.count() and last.where("NOT decodes").count() == 0


def test_stages_lose_no_row(spark):
    """Null and repeated ids, and columns with the names that stages used or use themselves."""
    words = ["the", "of", "and", "to"]
    good = [" ".join(RNG.choice(VOCABULARY + words * 20) for _ in range(90)).replace("er ", "er. ") for _ in range(12)]
    rows = [(None, text, "x", "y", 9, 9, 9, "z", None) for text in good[:4]]
    rows += [(5, text, "x", "y", 9, 9, 9, "z", f"s{i % 2}") for i, text in enumerate(good[4:8])]  # one id
    rows += [(i, text, "x", "y", 9, 9, 9, "z", "s1") for i, text in enumerate(good[8:], 20)] * 2  # copies
    rows += [(7, None, "x", "y", 9, 9, 9, "z", "s1"), (None, "", "x", "y", 9, 9, 9, "z", "s1")]
    schema = "doc_id bigint, text string, c0 string, c1 string, `row` bigint, __key bigint, __takes bigint, __take string, source string"
    docs = spark.createDataFrame(rows, schema).repartition(3).cache()

    def of(frame):
        assert frame.columns == docs.columns
        return Counter(map(tuple, frame.collect()))

    stages = dict(corpus_pipeline.STAGES)
    every, have_words = of(docs), Counter({r: n for r, n in of(docs).items() if r[1]})
    assert of(stages["personal data"](spark, docs, "")) == every
    kept = of(stages["quality rules"](spark, docs, ""))
    assert kept and all(n == every[r] for r, n in kept.items()) and not any(r[1] in (None, "") for r in kept)
    once = of(stages["near-duplicates"](spark, docs, ""))
    assert once == Counter(every.keys())
    mixed = of(stages["source mix"](spark, docs, ""))
    assert set(mixed) <= set(have_words) and all(n <= 2 * every[r] for r, n in mixed.items())
    assert {r[0] for r in mixed} >= {None, 5} and of(stages["source mix"](spark, docs.repartition(5), "")) == mixed
    assert stages["tokens"](spark, docs, "").count() == docs.count()


def test_near_duplicates_keep_the_smallest_id(spark):
    text = prose(60)
    rows = [(None, text), (9, text), (3, text), (3, text), (8, None), (8, None), (None, "other words here")]
    kept = neardup.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter({(3, text): 1, (8, None): 2, (None, "other words here"): 1})


@pytest.mark.parametrize("copies", [1, 500])
def test_bounded_sample(spark, copies):
    rows = [(lang, f"{lang} text {i % n}") for lang, n in (("a", 300), ("b", 20), (None, 3)) for i in range(n)]
    rows += [("c", "the only one")] * 200
    table = spark.createDataFrame(rows * (1 if copies == 1 else 2) + [rows[0]] * (copies - 1), "lang string, text string")
    found = [tuple(r) for r in bounded_sample(table, "lang", 50).collect()]
    assert Counter(r[0] for r in found) == {"a": 50, "b": 20, None: 3, "c": 1}
    assert len(set(found)) == len(found) and set(found) <= set(rows)
    again = [tuple(r) for r in bounded_sample(table.repartition(5), "lang", 50).collect()]
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert bounded_sample(table.where("false"), "lang", 50).count() == 0


def test_language_scores_by_definition(spark):
    """The whole operator again with plain dictionaries: counts, words first, then the longest known letter runs."""
    alphabets = {"x": ["abra", "cada", "bra", "zim"], "y": ["abra", "ox", "uru", "zam", "三"], "z": ["三一", "ox"]}
    texts = [(lang, " ".join(RNG.choice(ws) + RNG.choice(["", "", "s", "1"]) for _ in range(RNG.randint(1, 30)))) for lang, ws in alphabets.items() for _ in range(40)]
    texts += [(None, t) for t in ("abrax zimzam", "", None, "123 ½", "三 一二", "qqq", "Ox " * 5000, "三")]
    texts += [texts[0]] * 30 + [("x", "abra" * 11 + " bra"), (None, "abra" * 11), (None, "zim" * 4000)]
    docs = spark.createDataFrame([(i, text, lang, "x") for i, (lang, text) in enumerate(texts)], "doc_id bigint, text string, lang string, word string")
    settings = langid.Settings()
    counts = {}
    for lang, text in set(t for t in texts if t[0]):
        for word in langid.letters_of(text):
            counts.setdefault(word, Counter())[lang] += 1
    langs, longest = sorted(alphabets), settings.word_chars

    def table(rows, least):
        kept = {k: c for k, c in rows.items() if sum(c.values()) >= least}
        total = {lang: sum(c[lang] for c in kept.values()) + 0.5 * (len(kept) + 1) for lang in langs}
        return {k: [np.log((c[lang] + 0.5) / total[lang]) for lang in langs] for k, c in kept.items()}

    known, runs = table({w: c for w, c in counts.items() if len(w) <= longest}, settings.least), {}
    for size in range(1, settings.longest_run + 1):
        of_size = {}
        for word, c in counts.items():
            for run in langid.runs_of(word[:longest], size):
                of_size.setdefault(run, Counter()).update(c)
        runs[size] = table(of_size, 1)

    def score(text):
        words = langid.letters_of(text or "")
        if not words:
            return "und", 0.0
        total = np.zeros(len(langs))
        for word in words:
            found = [known[word]] if word in known else []
            for size in range(settings.longest_run, 0, -1):
                found = found or [runs[size][r] for r in langid.runs_of(word, size) if r in runs[size]]
            total += np.mean(found, axis=0) if found else 0
        odds = np.exp(total - total.max())
        return langs[int(odds.argmax())], odds.max() / odds.sum()

    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, langid.fit(docs)).collect()}
    for i, (_, text) in enumerate(texts):
        lang, share = score(text)
        assert got[i][0] == lang and got[i][1] == pytest.approx(share, abs=1e-9), text
    assert score("123 ½")[0] == "und" and score("三 一二")[0] != "und"


def test_capitals_newer_than_python(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    count = tokencount.counter(path).count
    for capital in tokencount.NEWER_CASE:
        for text in (chr(capital), f"a{chr(capital)}b", f"x {chr(capital)}{chr(capital)}y"):
            assert count(text) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_toxicity_by_definition(spark, seed):
    """The whole operator again without an automaton: counts, entries, exceptions, matches and scores."""
    settings, draw = toxicity.Settings(), random.Random(seed)
    bad, mild = ["grubnak", "zorblic", "fleck"], ["grub", "flecks", "zor"]
    long_word = "q" * 60
    texts = [(1, " ".join(draw.choice(VOCABULARY + bad * 40) for _ in range(25)) + f" {long_word}") for _ in range(40)]
    texts += [(0, " ".join(draw.choice(VOCABULARY + mild * 10) for _ in range(25))) for _ in range(90)]
    texts += [(0, f"the {'w' * 70} fleck of some words {i}") for i in range(4)]
    texts += [(None, t) for t in ("", None, "gr\u00adubnak Z0rbl1c", "FLECK " * 3000, "x" * 50_000 + " fleck", f"{'w' * 70} fleck", long_word, "fleck")]
    texts += [texts[0]] * 20
    docs = spark.createDataFrame([(i, text, label, "x") for i, (label, text) in enumerate(texts)], "doc_id bigint, text string, toxic int, score string")
    sample = {t for t in texts if t[0] is not None}
    n = Counter(label for label, _ in sample)

    def counts(keys):
        found = {}
        for label, text in sample:
            for key in keys(text or ""):
                found.setdefault(key, [0, 0])[1 - label] += 1
        return found

    seen = counts(lambda t: toxicity.entries_of(t, settings))
    entries = toxicity.chosen(((e, t, c) for e, (t, c) in sorted(seen.items()) if t >= settings.least), n[1], n[0], settings)
    names = list(entries)

    def matches(text):
        for start in range(len(text)):
            if start and text[start - 1].isalnum():
                continue
            best = None
            for at, entry in enumerate(names):
                word = entry.rstrip()
                end = start + len(word)
                whole = entry[-1] == " " and end < len(text) and text[end].isalnum()
                if text.startswith(word, start) and not whole:
                    best = max(best or (0, 0, ""), (len(word), at, entry))
            if best:
                end = start + best[0]
                while end < len(text) and text[end].isalnum():
                    end += 1
                before, after = toxicity.WORD.findall(text[:start]), toxicity.WORD.findall(text[end:])
                yield best[2], f"{before[-1] if before else ''} ", f" {after[0] if after else ''}"

    def phrases(text):
        return {(e, c) for e, b, a in matches(toxicity.folded(text)) for c in (b, a) if c != " "}

    exceptions = {key for key, (t, c) in counts(phrases).items() if c >= settings.least and not t}
    lexicon = toxicity.fit(docs, "toxic")
    assert lexicon.entries == entries and lexicon.exceptions == exceptions and exceptions

    def score(text):
        text = toxicity.folded(text or "")
        total = sum(entries[e] for e, b, a in matches(text) if (e, b) not in exceptions and (e, a) not in exceptions)
        words = text.count(" ") + text.count("\n") + 1
        x = [1.0, 1.0, np.log1p(total), np.log1p(1000 * total / words)] if total else [1.0, 0, 0, 0]
        return 1 / (1 + np.exp(-np.clip(np.dot(x, lexicon.logistic), -30, 30)))

    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs, lexicon).collect()}
    for i, (_, text) in enumerate(texts):
        want = score(text)
        assert got[i] == (pytest.approx(want, abs=1e-9), int(want >= 0.3)), (text or "")[:60]
