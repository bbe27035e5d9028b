"""Toxicity by a weighted lexicon.

Texts are folded first: compatibility forms, lower case, look-alike letters of other scripts, digits and signs
that stand for letters inside a word. An Aho-Corasick automaton then finds the entries of
the lexicon, which are whole words or beginnings of words. Entries count by their weight, except
inside exception phrases, and the sum is set against the length of the text. Weights, exceptions
and the map to a probability are learned from a bounded sample of labelled texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, durable, map_rows, text_of

# Letters of other scripts that look like Latin ones.
LOOKS = str.maketrans(
    "аеорсухіјѕһԁԛԝѵкмтвнгαοερτικνυχβγ",
    "aeopcyxijshdqwvkmtbhraoeptiknuxby",
)
# Digits and signs that stand for letters.
STANDS = str.maketrans("013457@$!|", "oieastasil")
INSIDE = re.compile(r"(?<=[^\W\d_])[013457@$!|]+(?=[^\W\d_])|(?<![\w@$!|])[013457@$](?=[^\W\d_]{3})")
HIDDEN = re.compile("[\xad\u200b-\u200d\u2060\ufeff]")
OTHER = re.compile("[\xad\u0370-\u052f\u200b-\u200d\u2060\ufeff]")
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    docs_per_class: int = 4000  # bound of the learning sample
    entries: int = 5000  # bound of the lexicon and of its exceptions: the strongest, the most frequent
    least: int = 4  # toxic texts of the sample that an entry must occur in
    weight: float = 2.0  # least log odds of an entry
    beginnings: tuple[int, ...] = (4, 5, 6, 7)  # lengths of beginnings of words
    candidates: int = 200_000  # bound of the counts that come to the driver: those of the most toxic texts


@dataclass
class Lexicon:
    """``entries``: weight by word (ends in a space) or beginning of a word. ``exceptions``: pairs (entry,
    word before with a space behind, or word after with a space in front)."""

    entries: dict[str, float]
    exceptions: set[tuple[str, str]] = field(default_factory=set)
    logistic: np.ndarray = field(default_factory=lambda: np.array([-3.0, 2.0, 1.0, 1.0]))


def folded(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii() and OTHER.search(text):
        text = HIDDEN.sub("", text).translate(LOOKS)
    return INSIDE.sub(lambda m: m.group().translate(STANDS), text)


def entries_of(text: str, settings: Settings) -> set[str]:
    words = set(WORD.findall(folded(text)))
    found = {w[:n] for n in settings.beginnings for w in words if len(w) > n}
    return found | {f"{w} " for w in words}


def word_before(text: str, end: int, reach: int = 48) -> str:
    """The last word before a place, however long and far."""
    while True:
        start = max(0, end - reach)
        last = None
        for last in WORD.finditer(text, start, end):
            pass
        if not start or last and last.start() > start:
            return last.group() if last else ""
        reach *= 4


def word_after(text: str, start: int) -> str:
    """The first word behind a place."""
    found = WORD.search(text, start)
    return found.group() if found else ""


class Matcher:
    """Finds the entries of a lexicon in folded text."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for entry in lexicon.entries:
            self.automaton.add_word(entry.rstrip(), None)
        for entry in lexicon.entries:
            word = entry.rstrip()
            kept = self.automaton.get(word, None) or []
            self.automaton.add_word(word, [*kept, entry])
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[str, int, int]]:
        """(entry, start, end of its word) in folded text; the longest entry where several begin."""
        if not len(self.automaton):
            return
        best: dict[int, tuple[str, int]] = {}
        size = len(text)
        for last, entries in self.automaton.iter(text):
            for entry in entries:
                start = last + 1 - len(entry.rstrip())
                if start and text[start - 1].isalnum():
                    continue
                if entry[-1] == " " and last + 1 < size and text[last + 1].isalnum():
                    continue
                best[start] = (entry, last + 1)
        for start, (entry, end) in best.items():
            while end < size and text[end].isalnum():
                end += 1
            yield entry, start, end

    def contexts(self, text: str) -> Iterator[tuple[str, str, str]]:
        """(entry, word before + ' ', ' ' + word after) of each match in folded text."""
        for entry, start, end in self.matches(text):
            yield entry, f"{word_before(text, start)} ", f" {word_after(text, end)}"

    def features(self, text: str | None) -> list[float]:
        """1, any match, log of the sum of weights, log of that sum per thousand words."""
        text = folded(text or "")
        weights, exceptions = self.lexicon.entries, self.lexicon.exceptions
        total = 0.0
        for entry, before, after in self.contexts(text):
            if exceptions and ((entry, before) in exceptions or (entry, after) in exceptions):
                continue
            total += weights[entry]
        if not total:
            return [1.0, 0.0, 0.0, 0.0]
        words = text.count(" ") + text.count("\n") + 1
        return [1.0, 1.0, math.log1p(total), math.log1p(1000 * total / words)]


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with labels, ``docs_per_class`` of each label at most. The rows are chosen before the texts
    are read, so the side that is sent to all tasks is bounded and no text is shuffled."""
    pairs = labels.select(labels[id_col].alias("of"), labels[label_col].cast("int").alias(label_col))
    ids = bounded_sample(pairs.where(F.col(label_col).isin(0, 1)), label_col, settings.docs_per_class)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias(text_col))
    return texts.join(F.broadcast(ids), F.col("id") == F.col("of")).select(label_col, text_col)


def fit(docs: DataFrame, label_col: str, settings: Settings = Settings(), text_col: str = "text") -> Lexicon:
    """Learns from labelled texts (label 0 or 1). What is collected is bounded by the settings.

    Rows with another label or none are left out; null and empty texts have no words. Of repeated rows one is learned from. Where a label is
    missing altogether, as in an empty table, the lexicon is empty. Columns may have any names.
    """
    labelled = docs.select(docs[label_col].cast("int").alias("label"), text_of(docs, text_col).alias("text"))
    sample = durable(bounded_sample(labelled.where("label IN (0, 1)"), "label", settings.docs_per_class))
    n = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if not n.get(1) or not n.get(0):
        return Lexicon({}, logistic=np.array([-3.0, 0, 0, 0]))
    counted = _counts(sample, lambda text: entries_of(text, settings)).where(F.col("toxic") >= settings.least)
    rows = counted.orderBy(F.desc("toxic"), "entry").limit(settings.candidates).collect()
    entries = chosen(((r["entry"], r["toxic"], r["clean"]) for r in rows), n[1], n[0], settings)
    matcher = Matcher(Lexicon(entries))

    def phrases(text: str) -> set[str]:
        found = set()
        for entry, before, after in matcher.contexts(folded(text)):
            found |= {f"{entry}\t{before}"} if before != " " else set()
            found |= {f"{entry}\t{after}"} if after != " " else set()
        return found

    # A phrase is an exception if it is known from several clean texts and from no toxic one.
    clean = _counts(sample, phrases).where((F.col("clean") >= settings.least) & (F.col("toxic") == 0))
    exceptions = {tuple(r["entry"].split("\t")) for r in clean.orderBy(F.desc("clean"), "entry").limit(settings.entries).collect()}
    lexicon = Lexicon(entries, exceptions)
    matcher = Matcher(lexicon)

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            yield [part["label"], [matcher.features(text) for text in part["text"]]]

    points = map_rows(sample, run, "label int, features array<double>").collect()  # at most two classes of docs_per_class
    lexicon.logistic = _logistic(np.array([p["features"] for p in points]), np.array([p["label"] for p in points], float))
    return lexicon


def _counts(sample: DataFrame, keys) -> DataFrame:
    """(entry, toxic, clean): in how many texts of each label a key occurs; first summed where the texts are."""

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            toxic, clean = Counter(), Counter()
            for label, text in zip(part["label"], part["text"]):
                (toxic if label else clean).update(keys(text))
            names = list(toxic | clean)
            yield [names, [toxic[k] for k in names], [clean[k] for k in names]]

    parts = map_rows(sample, run, "entry string, toxic bigint, clean bigint")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def chosen(counts, toxic: int, clean: int, settings: Settings) -> dict[str, float]:
    """The entries of the lexicon with their weights: strongest first; none that an entry already in covers."""
    ranked = []
    for entry, t, c in counts:
        weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if weight >= settings.weight:
            ranked.append((-weight * math.sqrt(t), entry[-1] != " ", -len(entry), entry, weight))
    entries: dict[str, float] = {}
    for _, _, _, entry, weight in sorted(ranked):
        word = entry.rstrip()
        if len(entries) < settings.entries and not any(word[:n] in entries for n in settings.beginnings):
            entries[entry] = weight
    return entries


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    keep = np.diag([0.0] + [ridge] * (x.shape[1] - 1)) + 1e-6 * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = (x * (p * (1 - p))[:, None]).T @ x + keep
        beta = beta + np.linalg.solve(slope, x.T @ (y - p) - keep @ beta)
    return beta


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score (0 to 1), predicted (1 if the score reaches the threshold).

    Texts are read whole. A null or empty text is scored like a text without matches. Repeated rows give
    repeated rows, other columns are left out, an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the settings
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        matcher, beta = Matcher(sent.value), sent.value.logistic
        for part in parts:
            x = np.array([matcher.features(text) for text in part["text"]]).reshape(-1, len(beta))
            yield [part["id"], (1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))).tolist()]

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    scored = map_rows(narrow, run, f"`{id_col}` {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
