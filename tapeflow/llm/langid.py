"""Language identification: words first, backing off to ever shorter letter runs.

A word that the model knows is scored by its log frequency in each language. A word that it does
not know is scored by the longest letter runs it knows: runs of four letters, where none is known
three, two, one. The model is learned from a bounded sample and is bounded itself, so that it can be
sent to every task.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_rows, text_of

WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    docs_per_language: int = 4000  # bound of the learning sample
    words_per_language: int = 50_000  # bound of the model, the most frequent words
    least: int = 3  # a word seen less often is left to its letter runs
    longest_run: int = 4
    word_chars: int = 40  # longer words are learned by the runs of their first so many letters, not as words


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray  # log frequency, word by language
    runs: list[dict[str, int]]  # by length, longest first
    run_scores: list[np.ndarray]


def letters_of(text: str) -> list[str]:
    """Words with a letter, whatever else counts as a number (Han numerals are letters and numbers)."""
    return [w for w in WORDS.findall(text.lower()) if not w.isnumeric() or any(map(str.isalpha, w))]


def word_counts(labelled: DataFrame, settings: Settings) -> DataFrame:
    """(lang, word, n) of a sample, the most frequent words of each language; first summed where the texts are."""

    def run(parts: Iterator[dict]) -> Iterator[list]:
        for part in parts:
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(part["lang"], part["text"]):
                counts[lang].update(letters_of(text))
            rows = [(lang, w[: settings.word_chars + 1], n) for lang, c in counts.items() for w, n in c.items()]
            yield [list(column) for column in zip(*rows)] if rows else [[], [], []]

    from pyspark.sql import Window

    counts = map_rows(labelled, run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.words_per_language).drop("place")


def fit(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from the rows with a language. What comes to the driver is bounded by the settings.

    Null and empty texts teach nothing, of repeated rows one counts. An empty table, or one without a
    language, gives a model without languages. Columns may have any names.
    """
    labelled = docs.select(docs[lang_col].cast("string").alias("lang"), text_of(docs, text_col).alias("text"))
    sample = bounded_sample(labelled.where(F.col("lang").isNotNull()), "lang", settings.docs_per_language)
    rows = word_counts(sample, settings).collect()
    languages = sorted({row["lang"] for row in rows})
    at = {lang: i for i, lang in enumerate(languages)}
    words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    runs: list[dict[str, np.ndarray]] = [defaultdict(lambda: np.zeros(len(languages))) for _ in range(settings.longest_run)]
    for row in rows:
        lang, word, n = at[row["lang"]], row["word"], row["n"]
        if len(word) <= settings.word_chars:
            words[word][lang] += n
        word = word[: settings.word_chars]
        for size, table in zip(range(settings.longest_run, 0, -1), runs):
            for run in runs_of(word, size):
                table[run][lang] += n

    def table(counts: dict[str, np.ndarray], least: float) -> tuple[dict[str, int], np.ndarray]:
        kept = [key for key in sorted(counts) if counts[key].sum() >= least]
        if not kept:
            return {}, np.zeros((0, len(languages)))
        seen = np.array([counts[key] for key in kept])
        shares = (seen + 0.5) / (seen.sum(0) + 0.5 * (len(kept) + 1))
        return {key: i for i, key in enumerate(kept)}, np.log(shares)

    known, word_scores = table(words, settings.least)
    tables = [table(counts, 1) for counts in runs]
    return Model(languages, known, word_scores, [t[0] for t in tables], [t[1] for t in tables])


def runs_of(word: str, size: int) -> list[str]:
    """Letter runs of a word with its borders marked; single letters without borders."""
    marked = f"\x02{word}\x03" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


class Scorer:
    """Scores texts with a model; words seen before keep their row of scores. ``memory`` bounds those."""

    def __init__(self, model: Model, memory: int = 200_000):
        self.model, self.memory = model, memory
        self.reset()

    def reset(self) -> None:
        self.rows = dict(self.model.words)
        self.scores = np.vstack([self.model.word_scores, np.zeros((self.memory + 1, len(self.model.languages)))])
        self.used = len(self.model.words)

    def unseen(self, word: str) -> int:
        if self.used >= len(self.scores) - 1:
            self.reset()
        score = np.zeros(len(self.model.languages))
        for table, scores in zip(self.model.runs, self.model.run_scores):
            size = self.model.runs.index(table)
            found = [at for run in runs_of(word, len(self.model.runs) - size) if (at := table.get(run)) is not None]
            if found:
                score = scores[found].mean(0)
                break
        self.scores[self.used] = score
        self.rows[word] = self.used
        self.used += 1
        return self.used - 1

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = letters_of(text or "")
        if not words:
            return UNKNOWN, 0.0
        if len(words) > self.memory // 2:
            total = sum((self.sums(words[i : i + 50_000]) for i in range(0, len(words), 50_000)), np.zeros(1))
        else:
            total = self.sums(words)
        if not self.model.languages:
            return UNKNOWN, 0.0
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())

    def sums(self, words: list[str]) -> np.ndarray:
        if self.used + len(words) >= len(self.scores) - 1:
            self.reset()
        rows, unseen = self.rows, self.unseen
        ids = [at if (at := rows.get(w)) is not None else unseen(w) for w in words]
        return self.scores[ids].sum(0)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (the share of the best language).

    Texts are read whole. A null or empty text, or one without a letter, gives ``und`` and 0; so does every
    text if nothing could be learned. Ties go to the first language by code point. Repeated rows give
    repeated rows, other columns are left out, an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the settings
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        scorer = Scorer(sent.value)
        for part in parts:
            found = [scorer(text) for text in part["text"]]
            yield [part["id"], [lang for lang, _ in found], [score for _, score in found]]

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return map_rows(narrow, run, f"`{id_col}` {kind}, lang_pred string, score double")
