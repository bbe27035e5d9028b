"""Quality rules as weak supervision, in DataFrame functions only.

Every rule votes good or bad for a document or abstains. Expectation-maximisation over the counts
of vote patterns estimates how often each rule is right about good and about bad documents, and
the share of good ones; a document is kept if its posterior probability of being good is a half or more.
The patterns are at most 3 to the power of the number of rules, so only they come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, let, text_of

SPACE = r"[\x20\x09-\x0D]"
# Frequent short words of English, German, French, Spanish.
COMMON = "the of and to in is that for it was on with as by are this und der die das den von ist mit ein et de la le les des est que en el los las del por"

GOOD, BAD, ABSTAIN = 1, -1, 0


@dataclass(frozen=True)
class Settings:
    least_words: int = 50  # hard limits: fewer words fail
    most_repeated: float = 0.5  # a larger share of repeated words fails
    prior: float = 0.8  # first guesses: share of good documents; how often a vote is right on good and on bad ones
    on_good: float = 0.95
    on_bad: float = 0.5
    rounds: int = 50
    smoothing: float = 5.0  # pseudo-votes for the first guess of an accuracy


#: Rules: (name, measure, good if, bad if). Between the two a rule abstains.
RULES: list[tuple[str, Callable[[Column], Column], Callable[[Column], Column], Callable[[Column], Column]]] = [
    ("symbols", lambda m: m["n_symbols"] / m["n_words"], lambda x: x < 0.02, lambda x: x > 0.1),
    ("duplicate_lines", lambda m: m["n_dup_lines"] / m["n_lines"], lambda x: x == 0, lambda x: x > 0.3),
    ("repeated_words", lambda m: m["n_repeat_words"] / m["n_words"], lambda x: x < 0.15, lambda x: x > 0.35),
    ("word_length", lambda m: m["word_chars"] / m["n_words"], lambda x: x.between(3.0, 9.0), lambda x: (x < 2.0) | (x > 12.0)),
    ("capitals", lambda m: m["n_upper"] / m["word_chars"], lambda x: x < 0.1, lambda x: x > 0.3),
    ("exclamations", lambda m: m["n_exclaim"] / m["n_words"], lambda x: x < 0.05, lambda x: x > 0.2),
    ("common_words", lambda m: m["n_common"] / m["n_words"], lambda x: x > 0.06, lambda x: x < 0.01),
    ("sentence_ends", lambda m: m["n_stops"] / m["n_words"], lambda x: x.between(0.02, 0.34), lambda x: x < 0.005),
]


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three words that occurs twice or more in the text.

    Windows are compared by 64-bit digests. Equal digests are neighbours after a sort, linear for
    texts without any repeat.
    """

    def of_windows(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            placed,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda x, j: F.when(
                        (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        words_in = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(words_in)

    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1,
        F.greatest(F.size(words) - 2, F.lit(0)),
    )
    return let(windows, of_windows)


def measures(text: Column) -> Column:
    """A struct of all counts of one text (not null)."""

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    words = let(F.array_remove(F.split(text, f"{SPACE}+"), ""), of_words)
    lines = let(F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), of_lines)
    return F.struct(
        words.alias("words"),
        lines.alias("lines"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count("[A-Z]").alias("n_upper"),
        count("!").alias("n_exclaim"),
        count(rf"(?<![^\x20\x09-\x0D])(?:{'|'.join(COMMON.split())})(?![^\x20\x09-\x0D.,;:!?])").alias("n_common"),
        count(r"[.!?:;](?![^\x20\x09-\x0D])").alias("n_stops"),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, keep: list[str], text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The columns ``keep``, the counts, ``base_failed`` and one vote column per rule."""
    # A filter on measures must not be pushed below and measure again for each column it names; it stops at a generator.
    once = F.inline(F.array(F.struct(measures(text_of(docs, text_col)).alias("__m"))))
    found = docs.select(*[docs[c] for c in keep], once)
    flat = {name: F.col(f"__m.{name}") for name in ("word_chars", "n_symbols", "n_upper", "n_exclaim", "n_common", "n_stops")}
    flat |= {name: F.col(f"__m.words.{name}") for name in ("n_words", "n_repeat_words")}
    flat |= {name: F.col(f"__m.lines.{name}") for name in ("n_lines", "n_dup_lines")}
    failed = (flat["n_words"] < settings.least_words) | (flat["n_repeat_words"] > flat["n_words"] * settings.most_repeated)
    votes = []
    for name, measure, good, bad in RULES:
        value = measure({k: F.nullif(v, F.lit(0)) if k in ("n_words", "n_lines", "word_chars") else v for k, v in flat.items()})
        vote = F.when(good(value), GOOD).when(bad(value), BAD).otherwise(ABSTAIN)
        votes.append(vote.cast("tinyint").alias(f"vote_{name}"))
    return found.select(*keep, *[flat[c].alias(c) for c in COUNTS], failed.alias("base_failed"), *votes)


@dataclass
class Reliability:
    """What expectation-maximisation found: share of good documents; by rule, how often a vote on a
    good document is good and on a bad document bad."""

    share: float
    on_good: dict[str, float] = field(default_factory=dict)
    on_bad: dict[str, float] = field(default_factory=dict)

    def weight(self, rule: str, vote: int) -> float:
        """Log odds that a vote adds."""
        good, bad = self.on_good[rule], self.on_bad[rule]
        return {GOOD: math.log(good / (1 - bad)), BAD: math.log((1 - good) / bad), ABSTAIN: 0.0}[vote]

    @property
    def base(self) -> float:
        return math.log(self.share / (1 - self.share))

    def posterior(self) -> Column:
        """The probability of being good, from the vote columns."""
        odds = F.lit(self.base)
        for rule in self.on_good:
            vote = F.col(f"vote_{rule}")
            odds = odds + (
                F.when(vote == GOOD, self.weight(rule, GOOD)).when(vote == BAD, self.weight(rule, BAD)).otherwise(0.0)
            )
        return 1 / (1 + F.exp(-odds))


def fit(votes: DataFrame, settings: Settings = Settings()) -> Reliability:
    """Expectation-maximisation over the vote patterns of all documents that pass the hard limits."""
    names = [name for name, *_ in RULES]
    patterns = votes.where(~F.col("base_failed")).groupBy(*[f"vote_{n}" for n in names]).count().collect()
    rows = [([row[f"vote_{n}"] for n in names], row["count"]) for row in patterns]
    found = Reliability(settings.prior, dict.fromkeys(names, settings.on_good), dict.fromkeys(names, settings.on_bad))
    for _ in range(settings.rounds if rows else 0):
        weighed = []
        for vote, n in rows:
            odds = found.base + sum(found.weight(name, v) for name, v in zip(names, vote))
            weighed.append((vote, n / (1 + math.exp(-max(-500.0, min(500.0, odds)))), n))
        total, good = sum(n for _, _, n in weighed), sum(g for _, g, _ in weighed)
        share = (good + settings.smoothing * settings.prior) / (total + settings.smoothing)
        on_good, on_bad = {}, {}
        for at, name in enumerate(names):
            extra = settings.smoothing
            yes = sum(g for vote, g, _ in weighed if vote[at] == GOOD)
            cast = sum(g for vote, g, _ in weighed if vote[at] != ABSTAIN)
            no = sum(n - g for vote, g, n in weighed if vote[at] == BAD)
            against = sum(n - g for vote, g, n in weighed if vote[at] != ABSTAIN)
            on_good[name] = min(0.999, (yes + settings.on_good * extra) / (cast + extra))
            on_bad[name] = min(0.999, (no + settings.on_bad * extra) / (against + extra))
        found = Reliability(min(0.999, max(0.001, share)), on_good, on_bad)
    return found


def judged(votes: DataFrame, found: Reliability) -> DataFrame:
    """Adds ``quality`` (posterior probability) and ``kept``."""
    return votes.withColumn("quality", found.posterior()).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: id, the counts, base_failed, the votes, quality, kept.

    Counts cover the whole text; a null text has no words and fails. Repeated rows give repeated rows,
    other columns are left out, an empty table gives an empty result.
    """
    votes = durable(measured(docs, [id_col], text_col, settings))
    return judged(votes, fit(votes, settings))


def keep_good(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents that are kept, with all their columns. Votes are computed again instead of joined, so
    that texts are not shuffled and rows need no key.

    A null or empty text fails; rows with null ids and repeated rows are judged like any others, each by its own text. Columns may have any names.
    An empty table gives an empty result.
    """
    found = fit(measured(docs, [], text_col, settings), settings)
    clear = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = f"c{docs.columns.index(text_col)}"
    kept = judged(measured(clear, clear.columns, at, settings), found).where("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
