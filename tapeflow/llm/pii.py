"""Personal data by weak supervision, in DataFrame functions only.

Four strict patterns give the base spans, which always stay. Wider patterns give candidates. For
every candidate and base span, labelers vote yes or no or abstain: the shape of the value, gazetteers, words
around it, its borders, the variety of its digits. Expectation-maximisation over the vote patterns estimates how
reliable each labeler is, and its posteriors train the span classifier, a naive Bayes model over coarse
features, which decides on the candidates. Only counts by vote pattern and by feature value come to the
driver; both are bounded by the number of labelers and features.

Positions are code points. They come from the lengths of the pieces that a pattern leaves and of its
matches, summed block by block. Patterns are possessive, so that long runs cost linear time.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, let, text_of

# The kinds in the order of the result; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "person")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wider shapes and the word lists of the labelers.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}+(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z0-9-]{1,63}+)++",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme)\.? [A-Z][a-z]{1,30}+(?: [A-Z][a-z]{1,30}+)?",
}
CUES = {
    "email": "mail|contact|write|address",
    "ip": "ip|host|server|address",
    "card": "card|visa|master|payment|credit",
    "phone": "phone|tel|call|mobile|fax|contact",
    "ssn": "ssn|social|security",
    "iban": "iban|account|bank|transfer",
    "person": "dear|name|signed|by|from",
}
AGAINST = r"version|isbn|order|invoice|part|serial|page|chapter|figure|release|build|lot|example"
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|it|nl|ch|at|br|mx|ca|au|in|jp|cn"
COUNTRIES = "AD|AE|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK|SM"
NAMES = "James|John|Robert|Michael|William|David|Mary|Anna|Maria|Peter|Hans|Klaus|Jean|Pierre|Marie|Jose|Juan|Carlos|Carmen|Luis"

BLOCK = 256
LEFT, RIGHT = 24, 1
LABELERS = ("shape", "gazetteer", "context", "borders", "variety")
FEATURES = ("kind", "size", "digits", "cue", "border", "signs")


@dataclass(frozen=True)
class Settings:
    prior: float = 0.5
    accuracy: float = 0.8
    rounds: int = 50
    smoothing: float = 5.0
    threshold: float = 0.5


def running(lengths: Column) -> Column:
    """The sum of the lengths before each one; blocks first, so that arrays are not copied again and again."""

    def sums(numbers: Column) -> Column:
        return F.aggregate(numbers, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def joined(blocks: Column) -> Column:
        ahead = sums(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return let(
            ahead,
            lambda a: F.flatten(
                F.transform(blocks, lambda b, i: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x + F.get(a, i)))
            ),
        )

    count = F.floor((F.size(lengths) - 1) / BLOCK).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(count, F.lit(0)))
    return let(F.transform(starts, lambda b: sums(F.slice(lengths, b * BLOCK + 1, BLOCK))), joined)


def spans(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost and non-overlapping: array of (start, end, value)."""

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        lengths = let(
            between,
            lambda b: F.flatten(F.transform(found, lambda m, i: F.array(F.length(F.get(b, i)), F.length(m)))),
        )
        return let(
            running(lengths),
            lambda at: F.transform(
                found,
                lambda m, i: F.struct(
                    F.get(at, 2 * i + 1).alias("start"), (F.get(at, 2 * i + 1) + F.length(m)).alias("end"), m.alias("value")
                ),
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none)
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: let(
            F.substring(digits, n + 1 - i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_card(value: Column) -> Column:
    return let(digits_of(value), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


#: Which matches of the base patterns count.
VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(
        F.split(v, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255)
    ),
    "card": is_card,
    "phone": lambda v: F.length(digits_of(v)).between(9, 15),
}


def candidates(text: Column, base: Column) -> Column:
    """Matches of the wider patterns that no base span touches, card numbers by their check digit: array of (start, end, value, kind)."""
    wide = "|".join(WIDE.values())
    sound = lambda v: ~v.rlike(rf"\A(?:{WIDE['card']})\z") | is_card(v)
    kind = lambda v: F.coalesce(*[F.when(v.rlike(rf"\A(?:{p})\z"), k) for k, p in WIDE.items()], F.lit("person"))
    return let(
        base,
        lambda b: F.transform(
            F.filter(
                spans(text, wide), lambda c: ~F.exists(b, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])) & sound(c["value"])
            ),
            lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"), kind(c["value"]).alias("kind")),
        ),
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def judged(text: Column, span: Column, kind: Column, base: bool) -> Column:
    """A span with the votes of the labelers and the features of the classifier."""
    value, start, end = span["value"], span["start"], span["end"]
    left = F.substring(text, F.greatest(start - LEFT + 1, F.lit(1)), F.least(start, F.lit(LEFT)))
    right = F.substring(text, end + 1, F.lit(RIGHT))

    def of(parts: Column) -> Column:
        left, right, digits = parts["left"], parts["right"], parts["digits"]
        cue = F.coalesce(*[F.when(kind == k, left.rlike(rf"(?i)(?<![a-z])(?:{c})")) for k, c in CUES.items()], F.lit(False))
        against = left.rlike(rf"(?i)(?<![a-z])(?:{AGAINST})")
        glued = left.rlike(r"[\p{L}\p{N}_]\z") | right.rlike(r"\A[\p{L}\p{N}_]")
        sizes = F.length(digits)
        shape = F.coalesce(
            F.when(F.lit(base), 1),
            F.when(kind == "card", F.when(is_card(value), 1).otherwise(-1)),
            F.when(kind == "phone", F.when(sizes.between(10, 13), 1).otherwise(-1)),
            F.when(kind == "ssn", F.when(value.rlike(r"\A(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), 1).otherwise(-1)),
            F.when(kind == "iban", F.when(F.length(F.regexp_replace(value, " ", "")).between(15, 34), 1).otherwise(-1)),
            F.when(kind == "email", F.when(value.rlike(r"[\[(]at[\])]|\bdot\b"), 1).otherwise(-1)),
            F.lit(0),
        )
        gazetteer = F.coalesce(
            F.when(kind == "email", _vote(value.rlike(rf"(?i)[. )\]](?:{DOMAINS})\z"), ~value.rlike(r"(?i)[a-z]{2,24}\z"))),
            F.when(kind == "iban", _vote(value.rlike(rf"\A(?:{COUNTRIES})"), ~value.rlike(rf"\A(?:{COUNTRIES})"))),
            F.when(kind == "person", _vote(value.rlike(rf" (?:{NAMES})(?: |\z)"), F.lit(False))),
            F.when(kind == "card", _vote(value.rlike(r"\A(?:4|5[1-5]|2[2-7]|3[47]|6)"), value.rlike(r"\A[0189]"))),
            F.when(kind == "phone", _vote(value.rlike(r"\A\+|\A\(?[2-9]"), value.rlike(r"\A\(?[01]"))),
            F.lit(0),
        )
        varied = F.size(F.array_distinct(F.split(digits, ""))) > 2
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            kind.alias("kind"),
            F.lit(base).alias("base"),
            F.struct(
                shape.alias("shape"),
                gazetteer.alias("gazetteer"),
                _vote(cue & ~against, against & ~cue).alias("context"),
                _vote(~glued, glued).alias("borders"),
                F.when(sizes < 6, 0).when(varied, 1).otherwise(-1).alias("variety"),
            ).alias("votes"),
            F.struct(
                kind.alias("kind"),
                F.least(F.floor(F.length(value) / 4), F.lit(12)).cast("string").alias("size"),
                F.floor(4 * sizes / F.length(value)).cast("string").alias("digits"),
                F.when(cue, "for").when(against, "against").otherwise("none").alias("cue"),
                F.when(glued, "glued").otherwise("free").alias("border"),
                F.when(value.rlike(r"[\[(]"), "brackets").when(value.rlike("[-.]"), "marks").when(value.contains(" "), "spaces").otherwise("none").alias("signs"),
            ).alias("features"),
        )

    return let(F.struct(left.alias("left"), right.alias("right"), digits_of(value).alias("digits")), of)


def _valid(kind: str) -> Callable[[Column], Column]:
    return lambda s: VALID[kind](s["value"])


def _as_base(text: Column, kind: str) -> Callable[[Column], Column]:
    return lambda s: judged(text, s, F.lit(kind), True)


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["base"] & (s["kind"] == kind)


def found_spans(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``spans``: base spans and candidates with votes and features."""
    text = F.col("__text")
    rows = docs.select(*[docs[c] for c in keep], text_of(docs, text_col).alias("__text"))
    needs = {"email": text.contains("@"), "phone": text.contains("+")}
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    base = F.struct(
        *[
            F.when(needs.get(k, text.rlike("[0-9]")), F.filter(spans(text, p), _valid(k))).otherwise(none).alias(k)
            for k, p in BASE.items()
        ]
    )
    rows = rows.withColumn("__base", base)
    every = F.concat(*[F.col(f"__base.{k}") for k in BASE])
    rows = rows.withColumn("__more", candidates(text, every))
    marked = [F.transform(F.col(f"__base.{k}"), _as_base(text, k)) for k in BASE]
    more = F.transform(F.col("__more"), lambda s: judged(text, s, s["kind"], False))
    return rows.select(*keep, F.concat(*marked, more).alias("spans"))


@dataclass
class Classifier:
    """Log odds: ``base`` and one weight per feature value; values never seen weigh nothing."""

    base: float
    weights: dict[str, dict[str, float]]

    def probability(self, features: Column) -> Column:
        odds = F.lit(self.base)
        for name, table in self.weights.items():
            for value, weight in table.items():
                odds = odds + F.when(features[name] == value, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], settings: Settings) -> tuple[float, list[tuple[float, float]]]:
    """Expectation-maximisation: the share of true spans and, by labeler, how often its vote is right on
    true and on false ones."""
    share, right = settings.prior, [(settings.accuracy, settings.accuracy)] * len(LABELERS)
    for _ in range(settings.rounds if patterns else 0):
        weighed = [(votes, n * belief(votes, share, right), n) for votes, n in patterns]
        total, true = sum(n for *_, n in weighed), sum(t for _, t, _ in weighed)
        share = min(0.999, max(0.001, (true + settings.smoothing * settings.prior) / (total + settings.smoothing)))
        first, extra = settings.smoothing * settings.accuracy, settings.smoothing
        right = [
            (
                min(0.99, (sum(t for v, t, _ in weighed if v[i] > 0) + first) / (sum(t for v, t, _ in weighed if v[i]) + extra)),
                min(0.99, (sum(n - t for v, t, n in weighed if v[i] < 0) + first) / (sum(n - t for v, t, n in weighed if v[i]) + extra)),
            )
            for i in range(len(LABELERS))
        ]
    return share, right


def belief(votes: tuple[int, ...], share: float, right: list[tuple[float, float]]) -> float:
    odds = math.log(share / (1 - share))
    for vote, (on_true, on_false) in zip(votes, right):
        odds += math.log(on_true / (1 - on_false)) if vote > 0 else math.log((1 - on_true) / on_false) if vote < 0 else 0.0
    return 1 / (1 + math.exp(-odds))


def fit(found: DataFrame, settings: Settings = Settings()) -> Classifier:
    """Labelers' reliabilities over all spans, then the span classifier from their posteriors."""
    each = found.select(F.explode("spans").alias("span")).select("span.votes", "span.features")
    counted = durable(each.groupBy("votes", "features").count())
    patterns = [(tuple(row["votes"]), row["n"]) for row in counted.groupBy("votes").agg(F.sum("count").alias("n")).collect()]
    share, right = reliabilities(patterns, settings)
    odds = F.lit(math.log(share / (1 - share)))
    for name, (on_true, on_false) in zip(LABELERS, right):
        vote = F.col(f"votes.{name}")
        odds = odds + F.when(vote > 0, math.log(on_true / (1 - on_false))).when(vote < 0, math.log((1 - on_true) / on_false)).otherwise(0.0)
    soft = counted.withColumn("true", F.col("count") / (1 + F.exp(-odds)))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"features.{n}").alias("value")) for n in FEATURES]))
    rows = soft.select(pairs.alias("f"), "true", "count").groupBy("f.name", "f.value").agg(F.sum("true").alias("true"), F.sum("count").alias("n")).collect()
    true = sum(r["true"] for r in rows) / len(FEATURES)
    false = sum(r["n"] for r in rows) / len(FEATURES) - true
    k = settings.smoothing
    weights: dict[str, dict[str, float]] = {name: {} for name in FEATURES}
    for r in sorted(rows, key=lambda r: (r["name"], r["value"])):
        weights[r["name"]][r["value"]] = math.log((r["true"] + 1) / (true + k)) - math.log((r["n"] - r["true"] + 1) / (false + k))
    return Classifier(math.log((true + 1) / (false + 1)), weights)


def decided(found: DataFrame, model: Classifier, settings: Settings = Settings()) -> DataFrame:
    """Keeps base spans and the candidates that the classifier accepts, in the order of kinds and starts."""
    order = F.array(*[F.lit(k) for k in KINDS])
    taken = F.filter("spans", lambda s: s["base"] | (model.probability(s["features"]) >= settings.threshold))
    place = lambda s: F.struct(
        F.array_position(order, s["kind"]).cast("int").alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")
    )
    return found.withColumn("spans", F.array_sort(F.transform(taken, place)))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: id and ``spans``, an array of (order, start, end, kind, base).

    Texts are read whole; a null or empty text has no spans. Repeated rows give repeated rows, other columns
    are left out, an empty table gives an empty result.
    """
    found = durable(found_spans(docs, [id_col], text_col))
    return decided(found, fit(found, settings), settings)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`find` with counts of base spans by kind, their digest, and all spans as one string."""
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    rows = find(docs, id_col, text_col)
    return rows.select(id_col, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; other columns stay. Spans that
    touch one another are replaced as one, under the kind that comes first.

    Null and empty texts stay as they are, as do rows with null ids; repeated rows are changed alike. Columns may have
    any names. An empty table gives an empty result.
    """
    clear = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = f"c{docs.columns.index(text_col)}"
    model = fit(durable(found_spans(docs, [], text_col)), settings)
    rows = decided(found_spans(clear, clear.columns, at), model, settings)

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return (
            F.when(F.size(acc) == 0, F.array(s))
            .when(s["start"] < F.try_element_at(acc, F.lit(-1))["end"], F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer)))
            .otherwise(F.concat(acc, F.array(s)))
        )

    plain = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    whole = F.aggregate(plain, F.array().cast("array<struct<start:int,end:int,kind:string>>"), merge)
    text = F.col(at)

    def rebuilt(all_spans: Column) -> Column:
        before = F.transform(
            all_spans,
            lambda s, i: F.concat(
                let(
                    F.when(i == 0, 0).otherwise(F.get(all_spans, i - 1)["end"]), lambda start: F.substring(text, start + 1, s["start"] - start)
                ),
                F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")),
            ),
        )
        last = F.element_at(all_spans, -1)["end"]
        return F.concat(F.array_join(before, ""), F.substring(text, last + 1, F.length(text)))

    changed = F.when(F.size("spans") > 0, let(whole, rebuilt)).otherwise(text)
    return rows.select(*[(changed if f"c{i}" == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
