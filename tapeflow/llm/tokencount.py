"""Token counts by a compiled finite-state transducer.

The tokenizer is turned into a deterministic transducer over byte letters. A state holds, for
each place from which a token may still grow, the token that ends there and how many tokens fewer
that makes; a transition carries the change in the number of tokens. States are made on first
use. White space and the ends of words bring every state back to the start, so what a chunk of
text does to any state before it is told by its unsynchronised head, the count of its inside and its
unsynchronised tail. These chunk maps compose associatively, and a text is the scan of its chunks.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, text_of
from .unicode import WHITE_SPACE, splitter

CHUNK = 1 << 16

# Capital letters of Unicode 16 and 17 and their small ones, which Python's tables lack.
NEWER_CASE = {
    0x1C89: 0x1C8A,
    0xA7CB: 0x0264,
    0xA7CC: 0xA7CD,
    0xA7CE: 0xA7CF,
    0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB,
    0xA7DC: 0x019B,
    **{letter: letter + 0x20 for letter in range(0x10D50, 0x10D66)},
    **{letter: letter + 0x1B for letter in range(0x16EA0, 0x16EB9)},
}
NEWER_CAPITALS = re.compile(f"[{''.join(map(chr, NEWER_CASE))}]")
FOREVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(other)) for b in range(256)]


class Merges:
    """The merge rules: which neighbours join, and which two tokens stand side by side unchanged."""

    def __init__(self, rules: list[tuple[str, str]], end: str):
        self.end = end
        self.rank = {pair: rank for rank, pair in enumerate(rules)}
        self.parts = {a + b: (a, b) for a, b in rules}
        self.sound: dict[str, bool] = {}
        self.together: dict[tuple[str, str], bool] = {}

    def letters(self, token: str) -> list[str]:
        """The base letters of a token; the last of a word carries the end mark."""
        if token.endswith(self.end) and len(token) > len(self.end):
            return [*token[: -len(self.end) - 1], token[-len(self.end) - 1 :]]
        return list(token)

    def merged(self, letters: list[str]) -> list[str]:
        """The merges by definition."""
        parts = list(letters)
        while len(parts) > 1:
            rank, at = min((self.rank.get((parts[i], parts[i + 1]), FOREVER), i) for i in range(len(parts) - 1))
            if rank == FOREVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def is_token(self, token: str) -> bool:
        """Whether the merges on its own letters give this one token."""
        if token not in self.parts:
            return len(self.letters(token)) == 1
        if (answer := self.sound.get(token)) is None:
            answer = self.sound[token] = self.merged(self.letters(token)) == [token]
        return answer

    def edge(self, token: str, side: int) -> Iterator[tuple[str, int]]:
        until = FOREVER
        while True:
            yield token, until
            if token not in self.parts:
                return
            pair = self.parts[token]
            token, until = pair[side], self.rank[pair]

    def compatible(self, left: str, right: str) -> bool:
        """No merge across the seam comes before the merges that take up its two sides."""
        if (answer := self.together.get((left, right))) is None:
            if len(self.together) > 300_000:
                self.together.clear()
            answer = self.together[left, right] = not any(
                (rank := self.rank.get((a, b), FOREVER)) < a_until and rank <= b_until
                for a, a_until in self.edge(left, 1)
                for b, b_until in self.edge(right, 0)
            )
        return answer


class State(NamedTuple):
    """``open``: the letters that may still grow into a token. ``ends``: for each place before, between and
    after them, the token that ends there (None at the start) and its count less the count here."""

    open: tuple[str, ...]
    ends: tuple[tuple[str | None, int], ...]


START = State((), ((None, 0),))


class Transducer:
    """Deterministic; ``next[state][letter]`` is (state, change of the count). ``most`` bounds the states
    that are kept; when it is reached they are made anew."""

    def __init__(self, merges: Merges, most: int = 200_000):
        self.merges, self.most = merges, most
        self.grows = {tuple(letters[:n]) for token in merges.parts for letters in [merges.letters(token)] for n in range(1, len(letters))}
        self.reset()

    def reset(self) -> None:
        self.numbers, self.states, self.next = {START: 0}, [START], [{}]

    def step(self, at: int, letter: str) -> tuple[int, int]:
        opened, ends = self.states[at]
        for size in range(len(opened), -1, -1):
            token = "".join(opened[len(opened) - size :]) + letter
            before, less = ends[len(ends) - 1 - size]
            if self.merges.is_token(token) and (before is None or self.merges.compatible(before, token)):
                break
        else:
            raise ValueError("the vocabulary lacks a letter")
        change = less + 1
        letters, places = (*opened, letter), (*((t, c - change) for t, c in ends), (token, 0))
        keep = next((n for n in range(len(letters), 0, -1) if letters[len(letters) - n :] in self.grows), 0)
        state = State(letters[len(letters) - keep :], places[len(places) - 1 - keep :])
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.next.append({})
        self.next[at][letter] = (number, change)
        return number, change

    def count(self, letters: str) -> int:
        """Tokens of one word."""
        if len(self.states) > self.most:
            self.reset()
        at, total, table = 0, 0, self.next
        for letter in letters[:-1]:
            at, change = table[at].get(letter) or self.step(at, letter)
            total += change
        letter = letters[-1] + self.merges.end
        return total + (table[at].get(letter) or self.step(at, letter))[1]


class ChunkMap(NamedTuple):
    """What a chunk does to any state: ``head`` and ``tail`` are still open at its borders. Without white
    space the whole chunk is its head and ``tail`` is None."""

    head: str
    count: int
    tail: str | None


class Counter:
    """Counts the tokens of texts as the tokenizer of a JSON file does: NFC, lower case, split by its
    pattern, merges with an end-of-word mark. Special strings in a text count one each."""

    def __init__(self, path: str, memory: int = 400_000):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        pattern = config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        rules = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(Merges(rules, model["end_of_word_suffix"]))
        self.words = splitter(pattern)
        self.letters = str.maketrans({b: letter for b, letter in enumerate(byte_letters())})
        specials = [re.escape(t["content"]) for t in config["added_tokens"]]
        self.special = re.compile("|".join(specials) or "(?!)")
        self.space = re.compile(f"[{WHITE_SPACE}]")
        self.known: dict[str, int] = {}
        self.memory = memory

    def word(self, word: str) -> int:
        size = self.transducer.count(word.encode("utf-8", "replace").decode("latin-1").translate(self.letters))
        if len(self.known) >= self.memory:
            self.known.clear()
        if len(word) <= 64:
            self.known[word] = size
        return size

    def inside(self, text: str) -> int:
        """Tokens of a text that begins and ends at synchronising places."""
        if self.special.search(text):
            pieces = self.special.split(text)
            return len(pieces) - 1 + sum(map(self.plain, pieces))
        return self.plain(text)

    def plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # letter by letter, not by its place in the word
            text = text.replace("Σ", "σ")
        if NEWER_CAPITALS.search(text):
            text = text.translate(NEWER_CASE)
        known, word = self.known, self.word
        return sum([known.get(w) or word(w) for w in self.words(text.lower())])

    def chunk(self, text: str) -> ChunkMap:
        first = self.space.search(text)
        if first is None:
            return ChunkMap(text, 0, None)
        last = next(i for i in range(len(text) - 1, -1, -1) if self.space.match(text, i))
        return ChunkMap(text[: first.start()], self.inside(text[first.start() : last + 1]), text[last + 1 :])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if b.tail is None:
            if a.tail is None:
                return ChunkMap(a.head + b.head, 0, None)
            return ChunkMap(a.head, a.count, a.tail + b.head)
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail)
        return ChunkMap(a.head, a.count + self.inside(a.tail + b.head) + b.count, b.tail)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if len(text) <= chunk:
            return self.inside(text)
        maps = [self.chunk(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:  # the scan, pair by pair
            maps = [reduce(self.compose, maps[i : i + 2]) for i in range(0, len(maps), 2)]
        whole = maps[0]
        return self.inside(whole.head) + whole.count + self.inside(whole.tail or "")


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One transducer per file and Python worker."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit.

    ``path`` is a tokenizer file that every executor can open. A null text counts as empty, with 0
    tokens. Texts of any length are counted whole, chunk by chunk. Repeated rows give repeated rows, other columns
    are left out, an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        tokens = counter(path).count
        for part in parts:
            yield [part["id"], part["size"], [tokens(text) for text in part["text"]]]

    text = text_of(docs, text_col)
    narrow = docs.select(docs[id_col].alias("id"), F.octet_length(text).cast("long").alias("size"), text.alias("text"))
    counts = map_rows(narrow, run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
