"""Byte-level BPE encoding and decoding, in time linear in the text.

A sequence of tokens is the result of the merges if and only if every token is, and every two
adjacent tokens are, the result of the merges on their own bytes. So the encoder takes the longest
token at each place, checks it against the token before it, and goes back to a shorter one where
the two do not stand together. Tokens are found in a trie over bytes written as Latin-1 letters.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from .common import map_rows, text_of
from .unicode import splitter


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def merged(piece: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """The merges by definition: again and again the adjacent pair of lowest rank, the leftmost first,
    until ``least`` parts are left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > least:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class BytePairs:
    """Encoder and decoder for one vocabulary. ``memory`` bounds each of the two memos."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = 500_000):
        self.ranks, self.memory = ranks, memory
        self.split = splitter(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.reach = max(map(len, ranks), default=1)
        # The two parts that the last merge of a token joins. Tokens that merges never give have none.
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        for token in ranks:
            if len(token) == 1:
                self.parts[token] = None
            elif len(pair := merged(token, ranks, 2)) == 2:  # their join has a rank, so they merge
                self.parts[token] = (pair[0], pair[1])
        self.trie = ahocorasick.Automaton()
        for token in self.parts:
            self.trie.add_word(token.decode("latin-1"), len(token))
        self.edges = {token: (self.edge(token, 1), self.edge(token, 0)) for token in self.parts}
        self.together: dict[bytes, dict[bytes, bool]] = {}
        self.pairs_known = 0
        self.known: dict[str, bytes] = {}

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at one edge of ``token`` while it is put together, each with the rank
        of the merge that takes it up."""
        found, until = [(token, 1 << 60)], self.ranks[token]
        while pair := self.parts[token]:
            token = pair[side]
            found.append((token, until))
            until = self.ranks[token]
        return found

    def compatible(self, left: bytes, right: bytes) -> bool:
        """Whether the merges on the joined bytes of two tokens give these two tokens: no merge across
        the seam comes before the merges that take up its two sides. Of equal merges the left is first."""
        if self.pairs_known >= self.memory:
            self.together.clear()
            self.pairs_known = 0
        rank_of = self.ranks.get
        answer = True
        for a, a_until in self.edges[left][0]:
            for b, b_until in self.edges[right][1]:
                rank = rank_of(a + b)
                if rank is not None and rank < a_until and rank <= b_until:
                    answer = False
        self.together.setdefault(left, {})[right] = answer
        self.pairs_known += 1
        return answer

    def tokens(self, piece: bytes) -> list[bytes]:
        """The tokens of one match of the pattern."""
        if piece in self.ranks:
            return [piece]
        letters, end = piece.decode("latin-1"), len(piece)
        deepest, parts, together, none = self.trie.longest_prefix, self.parts, self.together, {}
        reach = self.reach
        found: list[bytes] = []
        before = None
        dead = bytearray(end + 1)  # places from which no valid sequence goes on
        at, size = 0, deepest(letters[:reach])  # the trie's deepest node; the last whole token may be shorter
        while at < end:
            while size:
                token = piece[at : at + size]
                if token in parts and not dead[at + size]:
                    if before is None:
                        break
                    fits = together.get(before, none).get(token)
                    if self.compatible(before, token) if fits is None else fits:
                        break
                size -= 1
            if size:
                found.append(token)
                before = token
                at += size
                size = deepest(letters[at : at + reach]) if at < end else 0
            elif found:
                dead[at] = 1
                size = len(found.pop())
                at -= size
                size -= 1
                before = found[-1] if found else None
            else:
                raise ValueError("the vocabulary lacks a byte")
        return found

    def ids_of(self, piece: str) -> bytes:
        ranks = self.ranks
        ids = array("I", [ranks[t] for t in self.tokens(piece.encode("utf-8", "replace"))]).tobytes()
        if len(self.known) >= self.memory:
            self.known.clear()
        if len(piece) <= 64:
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, ids_of = self.known, self.ids_of
        return b"".join([known.get(piece) or ids_of(piece) for piece in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def pairs(path: str, pattern: str) -> BytePairs:
    """One encoder per vocabulary and Python worker."""
    return BytePairs(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids (binary, 4 bytes each), decodes (the ids give the text's bytes back).

    ``path`` is a rank file that every executor can open. A null text counts as empty and gives no
    ids. Texts of any length are encoded whole. Repeated rows give repeated rows, other columns are
    left out, an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        coder = pairs(path, pattern)
        for part in parts:
            ids = [coder.encode(text) for text in part["text"]]
            back = [coder.decode(i) == text.encode("utf-8", "replace") for i, text in zip(ids, part["text"])]
            yield [part["id"], [len(i) // 4 for i in ids], ids, back]

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return map_rows(narrow, run, f"`{id_col}` {kind}, n_tokens bigint, ids binary, decodes boolean")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As :func:`encode_documents`, with SHA-256 digests in place of ids and bytes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(parts: Iterator[dict]) -> Iterator[list]:
        coder = pairs(path, pattern)
        sha = hashlib.sha256
        for part in parts:
            counts, ids_sha, text_sha = [], [], []
            for text in part["text"]:
                ids = coder.encode(text)
                counts.append(len(ids) // 4)
                ids_sha.append(sha(ids).hexdigest())
                text_sha.append(sha(coder.decode(ids)).hexdigest())
            yield [part["id"], counts, ids_sha, text_sha]

    narrow = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return map_rows(narrow, run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
