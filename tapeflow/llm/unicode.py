"""Unicode classes for patterns, written out as ranges, so that the standard ``re`` can run them."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

# The code points of the Unicode property White_Space.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


@lru_cache(maxsize=None)
def ranges(major: str, last: int) -> str:
    """All code points up to ``last`` of a major category (``L``, ``N``), as the inside of a bracket."""
    out, start = [], None
    for point in range(last + 2):
        inside = point <= last and unicodedata.category(chr(point))[0] == major
        if inside and start is None:
            start = point
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{point - 1:08x}")
            start = None
    return "".join(out)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of a pattern. Texts without code points beyond U+FFFF take a form whose classes
    end there: those ``re`` keeps as bit maps, the others as lists."""
    low, full = re.compile(translated(pattern, 0xFFFF)).findall, re.compile(translated(pattern)).findall
    high = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: full(text) if high(text) else low(text)


def translated(pattern: str, last: int = sys.maxunicode) -> str:
    """A pattern with ``\\p{L}``, ``\\p{N}``, ``\\s`` and ``\\S`` written out."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        for code, body in (("\\p{L}", "L"), ("\\p{N}", "N"), ("\\s", "s"), ("\\S", "S")):
            if pattern.startswith(code, at):
                points = WHITE_SPACE if body in "sS" else ranges(body, last)
                if inside and body == "S":
                    raise ValueError("no complement inside a bracket")
                out.append(points if inside else f"[{'^' * (body == 'S')}{points}]")
                at += len(code)
                break
        else:
            step = 2 if pattern[at] == "\\" else 1
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            out.append(pattern[at : at + step])
            at += step
    return "".join(out)
