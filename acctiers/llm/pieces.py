"""Splitting text by the public pre-tokenizer patterns, with Unicode classes written out for ``re``."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

# Code points with the Unicode property White_Space (fixed values).
WHITE_SPACE_POINTS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WHITE_SPACE = "".join(map(chr, WHITE_SPACE_POINTS))


@lru_cache(maxsize=None)
def category_class(initial: str, top: int = sys.maxunicode) -> str:
    """Ranges of the code points up to ``top`` whose general category starts with ``initial``, for a ``[...]`` class."""
    out, start = [], None
    for code in range(top + 2):
        inside = code <= top and unicodedata.category(chr(code))[0] == initial
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}" + (f"-\\U{code - 1:08x}" if code - 1 > start else ""))
            start = None
    return "".join(out)


@lru_cache(maxsize=None)
def compiled(pattern: str, top: int = sys.maxunicode) -> re.Pattern:
    r"""``pattern`` with \p{L}, \p{N}, \s and \S replaced by explicit classes; right for texts of code points up to ``top``."""
    out, inside, i = [], False, 0
    named = {r"\p{L}": category_class("L", top), r"\p{N}": category_class("N", top), r"\s": WHITE_SPACE}
    while i < len(pattern):
        if pattern.startswith(r"\S", i):
            out.append(f"[^{WHITE_SPACE}]")
            i += 2
            continue
        name = next((n for n in named if pattern.startswith(n, i)), None)
        if name:
            out.append(named[name] if inside else f"[{named[name]}]")
            i += len(name)
            continue
        if pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
            continue
        inside = (inside or pattern[i] == "[") and pattern[i] != "]"
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


def find_all(pattern: str, text: str) -> list[str]:
    """All matches.  Classes cut to what the text can hold are small tables, which ``re`` looks up much faster."""
    if text.isascii():
        top = 0x7F
    elif len(text.encode("latin-1", "ignore")) == len(text):
        top = 0xFF
    elif len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text):
        top = 0xFFFF
    else:
        top = sys.maxunicode
    return compiled(pattern, top).findall(text)


class Cache(dict):
    """Results by piece.  At ``limit`` entries it starts anew, which bounds a worker's memory."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, piece):
        if len(self) >= self.limit:
            self.clear()
        value = self[piece] = self.compute(piece)
        return value
