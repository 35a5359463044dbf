"""Pre-tokens of byte-level BPE, found for many texts at once.

The pattern cuts a text into contractions, letters, digits and other characters
(each with one space before it, if there is one) and white space. Characters are
classed by a table; runs of one class and the rules for the space before and for
white space before a word are then plain array work.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import regex

LETTER, DIGIT, SPACE, OTHER = range(4)
_APOSTROPHE, _BLANK, _BREAK = 0x27, 0x20, 0x0A
#: Fixed: what may follow an apostrophe as a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point, by its general category."""
    kinds = {"L": LETTER, "N": DIGIT}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    out[[ord(c) for c in regex.findall(r"\s", "".join(map(chr, range(0xD800))))]] = SPACE
    return out


class Pretokens:
    """Of texts: ``data`` their bytes one after another, ``starts`` and ``ends``
    of the pre-tokens in it, and ``doc`` the text of each."""

    def __init__(self, texts: list[bytes]):
        joined = b"".join(texts)
        self.data = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=begin[1:])
        # Characters: their code points and where their bytes begin.
        char_at = np.flatnonzero((self.data & 0xC0) != 0x80)
        code = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), "<u4")
        n = len(code)
        if not n:
            self.starts = self.ends = self.doc = np.zeros(0, np.int64)
            return
        text_start = np.zeros(n + 1, bool)
        text_start[np.searchsorted(char_at, begin)] = True
        text_start[0] = text_start[n] = True
        kind = classes()[code]

        cut = text_start[:n].copy()
        cut[1:] |= kind[1:] != kind[:-1]
        # White space before something else gives up its last character.
        space = kind == SPACE
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~text_start[1:n]
        cut |= last
        # One space goes with what follows it.
        with_next = np.zeros(n, bool)
        with_next[1:] = last[:-1] & (code[:-1] == _BLANK)
        cut &= ~with_next
        self._contract(code, kind, cut, text_start)

        first = np.flatnonzero(cut)
        self.starts = char_at[first]
        self.ends = np.append(self.starts[1:], len(self.data))
        self.doc = np.searchsorted(begin, self.starts, "right") - 1

    @staticmethod
    def _contract(code: np.ndarray, kind: np.ndarray, cut: np.ndarray, text_start: np.ndarray) -> None:
        n = len(code)
        lone = np.flatnonzero((code == _APOSTROPHE) & cut)
        lone = lone[lone + 1 < n]
        lone = lone[(kind[lone + 1] == LETTER) & ~text_start[lone + 1]]
        for at in lone.tolist():
            for tail in CONTRACTIONS:
                end = at + 1 + len(tail)
                if end <= n and not text_start[at + 1: end].any() and "".join(map(chr, code[at + 1: end])) == tail:
                    cut[at + 1] = False
                    if end < n:
                        cut[end] = True
                    break
