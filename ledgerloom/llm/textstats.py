"""Counts per text that quality rules and heuristic labellers are made of."""

from __future__ import annotations

import numpy as np

from ledgerloom.llm import words as W

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_STARTS_CHAR = np.ones(256, bool)
_STARTS_CHAR[0x80:0xC0] = False
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True
_REPEAT = 5


def per_text(found: W.Words, at: np.ndarray) -> np.ndarray:
    """How many of the marked bytes each text has."""
    total = np.zeros(len(at) + 1, np.int64)
    np.cumsum(at, out=total[1:])
    return np.diff(total[found.begin])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _in_text(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return W.mixed(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def stats(texts: list[bytes | None]) -> tuple[W.Words, dict[str, np.ndarray]]:
    """``texts`` with case kept, and arrays of counts, one number per text."""
    found = W.Words(texts, W.NOT_SPACE, lower=False)
    data, n = found.data, len(texts)
    out = {"n_words": found.counts.astype(np.int64)}
    out["word_chars"] = per_text(found, W.NOT_SPACE[data] & _STARTS_CHAR[data])
    out["n_symbols"] = per_text(found, SYMBOLS[data])
    out["upper"] = per_text(found, _UPPER[data])
    out["lower"] = per_text(found, _LOWER[data])

    # Every text ends with a line feed of its own here.
    line_end = np.flatnonzero(data == 0x0A)
    line_start = np.concatenate(([0], line_end[:-1] + 1)) if len(line_end) else line_end
    line_doc = np.searchsorted(found.begin, line_start, "right") - 1
    filled = np.searchsorted(found.starts, line_start) < np.searchsorted(found.starts, line_end)
    line_start, line_end, line_doc = line_start[filled], line_end[filled], line_doc[filled]
    keys = _in_text(found.sums.of(line_start, line_end), line_doc)
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(line_doc, minlength=n)
    out["n_lines"] = lines
    out["n_dup_lines"] = lines - np.bincount(line_doc[first], minlength=n)
    ended = np.bincount(line_doc[_STOPS[data[line_end - 1]]], minlength=n) if len(line_end) else lines
    out["n_ended_lines"] = ended

    grams, one = found.windows(_REPEAT)
    at = np.flatnonzero(one)
    twice = at[repeated(_in_text(grams[at], found.doc[at]))]
    inside = W.covered(twice, _REPEAT, len(found.hashes))
    out["n_repeat_words"] = np.bincount(found.doc[inside], minlength=n)
    lengths = found.ends - found.starts
    out["n_short_words"] = np.bincount(found.doc[lengths <= 3], minlength=n)
    lone = (lengths == 1) & SYMBOLS[data[found.starts]]
    out["n_lone_symbols"] = np.bincount(found.doc[lone], minlength=n)
    return found, {k: v.astype(np.int64) for k, v in out.items()}
