"""Linear scorer over hashed word and character n-grams.

A text is its frequencies of n-grams relative to their number plus ``PRIOR``,
one block of ``BUCKETS`` for each kind of n-gram. A score is then a sum of means
of weights and needs one pass over the bytes, and a text of few n-grams stays
near the bias. The weights are fitted by logistic regression on a bounded sample of
rows; a held-out fifth of it calibrates the scores to probabilities. There is no
constant term: a text without evidence has the odds of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ledgerloom.llm import words as W

BUCKETS = 1 << 14
KINDS = 4
PRIOR = 16
_SHIFT = np.uint64(64 - 14)
_TWICE = np.uint64(2)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _chars(data: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(data) - size + 1)
    packed = np.zeros(n, np.uint64)
    for k in range(size):
        packed |= data[k: k + n].astype(np.uint64) << np.uint64(8 * k)
    return packed


def grams(found: W.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind: its number, buckets of all n-grams, and each text's range."""
    for kind, size in enumerate((1, 2)):
        hashes, _ = W.windows(found.hashes, found.doc, size)
        if size == 2:
            # A word twice is one and the same bigram, whichever word it is.
            hashes[found.hashes[1:] == found.hashes[:-1]] = _TWICE
        last = np.maximum(found.bounds[1:] - size + 1, found.bounds[:-1])
        # Texts without a word at the end of a slice start beyond the last bigram.
        yield kind, hashes, np.minimum(found.bounds[:-1], len(hashes)), np.minimum(last, len(hashes))
    for kind, size in enumerate((3, 5), 2):
        packed = _chars(found.data, size)
        last = np.maximum(found.begin[1:] - 1 - size + 1, found.begin[:-1])
        yield kind, packed, np.minimum(found.begin[:-1], len(packed)), np.minimum(last, len(packed))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _MULTIPLY) >> _SHIFT).astype(np.int32)


def logits(found: W.Words, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(found.counts))
    for kind, hashes, first, last in grams(found):
        own = weights[kind * BUCKETS: (kind + 1) * BUCKETS][_bucket(hashes)]
        total = np.zeros(len(own) + 1)
        np.cumsum(own, out=total[1:])
        last = np.maximum(first, last)
        out += (total[last] - total[first]) / (last - first + PRIOR)
    return out


def vectors(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features of each text: numbers and values."""
    for text in texts:
        found = W.Words([text], W.NOT_SPACE, lower=False)
        at, value = [], []
        for kind, hashes, first, last in grams(found):
            own = _bucket(hashes[first[0]: max(first[0], last[0])])
            where, count = np.unique(own, return_counts=True)
            at.append(where + kind * BUCKETS)
            value.append(count / (len(own) + PRIOR))
        yield np.concatenate(at).astype(np.int32), np.concatenate(value).astype(np.float32)


#: Entries of sparse rows that one product takes at a time.
AT_ONCE = 1 << 18


class Rows:
    """Sparse rows for fitting: the number of entries of each row, and all entries
    in a row. Products go over them in parts, so they need little beside them."""

    def __init__(self, sizes: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.sizes, self.at, self.value, self.n = sizes, at, value, len(sizes)
        self.ends = np.cumsum(sizes)

    def take(self, which: np.ndarray) -> Rows:
        entries = np.repeat(which, self.sizes)
        return Rows(self.sizes[which], self.at[entries], self.value[entries])

    def _parts(self):
        for a in range(0, len(self.at), AT_ONCE):
            b = min(a + AT_ONCE, len(self.at))
            row = np.searchsorted(self.ends, np.arange(a, b), side="right")
            yield row, self.at[a:b], self.value[a:b]

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for row, at, value in self._parts():
            out += np.bincount(row, value * weights[at], self.n)
        return out

    def back(self, errors: np.ndarray) -> np.ndarray:
        out = np.zeros(KINDS * BUCKETS)
        for row, at, value in self._parts():
            out += np.bincount(at, value * errors[row], len(out))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(
    data: Rows, target: np.ndarray, steps: int = 60, rate: float = 0.3, decay: float = 1e-5
) -> np.ndarray:
    """Weights; ``target`` may be a probability. Both classes weigh alike.
    Without any row the weights are zero."""
    weights = np.zeros(KINDS * BUCKETS)
    if not data.n:
        return weights
    up = max(target.sum(), 1e-9)
    down = max((1 - target).sum(), 1e-9)
    each = target / up + (1 - target) / down
    each /= each.sum()
    m, v = np.zeros(KINDS * BUCKETS), np.zeros(KINDS * BUCKETS)
    for step in range(1, steps + 1):
        g = data.back((sigmoid(data.dot(weights)) - target) * each) + decay * weights
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return weights


def calibrate(scores: np.ndarray, target: np.ndarray, moved: bool = True) -> tuple[float, float]:
    """Slope and offset of Platt's sigmoid, with his smoothed targets; the offset
    is 0 unless the sigmoid may be ``moved``."""
    up, down = target.sum(), (1 - target).sum()
    if not up or not down:
        return 1.0, 0.0
    goal = np.where(target > 0.5, (up + 1) / (up + 2), 1 / (down + 2))
    out, inputs = np.array([1.0, 0.0]), np.stack([scores, np.full(len(scores), float(moved))], axis=1)
    for _ in range(50):
        p = sigmoid(inputs @ out)
        curve = (inputs * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ inputs + np.diag([1e-3, 1e-6])
        slope = inputs.T @ (p - goal) + np.array([1e-3 * (out[0] - 1), 0.0])
        out = out - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return (float(out[0]), float(out[1])) if out[0] > 0 else (1.0, 0.0)


def prior_shift(target: np.ndarray, good: float, bad: float) -> float:
    """What a log-odds from a sample of other class sizes lacks: ``good`` and
    ``bad`` are the sizes among all rows."""
    up, down = float(target.sum()), float((1 - target).sum())
    if min(good, bad, up, down) <= 0:
        return 0.0
    return float(np.log(good / bad) - np.log(up / down))
