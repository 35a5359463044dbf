"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Used inside Arrow batches: a batch is cut into slices of a few megabytes, each
slice is one byte array with a line feed after every text, and words, their
hashes and windows of words are found for the whole slice without a loop over
words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 1 << 20

#: Word bytes: all but space, tab and the line breaks 0A-0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Word bytes: ASCII digits and lower-case letters, and every byte of a
#: character beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < size:
        full = np.full(max(size, SLICE_BYTES + (1 << 16)), base, np.uint64)
        full[0] = 1
        have = _powers[name] = np.multiply.accumulate(full)
    return have[:size]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers under which close values part."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Sums:
    """Hashes of any substring of a byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = _power("inverse", _BASE_INV, n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, n), out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.inverse[starts]
        return mixed(h + (ends - starts).astype(np.uint64) * _STEP)


def slices(texts: list[bytes | None], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``most`` bytes, or one longer text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += n + 1
    if first < len(texts):
        yield first, len(texts)


class Words:
    """The words of some texts: where they are, and a hash of each."""

    def __init__(self, texts: list[bytes | None], members: np.ndarray, lower: bool):
        self.texts = texts
        data = np.frombuffer(b"\n".join([t or b"" for t in texts]) + b"\n", np.uint8)
        self.data = LOWER[data] if lower else data
        sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        self.begin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=self.begin[1:])
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = members[self.data]
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.bounds = np.searchsorted(self.starts, self.begin)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.sums = Sums(self.data)
        self.hashes = self.sums.of(self.starts, self.ends)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each word on, and whether all of them
        are in one text."""
        return windows(self.hashes, self.doc, size)


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += hashes[k:k + n]
    return mixed(out), doc[:n] == doc[size - 1:]


def least_in_window(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbouring values, by doubling."""
    if size > len(values):
        return values[:0]
    out, have = values, 1
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def covered(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``size`` from ``starts``."""
    step = np.zeros(length + size + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step)[:length] > 0


def texts_of(column) -> list[bytes | None]:
    """An Arrow text column as UTF-8 bytes."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def lists(values: np.ndarray, counts: np.ndarray):
    """An Arrow list column: ``counts[i]`` of the values for row i."""
    import pyarrow as pa

    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
