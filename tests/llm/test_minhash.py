"""Circulant MinHash against all pairs."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import minhash as T
from ledgerloom.llm import words as W
from ledgerloom.llm.similar import sets_of
from llm_frames import docs  # noqa: F401


def brute(rows):
    """(doc_id, set size, component, kept) from all pairs that share a shingle."""
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    spaces = bytes([0x20, *range(0x09, 0x0E)])
    ids, owners, sets = [i for i, _ in rows], {}, {}
    for i, text in rows:
        cut = (text or "").encode().translate(lower).translate(bytes(0x20 if c in spaces else c for c in range(256)))
        words = [w for w in cut.split(b" ") if w]
        sets[i] = {tuple(words[k:k + 2]) for k in range(len(words) - 1)} if len(words) > 1 else {tuple(words)} - {()}
        for shingle in sets[i]:
            owners.setdefault(shingle, []).append(i)
    least = {i: i for i in ids}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in ids:
        common = {}
        for shingle in sets[i]:
            for j in owners[shingle]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, both in common.items():
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                least[b] = a
    return sorted((i, len(sets[i]), top(i), top(i) == i) for i in ids)


def got(frame):
    return sorted(tuple(r) for r in T.op11_minhash(frame).collect())


def test_chains_and_thresholds(docs):
    """Chains of texts of which only neighbours are linked, and texts at and just
    below the threshold."""
    rng = random.Random(5)
    rows, at = [], 0
    for _ in range(30):
        words = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        for _ in range(6):
            rows.append((at, " ".join(words)))
            at += 1
            for _ in range(rng.choice([1, 2, 3])):
                words[rng.randrange(40)] = f"W{rng.randrange(10**6)}"
    rng.shuffle(rows)
    expected = brute(rows)
    assert got(docs(rows)) == expected
    assert len({c for _, _, c, _ in expected}) < len(rows)


def test_one_bucket_of_many(docs, monkeypatch):
    """A crowd that shares buckets without being linked, and one that is."""
    monkeypatch.setattr(T, "GROUP_TOKENS", 200)
    shared = " ".join(f"c{i}" for i in range(30))
    rng = random.Random(6)
    rows = [(i, shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(12))) for i in range(120)]
    rows += [(500 + i, shared + f" v{i}") for i in range(60)]
    assert got(docs(rows)) == brute(rows)


def test_signature_is_two_permutations_one_shifted():
    sets = sets_of([b"a b c d e f", b"", b"x y"], 2)
    found = T.signatures(sets, 8)
    table = np.random.default_rng(T.SEED).permutation(T.CIRCLE)
    for own, row in zip(sets, found, strict=True):
        for k in range(8):
            least = min((int(table[(s + k) % T.CIRCLE]) for s in T._slots(own)), default=2**32 - 1)
            assert row[k] == least


def test_long_sets_are_looked_up_in_parts(monkeypatch):
    text = " ".join(f"w{i}" for i in range(5_000)).encode()
    whole = T.signatures(sets_of([text, b"one two", text], 2))
    monkeypatch.setattr(T, "LOOKUP", 100)
    assert (T.signatures(sets_of([text, b"one two", text], 2)) == whole).all()


def test_coordinates_agree_as_often_as_sets_do():
    rng = np.random.default_rng(8)
    sets = []
    for _ in range(200):
        both = rng.integers(-(2**62), 2**62, 80)
        sets += [np.sort(np.concatenate([both, rng.integers(-(2**62), 2**62, 10)])) for _ in range(2)]
    found = T.signatures(sets)
    assert abs((found[::2] == found[1::2]).mean() - 0.8) < 0.01
    keys = T.band_keys(found)
    assert ((keys[::2] == keys[1::2]).any(axis=1)).all()
    assert len(np.unique(W.mixed(keys[0].view(np.uint64)))) == T.BANDS


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    assert got(table) == brute(rows)


def test_signatures_of_many_shingles_take_little():
    """Sets of more shingles than are looked up at once, beside small and empty ones."""
    rng = np.random.default_rng(7)
    sizes = [0, 1, 700, T.LOOKUP, T.LOOKUP + 1, 40_000, 0]
    sets = [np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, n)) for n in sizes]
    T.signatures(sets[:2])
    tracemalloc.start()
    found = T.signatures(sets)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 << 20
    windows = T._circle(T.BANDS * T.WIDTH)
    for own, row in zip(sets, found, strict=True):
        if len(own):
            assert (row == np.min([windows[s] for s in T._slots(own)], axis=0)).all()
        else:
            assert (row == np.iinfo(np.uint32).max).all()
