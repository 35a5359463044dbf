"""Operators against brute force on small random texts."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_frames import docs  # noqa: F401
from ledgerloom.llm.decontaminate import contamination
from ledgerloom.llm.sharding import sharded
from ledgerloom.llm.similar import similar_documents
from ledgerloom.llm.suffix_dedup import repeated_bytes
from ledgerloom.llm.suffixes import deep_shallow
from ledgerloom.llm.textstats import stats

LOWER = {i: i + 32 for i in range(65, 91)}


def prose(rng, words, most):
    return " ".join(rng.choice(words) for _ in range(rng.randint(0, most)))


@given(st.lists(st.tuples(st.binary(max_size=3), st.integers(0, 70), st.binary(max_size=5)), max_size=40))
@settings(deadline=None, max_examples=60)
def test_deep_shallow_sorting(parts):
    strings = [a * n + b for a, n, b in parts]
    order, shared = deep_shallow(strings)
    assert [strings[i] for i in order] == sorted(strings)
    for a, b, n in zip(order, order[1:], shared[1:], strict=False):
        x, y = strings[a], strings[b]
        assert x[:n] == y[:n] and (n == min(len(x), len(y)) or x[n] != y[n])


@pytest.mark.parametrize("crowd", [3, 2_000])
def test_repeated_bytes(docs, crowd):
    rng = random.Random(crowd)
    texts = [prose(rng, ["alpha", "beta", "gam", "dé", "epsil", "z"], 25) for _ in range(60)]
    texts += ["a" * 90, "xyz " * 30, "xyz " * 30, "q" * 19]
    seen: dict[bytes, int] = {}
    data = [t.encode() for t in texts]
    for t in data:
        for p in range(len(t) - 19):
            seen[t[p: p + 20]] = seen.get(t[p: p + 20], 0) + 1
    want = []
    for i, t in enumerate(data):
        gone = bytearray(len(t))
        for p in range(len(t) - 19):
            if seen[t[p: p + 20]] > 1:
                gone[p: p + 20] = b"\1" * 20
        kept = bytes(c for c, x in zip(t, gone, strict=True) if not x)
        spans = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        want.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = repeated_bytes(docs(list(enumerate(texts))), 20, 5, crowd)
    assert sorted(tuple(r)[:5] for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(2))
def test_components(docs, seed):
    rng = random.Random(seed)
    base = [prose(rng, "abcdefghij", 60) for _ in range(12)]
    texts = []
    for _ in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(["x", "y", "Z"])
        texts.append(" ".join(words))
    sets = []
    for t in texts:
        w = t.translate(LOWER).split()
        sets.append({tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = similar_documents(docs(list(enumerate(texts)))).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [
        (i, len(s), find(i)) for i, s in enumerate(sets)
    ]


def test_contamination(spark, docs):
    rng = random.Random(5)
    items = [(i, prose(rng, "abc", 14)) for i in range(30)] + [(40, "b"), (41, None), (42, "É é")]
    texts = [prose(rng, "abcÉ", 60) for _ in range(80)] + [None, ""]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    want = []
    for i, t in enumerate(texts):
        w, hit, ids = split(t), set(), set()
        for item, text in items:
            theirs = split(text)
            n = min(10, len(theirs))
            for j in range(len(theirs) - n + 1 if n else 0):
                for k in range(len(w) - n + 1):
                    if w[k: k + n] == theirs[j: j + n]:
                        ids.add(str(item))
                        hit.update(range(k, k + n))
        want.append((i, len(w), len(hit), sorted(ids)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs(list(enumerate(texts))), bench).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in got) == want


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab #|\n\té", max_size=60)), max_size=12))
@settings(deadline=None, max_examples=60)
def test_counts(texts):
    _, own = stats([None if t is None else t.encode() for t in texts])
    for i, t in enumerate(texts):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(words[k: k + 5]) for k in range(len(words) - 4)]
        again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
        assert own["n_words"][i] == len(words)
        assert own["word_chars"][i] == sum(map(len, words))
        assert own["n_symbols"][i] == len(re.findall(r"[#*$%&|<>]", t))
        assert own["n_dup_lines"][i] == len(lines) - len(set(lines))
        assert own["n_repeat_words"][i] == len(again)


def test_shards_fit(docs):
    rng = random.Random(1)
    given = [(i, "x" * rng.randint(0, 50)) for i in range(300)] + [(7, "y" * 40)] * 20 + [(8, "z" * 500)]
    got = sharded(docs(given), limit=200).collect()
    assert len(got) == len(given)
    sizes: dict = {}
    for r in got:
        sizes.setdefault((r.depth, r.shard, r.page), []).append(r.n_bytes)
    assert all(sum(s) <= 200 or len(s) == 1 for s in sizes.values())
    # A shard that was split would not have fitted.
    for depth, shard, _page in sizes:
        if depth:
            parent = sum(sum(s) for (d, x, _), s in sizes.items() if d >= depth and x >> (d - depth + 1) == shard >> 1)
            assert parent > 200


def test_weak_labels_recover_accuracies():
    from ledgerloom.llm.weak_quality import code_of, learn_accuracies

    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.7, 0.85])
    votes = np.stack([np.where(rng.random(len(good)) < p, good, ~good) for p in right], axis=1).astype(int)
    codes, counts = np.unique(code_of(votes), return_counts=True)
    model = learn_accuracies(codes, counts.astype(float), 4)
    assert abs(model.good - 0.8) < 0.05
    assert np.abs(model.given[:, 1, 2] - right).max() < 0.05


def test_grammar_changes_what_counts():
    from ledgerloom.llm.toxicity import Scorer

    scorer = Scorer({b"idio": 4.0})
    texts = ["an idiot", "you idiot", "not an idiot", "he said idiot", "nothing", None, "i will kill you. fine"]
    evidence, clauses, _ = scorer.evidence([None if t is None else t.encode() for t in texts])
    plain, aimed, negated, reported, none, null, threat = evidence
    assert aimed > plain > negated > 0 and plain > reported > 0 and none == null == 0 and threat > 0
    assert list(clauses) == [1, 1, 1, 1, 0, 0, 1]
