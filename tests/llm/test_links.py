"""The number of links of the n-gram Jaccard join, against brute force."""

import random

import pytest

from llm_frames import docs  # noqa: F401
from ledgerloom.llm import similar
from ledgerloom.llm.similar import similar_documents


def shingles(text):
    words = text.lower().split()
    return frozenset(tuple(words[i:i + 2]) for i in range(max(1, len(words) - 1))) if words else frozenset()


def test_links_inside_a_component(docs):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base, *end]) for end in (["a"], ["b"], ["c"], ["c"])] + ["alone here"]
    got = {r.doc_id: r.n_links for r in similar_documents(docs(list(enumerate(texts)))).collect()}
    assert got == {0: 3, 1: 3, 2: 3, 3: 3, 4: 0}


@pytest.mark.parametrize("tokens, rows", [(1 << 20, 2_000), (40, 3)])
def test_number_of_links(docs, monkeypatch, tokens, rows):
    monkeypatch.setattr(similar, "TASK_TOKENS", tokens)
    monkeypatch.setattr(similar, "TASK_ROWS", rows)
    rng = random.Random(5)
    texts = []
    for _ in range(5):
        base = [rng.choice("abcdefghijkl") for _ in range(20)]
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(20)] = rng.choice("mnop")
            texts.append(" ".join(own))
    data = [*enumerate(texts), (3, texts[3]), (4, texts[40]), (200, None), (201, ""), (None, texts[0])]
    entries = {(i, shingles(t)) for i, t in data if i is not None and t}
    want = {i: 0 for i, _ in data}
    for i, a in entries:
        want[i] += sum(100 * len(a & b) >= 80 * len(a | b) for _, b in entries) - 1
    got = {r.doc_id: r.n_links for r in similar_documents(docs(data), 2, 80).collect()}
    assert got == want
    assert max(want.values()) > 5
