"""Line dedup by maximal repeated runs, against brute force."""

import random

import pytest

import corpus_pipeline
from llm_frames import docs  # noqa: F401
from ledgerloom.llm.line_dedup import deduplicated, op2_line_runs


def by_maximal_runs(texts, min_lines, long_line):
    """Every pair of places is extended as far as it goes, and judged as a whole."""
    lines = [[x for x in t.split("\n") if x.split()] for t in texts]
    places = [(d, k) for d, own in enumerate(lines) for k in range(len(own))]
    gone = set()
    for i, (a, j) in enumerate(places):
        for b, k in places[i + 1:]:
            if j and k and lines[a][j - 1] == lines[b][k - 1]:
                continue
            n = 0
            while j + n < len(lines[a]) and k + n < len(lines[b]) and lines[a][j + n] == lines[b][k + n]:
                n += 1
            if n >= min_lines or sum(len(x.split()) for x in lines[b][k:k + n]) >= long_line:
                gone |= {(b, k + m) for m in range(n)}
    return ["\n".join(x for k, x in enumerate(own) if (d, k) not in gone) for d, own in enumerate(lines)], gone


def line(name, n):
    return " ".join([name] * n)


def test_two_lines_of_fifty_words(spark, docs):
    pair, short = [line("a", 30), line("b", 30)], [line("c", 20), line("d", 20)]
    texts = ["\n".join(x) for x in ([*pair, "first"], [*short, "second"], ["third", *pair], ["fourth", *short], pair)]
    got = {r.doc_id: r.n_deleted for r in op2_line_runs(docs(list(enumerate(texts)))).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 0, 4: 2}
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs(list(enumerate(texts))), "").collect()}
    assert kept[2] == "third" and 4 not in kept


@pytest.mark.parametrize("min_lines", [2, 3, 5])
def test_maximal_runs(docs, min_lines):
    rng = random.Random(min_lines)
    pool = [line(c, rng.randint(1, 9)) for c in "abcdefghijklmnop"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(14)]
    want, gone = by_maximal_runs(texts, min_lines, 12)
    got = {r.doc_id: r for r in deduplicated(docs(list(enumerate(texts))), min_lines, 12).collect()}
    assert [got[i]._kept for i in range(len(texts))] == want
    assert sum(r._n_deleted for r in got.values()) == len(gone) > 0
