"""Clause dedup against a walk over all clauses."""

import hashlib
import random
import re
from pathlib import Path

import duckdb
import pytest

from ledgerloom.llm import unit_dedup as T
from llm_frames import docs  # noqa: F401

UNIT = re.compile(rb"[^\n]*?(?:[.,;:!?][ \t\n\x0B\f\r]|\n)[ \t\n\x0B\f\r]*|[^\n]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(unit):
    return tuple(re.findall(rb"[^ \t\n\x0B\f\r]+", unit.translate(LOWER)))


def brute(rows, least=T.RUN_WORDS):
    first, cut = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        cut[doc] = [m.span() for m in UNIT.finditer((text or "").encode())]
        for a, b in cut[doc]:
            first.setdefault(words(text.encode()[a:b]), (doc, a))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        later = [first[words(data[a:b])] != (doc, a) and bool(words(data[a:b])) for a, b in cut[doc]]
        gone, run = set(), []
        for k in range(len(later) + 1):
            if k < len(later) and later[k]:
                run.append(k)
                continue
            if sum(len(words(data[slice(*cut[doc][j])])) for j in run) >= least:
                gone.update(run)
            run = []
        spans = []
        for k, (a, b) in enumerate(cut[doc]):
            if k not in gone:
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
        kept = b"".join(data[a:b] for a, b in spans)
        out.append((doc, len(gone), hashlib.sha256(kept).hexdigest(), ",".join(f"{a}-{b}" for a, b in spans)))
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in T.op8_substring_dedup(frame).collect())


def made(rng, n):
    marks = ["", "", "", "", ",", ".", ". ", ";", "!\t", ":\n", "\n\n", "\x0b"]
    return "".join(rng.choice(["ab", "Ü1", "x.y", "c"]) + str(rng.randrange(10**6)) + rng.choice(marks) + " " for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_walk(docs, seed):
    rng = random.Random(seed)
    passages = [made(rng, n) for n in (30, 45, 60, 200)]
    rows = []
    for i in range(60):
        parts = [made(rng, rng.randrange(0, 40)) for _ in range(3)] + rng.choices(passages, k=rng.randrange(3))
        rng.shuffle(parts)
        rows.append((i, rng.choice(["", " ", "\n ", " \n"]) + "".join(parts)))
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "one"), (104, ". . ."), (105, rows[5][1])]
    rng.shuffle(rows)
    assert got(docs(rows).repartition(3)) == brute(rows)


def test_passage_goes_and_clauses_stay(docs):
    rng = random.Random(9)
    passage = ", ".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(6)) for _ in range(9)) + ". "
    clause = "all rights are reserved by the owner. "
    rows = [(i, f"begin {i}. {clause}{passage}end {i}") for i in range(5)]
    kept = {r.doc_id: r.kept for r in T.unit_deduplicated(docs(rows)).collect()}
    assert kept[0] == rows[0][1]
    assert kept[3] == "begin 3. end 3"
    alone = [(i, f"begin {i}. {clause}end {i}") for i in range(5)]
    assert all(r.n_removed == 0 for r in T.unit_deduplicated(docs(alone)).collect())
    inside = [(1, f"{passage}middle. {passage}")]
    assert [r.kept for r in T.unit_deduplicated(docs(inside)).collect()] == [f"{passage}middle. "]


@pytest.mark.parametrize("together", [T.TOGETHER, 5])
def test_many_copies_and_missing_ids(docs, together):
    """Copies of one passage own all rows; some share an id or have none."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i % 200, text) for i in range(600)] + [(None, text + "."), (None, text + "!")]
    counts = {}
    for r in T.unit_deduplicated(docs(rows), together=together).collect():
        counts.setdefault((r.doc_id, r.n_removed), 0)
        counts[r.doc_id, r.n_removed] += 1
    assert counts[(0, 0)] == 3 and counts[(199, 1)] == 3 and counts[(None, 0)] == 2


def test_spans_lie_in_the_original(docs):
    rng = random.Random(4)
    shared = made(rng, 120)
    rows = [(i, made(rng, 20) + shared + made(rng, 20)) for i in range(6)]
    texts = dict(rows)
    for r in T.unit_deduplicated(docs(rows)).collect():
        assert b"".join(texts[r.doc_id].encode()[a:b] for a, b in r.kept_spans).decode() == r.kept


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_sql_twin(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    rows = con.sql("SELECT doc_id, text FROM documents").fetchall()
    assert sorted(con.sql(T.OP8_SQL).fetchall()) == brute(rows) == got(spark.read.parquet(path))
