"""The toxicity grammar, and its recall and precision on held-out rows."""

from pathlib import Path

import pytest

from ledgerloom.llm import toxicity as T


def score(*texts):
    evidence, clauses, _ = T.Scorer({b"idio": 4.0}).evidence([t.encode() for t in texts])
    return list(evidence), list(clauses)


def test_targets_on_both_sides():
    (before, after, far, none), _ = score("you are an idiot", "idiot that you are", "idiot a b c d e you", "an idiot")
    assert before == after > far == none


def test_threats_need_a_target():
    (aimed, turned, alone, other), clauses = score("they will kill you", "you we kill", "kill the lights", "you. kill the lights")
    assert aimed > 0 and turned > 0 and alone == other == 0
    assert clauses == [1, 1, 0, 0]


def test_negated_and_reported():
    (plain, negated, reported), _ = score("an idiot", "never an idiot", "she wrote idiot")
    assert plain > negated > 0 and plain > reported > 0


def test_composed_machine_is_its_parts_in_a_row():
    aimed = T.targets()
    negated = T._fading(T.NEGATION, T._CHARGED, T.NEGATED, 0.4, 3)
    both = T.compose(aimed, negated)
    import itertools

    for symbols in itertools.product(range(6), repeat=4):
        a = b = c = 0
        for symbol in symbols:
            a, middle, wa = aimed.step(a, symbol)
            b, out, wb = negated.step(b, middle)
            c, got, w = both.step(c, symbol)
            assert (got, w) == (out, wa * wb)


DATA = "/root/testdata/sf0.1"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_held_out_recall_and_precision(spark):
    documents, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    held = T.op6_toxicity(documents, labels).filter("held_out").join(labels, "doc_id").filter("toxic IS NOT NULL")
    counts = {(r.toxic, r.predicted): r["count"] for r in held.groupBy("toxic", "predicted").count().collect()}
    found, missed, wrong = counts.get((1, 1), 0), counts.get((1, 0), 0), counts.get((0, 1), 0)
    assert found >= 0.9 * (found + missed)
    assert found >= 0.9 * (found + wrong)
