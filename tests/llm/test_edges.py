"""Every operator on NULLs, empty and long texts, ties, repeated rows, empty
tables, and columns with clashing names."""

import pytest

from llm_frames import clashing, docs  # noqa: F401
from ledgerloom.llm import catalog
from ledgerloom.llm.bpe import op10_bpe
from ledgerloom.llm.decontaminate import op5_decontaminate
from ledgerloom.llm.line_dedup import op2_line_dedup, op2_line_runs
from ledgerloom.llm.minhash import op11_minhash
from ledgerloom.llm.quality_rules import op9_quality_rules
from ledgerloom.llm.sharding import op4_sharding
from ledgerloom.llm.similar import op3_similar
from ledgerloom.llm.suffix_dedup import op1_suffix_dedup
from ledgerloom.llm.toxicity import op6_toxicity
from ledgerloom.llm.unit_dedup import op8_substring_dedup
from ledgerloom.llm.weak_quality import op7_quality_classifier

BENCH = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
OPERATORS = {
    "op1": op1_suffix_dedup,
    "op2": op2_line_dedup,
    "op2_runs": op2_line_runs,
    "op3": op3_similar,
    "op4": op4_sharding,
    "op5": lambda d: op5_decontaminate(d, d.sparkSession.createDataFrame([(1, "one"), (2, None), (None, "")], BENCH)),
    "op6": lambda d: op6_toxicity(d, d.sparkSession.createDataFrame([(4, 1, 0), (6, None, 1), (99, 0, 1), (None, 1, 1)], LABELS)),
    "op7": op7_quality_classifier,
    "op8": op8_substring_dedup,
    "op9": lambda d: op9_quality_rules(d, d.sparkSession.createDataFrame([(4, 1, 0), (6, 0, 1), (99, 0, 1), (None, 1, 1)], LABELS)),
    "op10": op10_bpe,
    "op11": op11_minhash,
}


def edge_rows():
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (5, "one"), (6, long), (7, "x" * 30_000), (None, "no id here")]


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(docs, clashing, name):
    given = edge_rows()
    got = OPERATORS[name](clashing(docs(given)))
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(i) for i, _ in given)
    plain = OPERATORS[name](docs(given))
    assert plain.columns == got.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs([])).collect() == []


def test_defined_results(docs):
    given = docs(edge_rows())
    near = {(r.doc_id, r.n_shingles, r.component_id) for r in op3_similar(given).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 1, None)} <= near
    pairs = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op11_minhash(given).collect()}
    assert {(1, 0, 1, True), (4, 1, 4, True), (5, 1, 4, False), (7, 1, 7, True), (None, 2, None, True)} <= pairs
    hit = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in OPERATORS["op5"](given).collect()}
    assert hit[4] == (1, 1, True) and hit[1] == (0, 0, False) and hit[7] == (1, 0, False)
    cut = {r.doc_id: (r.n_bytes, r.n_removed) for r in op1_suffix_dedup(given).collect()}
    assert cut[7] == (30_000, 30_000) and cut[1] == (0, 0) and cut[6][1] == 0
    assert {r.doc_id for r in op9_rejected(given)} >= {1, 2, 3, 4, 5}
    assert {r.doc_id for r in op7_quality_classifier(given).filter("rejected").collect()} >= {1, 2, 3}


def op9_rejected(given):
    return OPERATORS["op9"](given).filter("NOT kept").collect()


def test_registered():
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    import ledgerloom

    top = Path(ledgerloom.__file__).parent
    for path in top.rglob("*.py"):
        if "llm" not in path.relative_to(top).parts:
            assert "ledgerloom.llm" not in path.read_text(), path
