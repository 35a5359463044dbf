"""Stages and classifiers on the test tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from ledgerloom.llm.quality_rules import quality_rules
from ledgerloom.llm.similar import similar_documents
from ledgerloom.llm.weak_quality import op7_quality_classifier

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels", "benchmark")}


def test_stages(spark, tables):
    docs = tables["documents"]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA)
        assert kept.columns == docs.columns
        assert 0 < kept.count() <= docs.count()
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert tokens.count() == docs.count()


def test_one_document_of_each_group_stays(spark, tables):
    docs = tables["documents"]
    groups = {r.doc_id: r.component_id for r in similar_documents(docs).collect()}
    kept = {r.doc_id for r in corpus_pipeline.similar(spark, docs, DATA).select("doc_id").collect()}
    assert kept == set(groups.values())


def test_held_out_accuracy(tables):
    labels = tables["labels"]
    rules = quality_rules(tables["documents"], labels).join(labels, "doc_id")
    right = rules.filter("kept = (quality = 1) OR base_failed").count()
    assert right >= 0.95 * rules.count()
    weak = op7_quality_classifier(tables["documents"]).join(labels, "doc_id")
    assert weak.filter("quality = 1 AND rejected").count() <= 0.06 * weak.filter("quality = 1").count()
    assert weak.filter("quality = 0 AND rejected").count() >= 0.7 * weak.filter("quality = 0").count()
