"""From documents to token ids: five stages, each with its operator's decision.

Every stage reads what its predecessor kept, written as Parquet in between. All
but the last return the columns they were given, whatever their names beside
doc_id, text and n_chars. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import encoded_and_decoded
from ledgerloom.llm.decontaminate import contamination
from ledgerloom.llm.line_dedup import deduplicated
from ledgerloom.llm.similar import similar_documents
from ledgerloom.llm.weak_quality import accepted
from ledgerloom.llm.work import Work


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier does not reject. A text that is
    NULL or has no word is rejected."""
    return accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines. A document of which
    nothing but white space is left is a copy and goes."""
    left = deduplicated(docs).filter((F.col("_n_deleted") == 0) | F.col("_kept").rlike(r"[^ \t\n\x0B\f\r]"))
    new = {"text": F.col("_kept"), "n_chars": F.when(F.col("_n_deleted") > 0, F.length("_kept").cast("long")).otherwise(F.col("n_chars"))}
    return left.select(*(new[c].alias(c) if c in new else c for c in docs.columns))


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the least id. Rows that
    share this id stay together; rows without an id stay."""
    others = similar_documents(docs, count_links=False).filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window. Documents that share an
    id, or have none, go together."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    return encoded_and_decoded(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", similar),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding and decoding", tokens),
]

#: The stages' models and tokenizer are beyond SQL. tests/llm/test_stages.py
#: compares each stage, and all in a row, with plain Python versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
