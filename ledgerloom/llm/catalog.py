"""Registered corpus queries, with an SQL twin where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.bpe import op10_bpe
from ledgerloom.llm.decontaminate import op5_decontaminate
from ledgerloom.llm.line_dedup import OP2_RUNS_SQL, OP2_SQL, op2_line_dedup, op2_line_runs
from ledgerloom.llm.minhash import op11_minhash
from ledgerloom.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from ledgerloom.llm.quality_rules import op9_quality_rules
from ledgerloom.llm.sharding import OP4_SQL, op4_sharding
from ledgerloom.llm.similar import op3_similar
from ledgerloom.llm.suffix_dedup import op1_suffix_dedup
from ledgerloom.llm.toxicity import op6_toxicity
from ledgerloom.llm.unit_dedup import OP8_SQL, op8_substring_dedup
from ledgerloom.llm.weak_quality import op7_quality_classifier
from ledgerloom.llm.whitening import op12_whitening


def _over(operator: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    """The operator applied to whole tables of a data folder."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": _over(op1_suffix_dedup, "documents"),
    "op2_line_dedup": _over(op2_line_dedup, "documents"),
    "op2_line_runs": _over(op2_line_runs, "documents"),
    "op3_ngram_jaccard": _over(op3_similar, "documents"),
    "op4_sharding": _over(op4_sharding, "documents"),
    "op5_decontaminate": _over(op5_decontaminate, "documents", "benchmark"),
    "op6_toxicity": _over(op6_toxicity, "documents", "labels"),
    "op7_quality_classifier": _over(op7_quality_classifier, "documents"),
    "op8_substring_dedup": _over(op8_substring_dedup, "documents"),
    "op9_quality_rules": _over(op9_quality_rules, "documents", "labels"),
    "op10_bpe": _over(op10_bpe, "documents"),
    "op11_minhash": _over(op11_minhash, "documents"),
    "op12_whitening": _over(op12_whitening, "embeddings"),
    "op13_prefix_trie": _over(op13_prefix_trie, "conversations"),
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op2_line_runs": OP2_RUNS_SQL,
    "op4_sharding": OP4_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op13_prefix_trie": OP13_SQL,
}
