"""Quality rules: fixed counts, and a calibrated classifier for the rest.

The classifier is a logistic regression on hashed word and character n-grams,
fitted on labelled quality rows: of each label about ``sample`` rows, chosen by
the hash of their ids (all, if there are fewer). The labels are sampled before
they meet the texts, so the join has a side of about ``2 * sample`` small rows. A fifth
of the sample is kept out of the fit and calibrates the probability. All
documents are scored in Arrow batches. A document is kept unless a base rule
fails or its probability of good quality is below ``KEEP_AT``.

Defined cases: a NULL or empty text has no words and fails the base rules;
without labelled rows every probability is one half and only the rules decide;
labels that are NULL or of unknown documents are left out, of a document with
several labels each counts, of several texts with one id the least is learned
from; rows are judged one by one; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import hashed
from ledgerloom.llm import words as W
from ledgerloom.llm.textstats import stats
from ledgerloom.llm.work import ship_code

SAMPLE = 800
KEEP_AT = 0.3
LEAST_WORDS, MOST_REPEATED = 10, 20


_SPAN = 1 << 30


def by_hash(rows: DataFrame, count: int, sample: int) -> DataFrame:
    """About ``sample`` of ``count`` rows, chosen by the hash of their doc_id; all
    of them if there are no more. Every task decides for itself."""
    if count <= sample:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_SPAN)) < int(_SPAN * (sample / count)))


def sampled_labels(labels: DataFrame, label: str, sample: int) -> DataFrame:
    """About ``sample`` rows of each label at most: doc_id, label."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL").distinct()
    sizes = known.select([F.count_if(F.col("label") == v) for v in (0, 1)]).first()
    parts = [by_hash(known.filter(F.col("label") == v), sizes[v], sample) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def _featured(batches):
    for batch in batches:
        rows = list(hashed.vectors(W.texts_of(batch.column("text"))))
        sizes = np.array([len(a) for a, _ in rows], np.int64)
        at = np.concatenate([a for a, _ in rows]) if rows else np.zeros(0, np.int32)
        value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0, np.float32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label").cast(pa.float64()), W.lists(at, sizes), W.lists(value, sizes)],
            ["doc_id", "label", "at", "value"],
        )


FEATURES = "doc_id long, label double, at array<int>, value array<float>"
FEATURES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("label", pa.float64()), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))]
)


def _fit(good: float, bad: float):
    """One task: weights of four fifths of the rows, calibration by the rest."""

    def run(batches):
        table = pa.Table.from_batches(list(batches), FEATURES_ARROW).combine_chunks()

        def entries(name: str) -> np.ndarray:
            column = table.column(name)
            return column.combine_chunks().flatten().to_numpy() if len(table) else np.zeros(0, np.float32)

        sizes = pa.compute.list_value_length(table.column("at")).to_numpy().astype(np.int64)
        rows = hashed.Rows(sizes, entries("at").astype(np.int32, copy=False), entries("value"))
        target = table.column("label").to_numpy()
        held = np.arange(rows.n) % 5 == 4
        weights = hashed.fit(rows.take(~held), target[~held])
        slope, offset = hashed.calibrate(rows.take(held).dot(weights), (target[held] > 0.5).astype(float), moved=False)
        # The sample has other class sizes than all rows.
        offset += hashed.prior_shift(target, good, bad)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([slope]), pa.array([offset]), pa.array([rows.n])],
            ["weights", "slope", "offset", "n"],
        )

    return run


def fitted_scorer(rows: DataFrame, good: float, bad: float) -> tuple[np.ndarray, float, float, int]:
    """Weights, slope and offset learned from a bounded sample (doc_id, text,
    label), and its number of rows; ``good`` and ``bad`` are the class sizes of all.

    Of rows with the same id and label the least text counts, so the bound is one
    of rows, however many share an id. The sample, some thousand rows at most, is
    fitted in one task; the driver gets the weights only.
    """
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
    one = rows.mapInArrow(_featured, FEATURES).repartition(1).sortWithinPartitions("doc_id", "label")
    found = one.mapInArrow(_fit(float(good), float(bad)), "weights binary, slope double, offset double, n long").first()
    if found is None:
        return np.zeros(hashed.KINDS * hashed.BUCKETS), 1.0, 0.0, 0
    return np.frombuffer(found["weights"], np.float64), found["slope"], found["offset"], found["n"]


def fitted(documents: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, float, float]:
    """Weights, and slope and offset of the calibration."""
    chosen = F.broadcast(sampled_labels(labels, "quality", sample))
    sizes = labels.select([F.count_if(F.col("quality") == v) for v in (1, 0)]).first()
    return fitted_scorer(documents.join(chosen, "doc_id").select("doc_id", "text", "label"), *sizes)[:3]


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(model):
    def run(batches):
        weights, slope, offset = model.value
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                found, own = stats(texts[a:b])
                good = hashed.sigmoid(slope * hashed.logits(found, weights) + offset)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(own[c]) for c in COLUMNS), pa.array(good)],
                    ["doc_id", *COLUMNS, "p_good"],
                )

    return run


def quality_rules(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document the counts, base_failed, p_good and kept."""
    spark = documents.sparkSession
    ship_code(spark)
    docs = documents.select("doc_id", "text")
    model = spark.sparkContext.broadcast(fitted(docs, labels, sample))
    counted = docs.mapInArrow(
        _judge(model), "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS) + ", p_good double"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select(
        "doc_id",
        *COLUMNS,
        failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= KEEP_AT)).alias("kept"),
        "p_good",
    )


def op9_quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_rules(documents, labels)
