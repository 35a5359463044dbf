"""Quality classifier without labels: heuristics, their accuracies, a scorer.

Heuristic labellers vote good (1), bad (0) or nothing (-1) on each text. Votes
of all documents are counted by pattern: at most 3 ** (number of labellers)
rows, which is a fixed bound. Expectation-maximisation on the counted patterns
estimates for each labeller how often it votes what, given the true class, and
the posterior of each pattern. The posteriors are the targets of a linear
scorer on hashed word and character n-grams, fitted on documents chosen by the
hash of their id: about ``sample`` of those that lean to each class. All
documents are scored by that scorer in Arrow batches; rejected are those whose
calibrated probability of good quality is below ``KEEP_AT``.

Defined cases: NULL is an empty text; on a text without words only the length
labeller votes, against it, and it is rejected; without any document nothing is
fitted; rows are judged one by one; other columns are not read by the scorer and
are returned unchanged by ``accepted``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import hashed
from ledgerloom.llm import words as W
from ledgerloom.llm.quality_rules import by_hash, fitted_scorer
from ledgerloom.llm.textstats import stats
from ledgerloom.llm.work import Work

SAMPLE = 800
KEEP_AT = 0.3
ROUNDS = 100

LABELLERS = ("symbols", "repetition", "shouting", "separators", "short words", "length", "sentences")


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _vote(value: np.ndarray, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, 0, np.where(good, 1, -1)).astype(np.int8)


def votes(own: dict[str, np.ndarray]) -> np.ndarray:
    """One row of votes per text, in the order of ``LABELLERS``."""
    n = own["n_words"]
    any_words = n > 0
    symbols = _ratio(own["n_symbols"], own["word_chars"])
    repeats = _ratio(own["n_repeat_words"], n)
    upper = _ratio(own["upper"], own["upper"] + own["lower"])
    lone = _ratio(own["n_lone_symbols"], n)
    short = _ratio(own["n_short_words"], n)
    ended = _ratio(own["n_ended_lines"], own["n_lines"])
    out = np.stack(
        [
            _vote(symbols, symbols > 0.08, symbols < 0.01),
            _vote(repeats, repeats > 0.3, repeats < 0.05),
            _vote(upper, upper > 0.4, upper < 0.15),
            _vote(lone, lone > 0.1, lone < 0.01),
            _vote(short, short < 0.12, short > 0.25),
            _vote(n, n < 1, n >= 12),
            _vote(ended, ended < 0.3, ended > 0.7),
        ],
        axis=1,
    )
    out[~any_words] = -1
    out[~any_words, LABELLERS.index("length")] = 0
    return out


def code_of(rows: np.ndarray) -> np.ndarray:
    """A pattern of votes as one number."""
    return ((rows.astype(np.int64) + 1) * 3 ** np.arange(rows.shape[1])).sum(axis=1)


def pattern_of(codes: np.ndarray, labellers: int = len(LABELLERS)) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(labellers)) % 3 - 1


class Accuracies:
    """What EM has learned: the share of good texts, and for each labeller and
    class the probability of each vote (-1, 0, 1)."""

    def __init__(self, good: float, given: np.ndarray):
        self.good, self.given = good, given

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        rows = pattern_of(codes, self.given.shape[0]) + 1
        logs = np.log(self.given)
        ll = np.stack([sum(logs[k, c, rows[:, k]] for k in range(rows.shape[1])) for c in (0, 1)])
        return hashed.sigmoid(ll[1] + np.log(self.good) - ll[0] - np.log(1 - self.good))


def learn_accuracies(codes: np.ndarray, counts: np.ndarray, labellers: int = len(LABELLERS)) -> Accuracies:
    """EM from the majority of votes; smoothed by one pseudo-count a vote."""
    rows = pattern_of(codes, labellers)
    up, down = (rows == 1).sum(axis=1), (rows == 0).sum(axis=1)
    # A vote against quality is rarer and weighs more at the start.
    post = hashed.sigmoid(up - 3.0 * down)
    model = Accuracies(0.5, np.full((labellers, 2, 3), 1 / 3))
    for _ in range(ROUNDS):
        weight = np.stack([counts * (1 - post), counts * post])
        given = np.ones((labellers, 2, 3))
        for vote in (-1, 0, 1):
            given[:, :, vote + 1] += ((rows == vote).T[:, None, :] * weight[None]).sum(axis=2)
        given /= given.sum(axis=2, keepdims=True)
        total = weight.sum(axis=1) + 1
        model = Accuracies(float(np.clip(total[1] / total.sum(), 1e-3, 1 - 1e-3)), given)
        new = model.posterior(codes)
        if np.abs(new - post).max(initial=0) < 1e-6:
            break
        post = new
    return model


def _vote_rows(batches):
    for batch in batches:
        texts = W.texts_of(batch.column("text"))
        for a, b in W.slices(texts):
            _, own = stats(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), pa.array(code_of(votes(own)))], ["doc_id", "votes"]
            )


def _scores(model):
    def run(batches):
        weights, slope, offset = model.value
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                found = W.Words(texts[a:b], W.NOT_SPACE, lower=False)
                good = hashed.sigmoid(slope * hashed.logits(found, weights) + offset)
                good[found.counts == 0] = 0.0
                rest = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(good)], [*batch.schema.names, "_p_good"])

    return run


def learned(documents: DataFrame, sample: int = SAMPLE) -> tuple[tuple, Accuracies]:
    """The scorer's parameters, and the accuracies behind its targets."""
    docs = documents.select("doc_id", "text")
    voted = Work(docs.sparkSession, "weak_quality").keep(
        docs.mapInArrow(_vote_rows, "doc_id long, votes long"), "votes"
    )
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").toArrow()
    codes, counts = patterns.column("votes").to_numpy(), patterns.column("n").to_numpy().astype(np.float64)
    accuracies = learn_accuracies(codes, counts)
    post = accuracies.posterior(codes)
    target = F.create_map(*[F.lit(x) for c, p in zip(codes, post, strict=True) for x in (int(c), float(p))])
    judged = voted.filter("doc_id IS NOT NULL").select("doc_id", target[F.col("votes")].alias("label")) if len(codes) else (
        voted.select("doc_id", F.lit(0.5).alias("label"))
    )
    sides = ((F.col("label") < 0.5, post < 0.5), (F.col("label") >= 0.5, post >= 0.5))
    parts = [by_hash(judged.filter(side), int(counts[which].sum()), sample) for side, which in sides]
    chosen = F.broadcast(parts[0].unionByName(parts[1]).groupBy("doc_id").agg(F.avg("label").alias("label")))
    rows = docs.join(chosen, "doc_id").select("doc_id", "text", "label")
    # The sample has both classes alike; all documents have them as EM found.
    return fitted_scorer(rows, accuracies.good, 1 - accuracies.good)[:3], accuracies


def scored(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``documents`` (at least doc_id, text) with the column _p_good."""
    spark = documents.sparkSession
    parameters, _ = learned(documents, sample)
    model = spark.sparkContext.broadcast(parameters)
    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes) + ", _p_good double"
    return documents.mapInArrow(_scores(model), schema)


def accepted(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the classifier does not reject."""
    return scored(documents).filter(F.col("_p_good") >= KEEP_AT).select(*documents.columns)


def op7_quality_classifier(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, p_good, rejected."""
    return scored(documents.select("doc_id", "text")).select(
        "doc_id", F.col("_p_good").alias("p_good"), (F.col("_p_good") < KEEP_AT).alias("rejected")
    )
