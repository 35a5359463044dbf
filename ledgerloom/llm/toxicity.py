"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other.
Three transducers are composed into one machine: the first marks what is aimed
at a target, the second what is negated, the third what is reported. A clause (up
to ``. ! ? ; :`` or a line end) runs through the first one backwards, for targets
that follow, and through the composed machine forwards; every insult or threat
has its weight multiplied by the weights of the arcs it takes. The sum over a
document's matched clauses is its evidence, and a fitted sigmoid of the evidence
its score.

A threat counts only where it is aimed at a target. An insult without a target
keeps its learned weight, no more: of the labelled toxic rows many have no
target near any insult, so a grammar that gave such clauses nothing would miss
what ``labels.toxic`` marks. What is negated or reported is discounted either way.

Insults are stems learned from labelled rows: word beginnings of three bytes or
more that come much more often in rows of label 1, after many different words
(so copies of one row prove nothing) and by far too often for chance. A stem's
weight is the logarithm of how much more often. Of stems that begin with each
other the shorter stays unless the longer weighs clearly more. Threats, targets,
negations and words of reporting are fixed lists. At most ``sample`` rows of each
label are used, chosen by the hash of their ids, and none whose crc32(doc_id as
text) mod 4 is 2.

Defined cases: NULL is an empty text, which matches nothing and gets the score
of no evidence; without labels there are no insults, and threats alone count; a
row without doc_id is not held out; rows are judged one by one; other columns
are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import hashed
from ledgerloom.llm import words as W
from ledgerloom.llm.quality_rules import sampled_labels
from ledgerloom.llm.work import Work, ship_code

SAMPLE = 4_000
PREDICT_AT = 0.3
STEM_BYTES = range(3, 11)
#: A stem must be so many times as frequent in toxic rows, with a likelihood
#: ratio statistic of so much, and add so much to the weight of a shorter one.
LEAST_RATIO, LEAST_PROOF, LEAST_GAIN = 8.0, 40.0, 2.0

THREATS = "kill murder destroy strangle stab shoot beat töten umbringen schlagen tuer tuerai frapper matar mataré golpear"
TARGETS = "you your yours youre u they them he she him her du dich dir euch ihr tu toi vous te ti usted ustedes vosotros"
NEGATIONS = "not never no isnt arent dont nicht kein keine nie pas jamais nunca jamás ningún"
REPORTING = "said says wrote called quoted reported claimed sagte schrieb nannte dit écrit appelé dijo escribió llamó"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
AIMED, NEGATED, REPORTED = 6, 7, 8
_CHARGED = (INSULT, THREAT, AIMED)
#: Words between a target and what is aimed at it, and one.
REACH = 4


class Machine:
    """A transducer on symbols; a missing arc keeps symbol and weight and goes
    to ``rest[state]``."""

    def __init__(self, rest: list[int], arcs: dict[tuple[int, int], tuple[int, int, float]]):
        self.rest, self.arcs = rest, arcs

    def step(self, state: int, symbol: int) -> tuple[int, int, float]:
        return self.arcs.get((state, symbol), (self.rest[state], symbol, 1.0))


def compose(first: Machine, second: Machine, symbols: int = 9) -> Machine:
    """The machine that feeds the output of ``first`` to ``second``."""
    wide = len(second.rest)
    rest, arcs = [], {}
    for a in range(len(first.rest)):
        for b in range(wide):
            rest.append(first.rest[a] * wide + second.rest[b])
            for symbol in range(symbols):
                na, middle, wa = first.step(a, symbol)
                nb, out, wb = second.step(b, middle)
                arcs[a * wide + b, symbol] = (na * wide + nb, out, wa * wb)
    return Machine(rest, arcs)


def _fading(starts: int, hits: tuple[int, ...], out: int, weight: float, reach: int) -> Machine:
    """``starts`` changes the next ``hits`` within ``reach`` symbols."""
    rest = [max(0, s - 1) for s in range(reach + 1)]
    arcs = {(s, starts): (reach, starts, 1.0) for s in range(reach + 1)}
    arcs |= {(s, h): (s - 1, out, weight) for s in range(1, reach + 1) for h in hits}
    return Machine(rest, arcs)


def targets() -> Machine:
    return _fading(TARGET, (INSULT, THREAT), AIMED, 1.5, REACH)


def grammar() -> Machine:
    """Targets, then negation, then reported speech."""
    aimed = targets()
    negated = _fading(NEGATION, _CHARGED, NEGATED, 0.4, 3)
    told = {(0, REPORT): (1, REPORT, 1.0)} | {(1, h): (1, REPORTED, 0.4) for h in _CHARGED}
    return compose(compose(aimed, negated), Machine([0, 1], told))


_ENDS_CLAUSE = np.zeros(256, bool)
_ENDS_CLAUSE[list(b".!?;:\n")] = True
THREAT_WEIGHT = 2.0


def _fixed() -> dict[bytes, int]:
    lists = ((REPORTING, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, THREAT))
    return {w.encode(): symbol for words, symbol in lists for w in words.split()}


class Scorer:
    """Evidence of texts, given the weights of insult stems."""

    def __init__(self, stems: dict[bytes, float]):
        self.machine, self.backward, self.fixed = grammar(), targets(), _fixed()
        threats = [w for w, s in self.fixed.items() if s == THREAT]
        self.threats = np.sort(self._hashes(threats))
        self.stems: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size = defaultdict(list)
        for stem in stems:
            by_size[len(stem)].append(stem)
        for size, own in by_size.items():
            keys = self._hashes(own)
            order = np.argsort(keys)
            self.stems[size] = keys[order], np.array([stems[s] for s in own])[order]

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        return W.Words(words, W.LETTERS, lower=True).hashes

    def matched(self, found: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """For each word, its weight as an insult, and whether it is a threat."""
        weight = np.zeros(len(found.hashes))
        lengths = found.ends - found.starts
        for size, (keys, values) in self.stems.items():
            long = np.flatnonzero(lengths >= size)
            own = found.sums.of(found.starts[long], found.starts[long] + size)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[at] == own
            weight[long[hit]] = np.maximum(weight[long[hit]], values[at[hit]])
        return weight, np.isin(found.hashes, self.threats)

    def evidence(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: evidence, matched clauses, words."""
        found = W.Words(texts, W.LETTERS, lower=True)
        weight, threat = self.matched(found)
        total, clauses = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        hits = np.flatnonzero((weight > 0) | threat)
        if not len(hits):
            return total, clauses, found.counts
        ends = np.flatnonzero(_ENDS_CLAUSE[found.data])
        clause = np.searchsorted(ends, found.starts)
        for own in np.unique(clause[hits]):
            first, last = np.searchsorted(clause, [own, own + 1])
            score = self._clause(found, weight, threat, int(first), int(last))
            if score > 0:
                total[found.doc[first]] += score
                clauses[found.doc[first]] += 1
        return total, clauses, found.counts

    def _clause(self, found: W.Words, weight: np.ndarray, threat: np.ndarray, first: int, last: int) -> float:
        symbols, values = [], []
        for i in range(first, last):
            if weight[i] > 0:
                symbol, value = INSULT, weight[i]
            elif threat[i]:
                symbol, value = THREAT, THREAT_WEIGHT
            else:
                word = found.data[found.starts[i]: found.ends[i]].tobytes()
                symbol, value = self.fixed.get(word, OTHER), 0.0
            symbols.append(symbol), values.append(value)
        state, aimed = 0, [symbol == INSULT for symbol in symbols]
        for i in reversed(range(len(symbols))):
            state, symbols[i], factor = self.backward.step(state, symbols[i])
            values[i] *= factor
            aimed[i] |= symbols[i] == AIMED
        state, score, reach = 0, 0.0, 0
        for symbol, value, counts in zip(symbols, values, aimed, strict=True):
            # A threat with a target before it: within the reach of the machine.
            if counts or reach:
                state, _, factor = self.machine.step(state, symbol)
                score += value * factor
            else:
                state, _, _ = self.machine.step(state, symbol)
            reach = REACH if symbol == TARGET else max(0, reach - 1)
        return float(score)


def beginnings(text: bytes | None) -> Iterator[tuple[bytes, bytes]]:
    """Every word beginning of a text, at character ends, and the word before."""
    found = W.Words([text], W.LETTERS, lower=True)
    data, before = found.data.tobytes(), b""
    for a, b in zip(found.starts.tolist(), found.ends.tolist(), strict=True):
        for size in STEM_BYTES:
            if a + size > b:
                break
            if a + size == b or data[a + size] & 0xC0 != 0x80:
                yield data[a: a + size], before
        before = data[a:b]


def _stem_counts(batches):
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        words = [0, 0]
        for text, label in zip(W.texts_of(batch.column("text")), batch.column("label").to_pylist(), strict=True):
            counts[label].update(stem for stem, _ in beginnings(text))
            words[label] += len(W.Words([text], W.LETTERS, lower=True).hashes)
        # The empty stem stands for all words.
        counts[0][b""], counts[1][b""] = words
        stems = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(stems, pa.binary()), *(pa.array([counts[v][s] for s in stems], pa.int64()) for v in (0, 1))],
            ["stem", "clean", "toxic"],
        )


def _contexts(candidates):
    def run(batches):
        known = candidates.value
        for batch in batches:
            pairs = {p for t in W.texts_of(batch.column("text")) for p in beginnings(t) if p[0] in known}
            stems, before = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(stems, pa.binary()), pa.array(before, pa.binary())], ["stem", "before"]
            )

    return run


def proof(toxic: float, clean: float, share: float) -> float:
    """Likelihood ratio statistic of a stem seen ``toxic`` and ``clean`` times,
    if a word of the sample is in a toxic row with probability ``share``."""
    n = toxic + clean
    parts = ((toxic, share), (clean, 1 - share))
    return 2 * sum(k * np.log(k / (n * p)) for k, p in parts if k and p)


def chosen_stems(counts: dict[bytes, tuple[int, int]], toxic_words: int, clean_words: int) -> dict[bytes, float]:
    """Weights of the stems worth having; ``counts``: (clean, toxic contexts)."""
    share = toxic_words / max(toxic_words + clean_words, 1)
    out: dict[bytes, float] = {}
    for stem in sorted(counts, key=lambda s: (len(s), s)):
        clean, toxic = counts[stem]
        ratio = ((toxic + 0.5) / (toxic_words + 1)) / ((clean + 0.5) / (clean_words + 1))
        if ratio < LEAST_RATIO or proof(toxic, clean, share) < LEAST_PROOF:
            continue
        weight = float(np.log(ratio))
        if all(weight >= out[stem[:n]] + LEAST_GAIN for n in range(1, len(stem)) if stem[:n] in out):
            out[stem] = weight
    return out


def learned(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[bytes, float], np.ndarray]:
    """Stem weights, and the coefficients of the score."""
    spark = documents.sparkSession
    ship_code(spark)
    usable = labels.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2)
    chosen = F.broadcast(sampled_labels(usable, "toxic", sample))
    work = Work(spark, "toxicity")
    # One text for each id and label, however many rows share the id.
    rows = documents.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = work.keep(rows, "rows")

    counted = rows.mapInArrow(_stem_counts, "stem binary, clean long, toxic long")
    summed = work.keep(
        counted.groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "stems"
    )
    words = summed.filter(F.length("stem") == 0).first()
    clean_words, toxic_words = (words["clean"], words["toxic"]) if words else (0, 0)
    # Contexts are no more than occurrences, so what fails here fails later.
    c, t = F.col("clean"), F.col("toxic")
    share = toxic_words / max(toxic_words + clean_words, 1)
    ratio = (t + 0.5) / (toxic_words + 1) / ((c + 0.5) / (clean_words + 1))
    shown = 2 * (t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0))
    likely = (F.length("stem") > 0) & (t > 0) & (ratio >= LEAST_RATIO)
    best = summed.filter(likely).filter(shown >= LEAST_PROOF).collect() if toxic_words and clean_words else []
    top = {bytes(r["stem"]): (r["clean"], r["toxic"]) for r in best}
    shared = spark.sparkContext.broadcast(set(top))
    contexts = (
        rows.filter("label = 1")
        .mapInArrow(_contexts(shared), "stem binary, before binary")
        .groupBy("stem")
        .agg(F.count_distinct("before").alias("n"))
        .collect()
    )
    counts = {bytes(r["stem"]): (top[bytes(r["stem"])][0], r["n"]) for r in contexts}
    weights = chosen_stems(counts, toxic_words, clean_words)
    scorer = spark.sparkContext.broadcast(weights)
    seen = rows.mapInArrow(_evidence(scorer, ("doc_id", "label")), "doc_id long, label int, " + EVIDENCE)
    table = seen.orderBy("doc_id", "evidence").toArrow()
    target = table.column("label").to_numpy().astype(float)
    both = usable.select([F.count_if(F.col("toxic") == v) for v in (1, 0)]).first()
    inputs = inputs_of(table.column("evidence").to_numpy(), table.column("n_words").to_numpy())
    return weights, fitted(inputs, target, *both)


def inputs_of(evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the score is a sigmoid of: a constant, evidence, evidence a word."""
    return np.stack([np.ones(len(evidence)), np.log1p(evidence), 100 * evidence / (words + 20)], axis=1)


def fitted(inputs: np.ndarray, target: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Coefficients by Newton steps, shifted to the class sizes of all labels."""
    out = np.array([-4.0, 2.0, 0.0])
    if target.sum() and (1 - target).sum():
        for _ in range(40):
            p = hashed.sigmoid(inputs @ out)
            w = np.maximum(p * (1 - p), 1e-6)
            curve = (inputs * w[:, None]).T @ inputs + 0.1 * np.eye(3)
            out = out - np.clip(np.linalg.solve(curve, inputs.T @ (p - target) + 0.1 * out * [0, 1, 1]), -2, 2)
        out[0] += hashed.prior_shift(target, toxic, clean)
    return out


EVIDENCE = "evidence double, clauses long, n_words long"


def _evidence(stems, keys: tuple[str, ...]):
    def run(batches):
        scorer = Scorer(stems.value)
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                found = scorer.evidence(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in keys), *map(pa.array, found)],
                    [*keys, "evidence", "clauses", "n_words"],
                )

    return run


def toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, clauses (matched)."""
    docs = documents.select("doc_id", "text")
    weights, (base, by_sum, by_rate) = learned(docs, labels, sample)
    stems = docs.sparkSession.sparkContext.broadcast(weights)
    seen = docs.mapInArrow(_evidence(stems, ("doc_id",)), "doc_id long, " + EVIDENCE)
    rate = 100 * F.col("evidence") / (F.col("n_words") + 20)
    score = 1 / (1 + F.exp(-(F.lit(float(base)) + float(by_sum) * F.log1p("evidence") + float(by_rate) * rate)))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return seen.select("doc_id", held.alias("held_out"), score.alias("score"), "clauses").select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= PREDICT_AT, 1).otherwise(0).alias("predicted"), "clauses"
    )


def op6_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return toxicity(documents, labels)
