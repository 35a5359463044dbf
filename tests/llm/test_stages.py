"""Each stage of the pipeline, and all in a row, against plain Python versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline as P
import public_tokenizers
from ledgerloom.llm import hashed, weak_quality
from ledgerloom.llm import words as W
from llm_frames import clashing, docs  # noqa: F401
from test_line_runs import by_maximal_runs

BENCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
SPACES = "[ \t\n\x0b\x0c\r]"


def split(text):
    import re

    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def best_lines(rows):
    """By runs of three lines or 50 words; what has only white space left goes."""
    texts = [t or "" for _, t in rows]
    _, gone = by_maximal_runs(texts, 3, 50)
    out = []
    for d, (i, text) in enumerate(rows):
        if text is None:
            out.append((i, None))
            continue
        k, kept = -1, []
        for line in text.split("\n"):
            if split(line):
                k += 1
                if (d, k) in gone:
                    continue
            kept.append(line)
        left = "\n".join(kept)
        if left == text or split(left):
            out.append((i, left))
    return out


def best_of_similar(rows):
    sets = {}
    for i, text in rows:
        words = split(lowered(text))
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} - {()})
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [(i, t) for i, t in rows if top(i) == i]


def best_clean(rows, items):
    import re

    def words(text):
        return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", lowered(text))

    windows = set()
    for text in items:
        own = words(text)
        windows |= {tuple(own[k:k + 10]) for k in range(len(own) - 9)} if len(own) >= 10 else {tuple(own)} - {()}
    out = []
    for i, text in rows:
        own = words(text)
        if not any(tuple(own[k:k + n]) in windows for n in {len(w) for w in windows} for k in range(len(own) - n + 1)):
            out.append((i, text))
    return out


def best_accepted(spark, frame, rows):
    """Scores by the learned weights, gram by gram."""
    (weights, slope, offset), _ = weak_quality.learned(frame)
    out = []
    for i, text in rows:
        found = W.Words([(text or "").encode()], W.NOT_SPACE, lower=False)
        total = 0.0
        for kind, hashes, first, last in hashed.grams(found):
            own = [float(weights[kind * hashed.BUCKETS + b]) for b in hashed._bucket(hashes[first[0]: max(first[0], last[0])])]
            total += sum(own) / (len(own) + hashed.PRIOR)
        p = 1 / (1 + np.exp(-(slope * total + offset))) if len(found.starts) else 0.0
        if p >= weak_quality.KEEP_AT:
            out.append((i, text))
    return out


def tokens_of(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation(), tokenizer.no_padding()
    out = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), ids, hashlib.sha256(back.encode()).hexdigest()))
    return out


@pytest.fixture
def corpus(spark, docs, tmp_path):
    rng = random.Random(12)
    items = [" ".join(f"Q{rng.randrange(10**6)}" for _ in range(14)), "two words"]
    spark.createDataFrame(list(enumerate(items)), BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")

    def line(n):
        return " ".join(f"{rng.choice(['the', 'a', 'Of'])} w{rng.randrange(10**5)}" for _ in range(n)) + "."

    run, long = [line(4) for _ in range(4)], line(30)
    rows = []
    for i in range(40):
        own = [line(rng.randrange(2, 12)) for _ in range(rng.randrange(3, 8))]
        if i % 5 == 0:
            own += run
        if i % 7 == 0:
            own.insert(1, long)
        if i % 9 == 4:
            own.insert(0, "see " + items[0].lower() + " there")
        rows.append((i, "\n".join(own)))
    rows += [(100 + i, rows[i][1].replace("w1", "v1", 1)) for i in range(6)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "!!! ### $$$ %%% " * 20), (204, rows[3][1]), (205, "two words")]
    return rows, items, str(tmp_path)


def texts(frame):
    return sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())


def test_each_stage(spark, docs, corpus):
    rows, items, folder = corpus
    frame = docs(rows)
    assert texts(P.quality(spark, frame, folder)) == sorted(best_accepted(spark, frame, rows))
    assert texts(P.lines(spark, frame, folder)) == sorted(best_lines(rows))
    assert texts(P.similar(spark, frame, folder)) == sorted(best_of_similar(rows))
    assert texts(P.decontaminated(spark, frame, folder)) == sorted(best_clean(rows, items))
    got = sorted(tuple(r) for r in P.tokens(spark, frame, folder).select("doc_id", "n_tokens", "ids", "decoded_sha256").collect())
    assert got == sorted(tokens_of(rows))


def test_all_in_a_row(spark, docs, corpus):
    rows, items, folder = corpus
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    stored = spark.read.parquet(f"{folder}/documents.parquet")
    left = sorted(best_accepted(spark, stored, rows))
    left = best_clean(best_of_similar(best_lines(left)), items)
    got = P.run(spark, folder)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_tokens", "ids", "decoded_sha256").collect()) == sorted(tokens_of(left))
    assert 0 < len(left) < len(rows)


def test_lines_keep_lengths(spark, docs, corpus):
    rows, _, folder = corpus
    for r in P.lines(spark, docs(rows), folder).collect():
        assert r.text is None or r.n_chars == len(r.text)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_edges(spark, docs, clashing, corpus, name):
    """Missing ids, empty and NULL texts, repeated rows, other columns, no rows."""
    _, _, folder = corpus
    stage = dict(P.STAGES)[name]
    rows = [(None, "no id here"), (None, None), (1, "one"), (1, "one"), (2, ""), (3, " \n\t"), (4, "x " * 30_000)]
    frame = clashing(docs(rows))
    got = stage(spark, frame, folder)
    if name != P.STAGES[-1][0]:
        assert got.columns == frame.columns
    assert got.count() <= len(rows)
    assert stage(spark, docs([]), folder).collect() == []


def test_one_id_on_very_many_rows(spark, docs):
    """Samples are bounded by rows: of an id on 20,000 rows one text is learned from."""
    from ledgerloom.llm.quality_rules import fitted_scorer
    from ledgerloom.llm.toxicity import toxicity

    many = spark.range(20_000).select(
        F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"), F.lit(1.0).alias("label")
    )
    assert fitted_scorer(many, 1, 1)[3] == 1
    labelled = spark.createDataFrame([(7, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    scored = toxicity(many.select("doc_id", "text"), labelled)
    assert scored.count() == 20_000
