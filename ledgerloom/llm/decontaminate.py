"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) runs of digits, letters and characters beyond
ASCII. A window is ``window`` consecutive words of a benchmark item; an item of
fewer words, but not none, is one window as a whole. A document word inside any
occurrence of a window is hit.

From every ``window`` words the least hash of its ``gram``-word grams (the last
one, if equal) is kept as fingerprint, so a shared window always gives a shared
fingerprint. Distinct fingerprints of documents and items meet in a join;
only for the document and item pairs it finds, the hits are extended to all
windows that both have. Short items are met with grams of their own length.

Defined cases: a NULL or empty text has no words and is not contaminated; an
item without words matches nothing; repeated rows are judged one by one; items
that share an id count once; an item without an id counts under the empty id;
an empty benchmark leaves every document clean; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.work import Work, row_key

WINDOW, GRAM = 10, 4


def winnowed(hashes: np.ndarray, doc: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each text, and the text of each.

    A window of words is kept apart from the next text's by its text number.
    """
    grams, _ = W.windows(hashes, doc, gram)
    inside = window - gram + 1
    # The least hash by its upper 32 bits; of equal ones the last gram wins.
    low = np.uint64(0xFFFFFFFF)
    keyed = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    least = W.least_in_window(keyed, inside)
    whole = doc[: len(least)] == doc[window - 1: window - 1 + len(least)]
    at, owner = low - (least[whole] & low), doc[: len(least)][whole]
    # Neighbouring windows mostly share their least gram.
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    at, owner = at[new].astype(np.int64), owner[new]
    return grams[at], owner


def _of_length(hashes: np.ndarray, size: int) -> np.ndarray:
    return W.mixed(hashes + np.uint64(size))


def fingerprints(texts: list[bytes | None], window: int, gram: int, short: tuple[int, ...], whole: bool):
    """Distinct fingerprints as (values, count per text).

    ``whole``: a text of fewer words than ``window`` gives one for itself, as an
    item does; else all grams of the lengths ``short`` are given.
    """
    found = W.Words(texts, W.LETTERS, lower=True)
    values, owner = winnowed(found.hashes, found.doc, window, gram)
    values, owner = [_of_length(values, 0)], [owner]
    for size in range(1, window) if whole else short:
        grams, one = W.windows(found.hashes, found.doc, size)
        at = found.doc[: len(grams)]
        use = one & (found.counts[at] == size) if whole else one
        values.append(_of_length(grams[use], size))
        owner.append(at[use])
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    counts = np.bincount(owner[new], minlength=len(texts))
    return values[new].view(np.int64), counts, found.counts


def _prints(window: int, gram: int, short: tuple[int, ...], whole: bool, keys: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                values, counts, n = fingerprints(texts[a:b], window, gram, short, whole)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in keys), pa.array(n, pa.int64()), W.lists(values, counts)],
                    [*keys, "n_words", "prints"],
                )

    return run


def _windows_of(text: bytes, window: int) -> np.ndarray:
    found = W.Words([text], W.LETTERS, lower=True)
    size = min(window, len(found.hashes))
    return _sized(found.hashes, found.doc, size)


def _sized(hashes: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    return _of_length(W.windows(hashes, doc, size)[0], size)


def extended(text: bytes | None, items: list[tuple[str, bytes]], window: int) -> tuple[int, int, list[str]]:
    """Words, hit words, and the ids of items with an occurring window."""
    found = W.Words([text], W.LETTERS, lower=True)
    n, hit, ids = len(found.hashes), np.zeros(len(found.hashes), bool), set()
    own: dict[int, np.ndarray] = {}
    for item, item_text in items:
        theirs = W.Words([item_text], W.LETTERS, lower=True)
        size = min(window, len(theirs.hashes))
        if not 0 < size <= n:
            continue
        if size not in own:
            own[size] = _sized(found.hashes, found.doc, size)
        met = np.isin(own[size], np.unique(_sized(theirs.hashes, theirs.doc, size)))
        if met.any():
            ids.add(item)
            hit |= W.covered(np.flatnonzero(met), size, n)
    return n, int(hit.sum()), sorted(ids)


def _extend(window: int):
    def run(batches):
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            items = batch.column("items").to_pylist()
            n, hit, ids = [], [], []
            for text, found in zip(texts, items, strict=True):
                a, b, c = extended(text, [(x["item"], (x["item_text"] or "").encode()) for x in found or ()], window)
                n.append(a), hit.append(b), ids.append(c)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(ids, pa.list_(pa.string()))],
                ["doc_id", "n_words", "n_hit", "item_ids"],
            )

    return run


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, item_ids (sorted, those that occur)."""
    spark = documents.sparkSession
    work = Work(spark, "decontaminate")
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text")
    ).distinct()
    item_prints = work.keep(
        items.mapInArrow(
            _prints(window, gram, (), True, ("item", "text")),
            "item string, text string, n_words long, prints array<long>",
        ).select("item", F.col("text").alias("item_text"), "n_words", "prints"),
        "items",
    )
    sizes = item_prints.filter((F.col("n_words") > 0) & (F.col("n_words") < window))
    short = tuple(sorted(r[0] for r in sizes.select("n_words").distinct().collect()))

    keyed = documents.select("doc_id", "text", *row_key())
    prints = keyed.mapInArrow(
        _prints(window, gram, short, False, ("_id", "_row")),
        "_id long, _row long, n_words long, prints array<long>",
    ).select("_id", "_row", F.explode("prints").alias("print"))
    theirs = item_prints.select(F.xxhash64("item", "item_text").alias("at"), F.explode("prints").alias("print"))
    pairs = prints.join(theirs, "print").select("_id", "_row", "at").distinct()
    named = item_prints.select(F.xxhash64("item", "item_text").alias("at"), F.struct("item", "item_text").alias("one"))
    found = work.keep(
        pairs.join(named, "at").groupBy("_id", "_row").agg(F.collect_list("one").alias("items")), "found"
    )
    return keyed.join(found, ["_id", "_row"], "left").select("doc_id", "text", "items").mapInArrow(
        _extend(window), "doc_id long, n_words long, n_hit long, item_ids array<string>"
    )


def digest_of(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def op5_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of ``contamination`` that is compared with other engines."""
    return contamination(documents, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
