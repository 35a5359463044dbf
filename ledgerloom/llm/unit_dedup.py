"""Substring dedup by hashing clauses.

A unit is a clause: it ends after a line break or after one of ``. , ; : ! ?``
before white space, and all white space that follows belongs to it. Normalised,
its words are in lower case (A-Z) and parted by single spaces. Units are grouped
by digest over all documents, with map-side combining; the occurrence with the
least (doc_id, offset) is the first, all others are later copies. Later copies are
removed where neighbouring ones have ``RUN_WORDS`` words or more together, so a
clause that happens to recur stays, and a copied passage goes from its first whole
clause to its last. The bound is 40 words because a passage of more than 50 words
loses parts of the clauses at its two ends. What stays is listed with its byte
offsets in the original text.

Units without a word (only white space at the start of a text) are neither
removed nor compared. Defined cases: NULL is an empty text, which has no unit; a
text of which all is removed becomes empty; rows that are equal in id and text are
one text and keep the same units; a row without doc_id comes before all others;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.work import Work, row_key, shuffle_partitions

RUN_WORDS = 40
#: Units among which a task looks for copies before it sends any.
TOGETHER = 1 << 19
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"]] = True
_ROUND = np.uint64(0x9FB21C651E98DF25)


def clauses(texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
    """Of the units with a word of some texts: text, first and past the last byte,
    words, and two digests of the words in order."""
    found = W.Words(texts, W.NOT_SPACE, lower=True)
    n = len(found.starts)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, empty
    breaks = np.zeros(len(found.data) + 1, np.int64)
    np.cumsum(found.data == 0x0A, out=breaks[1:])
    begins = np.ones(n, bool)
    ended = _ENDS[found.data[found.ends[:-1] - 1]]
    begins[1:] = ended | (breaks[found.starts[1:]] > breaks[found.ends[:-1]])
    heads = np.flatnonzero(begins)
    place = (np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))).astype(np.uint64)
    digests = [
        np.add.reduceat(W.mixed((found.hashes ^ np.uint64(seed)) + place * _ROUND), heads).view(np.int64)
        for seed in (0, 0x5851F42D4C957F2D)
    ]
    doc = found.doc[heads]
    origin = found.begin[doc]
    start = found.starts[heads] - origin
    # White space before the first word is part of no unit with a word, unless the
    # line goes on; a unit reaches to the next one or to the end of its text.
    first = np.append(True, doc[1:] != doc[:-1])
    lead = first & (breaks[found.starts[heads]] == breaks[origin])
    start[lead] = 0
    length = found.begin[doc + 1] - 1 - origin
    end = np.append(start[1:], 0)
    last = np.append(first[1:], True)
    end[last] = length[last]
    return doc, start, end, np.diff(np.append(heads, n)), *digests


def _settled(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Of some units the first of each digest, to be compared with those of other
    tasks (``known`` 0), and all others, which are later copies for certain."""
    key, row, k, words, d1, d2 = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((k, row, key, d2, d1))
    key, row, k, words, d1, d2 = (c[order] for c in (key, row, k, words, d1, d2))
    start = np.ones(len(k), bool)
    start[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
    first = np.flatnonzero(start)[np.cumsum(start) - 1]
    again = (key == key[first]) & (row == row[first]) & (k == k[first]) & ~start
    known = np.where(start, 0, 1 + (W.mixed((row ^ k).view(np.uint64)) >> np.uint64(34)).astype(np.int64))
    use = ~again  # A repeated row has the same places.
    return pa.RecordBatch.from_arrays(
        [pa.array(c[use]) for c in (key, row, k.astype(np.int32), words.astype(np.int32), d1, d2.astype(np.int32), known.astype(np.int32))],
        ["_id", "_row", "k", "words", "d1", "d2", "known"],
    )


def _units(together: int):
    def run(batches):
        parts, size = [], 0
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            keys, rows = (batch.column(c).to_numpy() for c in ("_id", "_row"))
            for a, b in W.slices(texts):
                doc, _, _, words, d1, d2 = clauses(texts[a:b])
                if not len(doc):
                    continue
                firsts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                k = np.arange(len(doc)) - np.repeat(firsts, np.diff(np.append(firsts, len(doc))))
                parts.append([keys[a + doc], rows[a + doc], k, words, d1, d2 >> 32])
                size += len(doc)
                if size >= together:
                    yield _settled(parts)
                    parts, size = [], 0
        if parts:
            yield _settled(parts)

    return run


def _later(batches):
    """Rows sorted by (known, d1, d2, place): all but the first place of each
    digest, and those known to be later."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2, key, row, k, known = (batch.column(c).to_numpy() for c in ("d1", "d2", "_id", "_row", "k", "known"))
        start = np.ones(len(k), bool)
        start[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        at = np.flatnonzero(start)[np.cumsum(start) - 1]
        places = [c[at] for c in (key, row, k)]
        if last is not None and (d1[0], d2[0]) == last[:2]:
            for c, value in zip(places, last[2:], strict=True):
                c[at == 0] = value
        later = (known > 0) | (key != places[0]) | (row != places[1]) | (k != places[2])
        last = (d1[-1], d2[-1], *(c[-1] for c in places))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(pa.array(later)) for c in ("_id", "_row", "k", "words")], ["_id", "_row", "k", "words"]
        )


def removed_units(later: set[int], words: np.ndarray, run_words: int) -> list[tuple[int, int]]:
    """Runs (first, past the last) of neighbouring ``later`` units with
    ``run_words`` words or more."""
    out, run = [], []
    for k in [*sorted(later), -1]:
        if run and k != run[-1] + 1:
            if words[run[0]: run[-1] + 1].sum() >= run_words:
                out.append((run[0], run[-1] + 1))
            run = []
        run.append(k)
    return out


def _remove(run_words: int):
    def run(batches):
        for batch in batches:
            texts, lists = W.texts_of(batch.column("text")), batch.column("later").to_pylist()
            for a, b in W.slices(texts):
                out: list[list] = [[] for _ in range(4)]
                doc, start, end, words, _, _ = clauses([t if x else b"" for t, x in zip(texts[a:b], lists[a:b], strict=True)])
                bounds = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    text, at, spans, count = texts[a + i] or b"", 0, [], 0
                    first = bounds[i]
                    for u, v in removed_units(set(lists[a + i] or ()), words[first: bounds[i + 1]], run_words):
                        count += v - u
                        if start[first + u] > at:
                            spans.append((at, int(start[first + u])))
                        at = int(end[first + v - 1])
                    if at < len(text):
                        spans.append((at, len(text)))
                    kept = b"".join(text[x:y] for x, y in spans)
                    for column, value in zip(out, (count, hashlib.sha256(kept).hexdigest(), spans, kept), strict=True):
                        column.append(value)
                kinds = (pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                arrays[3] = arrays[3].cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *arrays], ["doc_id", "n_removed", "kept_sha256", "kept_spans", "kept"]
                )

    return run


def unit_deduplicated(documents: DataFrame, run_words: int = RUN_WORDS, together: int = TOGETHER) -> DataFrame:
    """Per document: doc_id, n_removed (units), kept_sha256, kept_spans (first
    and past the last byte of each stretch that stays), kept (text)."""
    spark = documents.sparkSession
    work = Work(spark, "unit_dedup")
    keyed = documents.select("doc_id", "text", *row_key())
    schema = "_id long, _row long, k int, words int, d1 long, d2 int, known int"
    units = keyed.select("_id", "_row", "text").mapInArrow(_units(together), schema)
    # Each task sends a digest once for some hundred thousand units, so a frequent
    # one has few rows; what is known already is dealt out, and none is collected.
    later = (
        units.repartition(shuffle_partitions(spark), "d1", "known")
        .sortWithinPartitions("known", "d1", "d2", "_id", "_row", "k")
        .mapInArrow(_later, "_id long, _row long, k int, words int")
    )
    listed = later.groupBy("_id", "_row").agg(F.collect_list("k").alias("later"), F.sum("words").alias("n"))
    listed = work.keep(listed.filter(F.col("n") >= run_words).drop("n"), "later")
    # The list grows with the corpus; it is never broadcast, at no size.
    return keyed.join(listed.hint("merge"), ["_id", "_row"], "left").select("doc_id", "text", "later").mapInArrow(
        _remove(run_words), "doc_id long, n_removed long, kept_sha256 string, kept_spans array<array<long>>, kept string"
    )


def op8_substring_dedup(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_removed, kept_sha256, kept_spans (as text)."""
    spans = F.transform("kept_spans", lambda s: F.concat_ws("-", s[0].cast("string"), s[1].cast("string")))
    return unit_deduplicated(documents).select("doc_id", "n_removed", "kept_sha256", F.concat_ws(",", spans).alias("kept_spans"))


OP8_SQL = f"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(text,
    '[^\\n]*?(?:[.,;:!?][ \\t\\n\\x0B\\f\\r]|\\n)[ \\t\\n\\x0B\\f\\r]*|[^\\n]+') AS parts
  FROM documents
), numbered AS (
  SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM cut
), units AS (
  SELECT doc_id, i, part, regexp_extract_all(
      translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS unit,
    sum(strlen(part)) OVER (PARTITION BY doc_id ORDER BY i) AS until
  FROM numbered
), marked AS (
  SELECT *, len(unit) > 0 AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, i) > 1 AS later FROM units
), islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, later ORDER BY i) AS island FROM marked
), judged AS (
  SELECT *, later AND sum(len(unit)) OVER (PARTITION BY doc_id, later, island) >= {RUN_WORDS} AS gone FROM islands
), stretched AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, gone ORDER BY i) AS stretch FROM judged
), stretches AS (
  SELECT doc_id, gone, count(*) AS n, min(until - strlen(part)) AS first, max(until) AS past,
    string_agg(part, '' ORDER BY i) AS text
  FROM stretched GROUP BY doc_id, gone, stretch
), kept AS (
  SELECT doc_id, sum(n) FILTER (WHERE gone) AS n_removed,
    string_agg(text, '' ORDER BY first) FILTER (WHERE NOT gone) AS text,
    string_agg(first || '-' || past, ',' ORDER BY first) FILTER (WHERE NOT gone) AS spans
  FROM stretches GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256,
  coalesce(k.spans, '') AS kept_spans
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
