"""Line dedup: later copies of repeated runs of lines.

A text is a sequence of lines (cut at line feeds); lines without a word are kept
and skipped, so they neither make nor break a run. Every line gets a name, equal
for equal lines, and prefix doubling names longer and longer runs: the run of 2m
lines from a place is the pair of names of the runs of m lines from there and
from m lines on. The name of a run is the least place where it occurs, which
orders nothing but tells runs apart exactly, and at once says where the first
copy is. Places whose run occurs once drop out in each round, so the rounds soon
work on repeated text only. Later copies (any but the one at the least place) of
runs of ``min_lines`` lines overlap to cover all longer ones. A line is deleted if
a later copy of a run covers it that has ``min_lines`` lines or more, or
``long_line`` words or more in all, whatever its number of lines: a part of a
copied run is copied too, so it is enough to look at runs of ``min_lines`` lines
and at shorter ones with the words. For the words, names grow by one line a round
and each length is judged; without ``by_words`` (as in OP2_SQL) only single lines
are judged by words.

Places are ordered by doc_id, then by line. Defined cases: NULL stays NULL; a
text with nothing to delete is unchanged; rows that are equal in id and text are
one text, and keep the same lines; a row without doc_id comes before all others;
other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.work import Work, row_key
from ledgerloom.operators.lookup import spread_join

MIN_LINES, LONG_LINE = 3, 50
PLACE = ("_id", "_row", "k")
NAME = ("a_id", "a_row", "a_k")
_WORD = "[^ \\t\\n\\x0B\\f\\r]+"


def _named(places: DataFrame, key: list[str]) -> DataFrame:
    """Places whose key occurs twice, with the least of them as name."""
    first = F.min(F.struct(*PLACE)).alias("first")
    classes = places.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), first).filter("n > 1")
    names = [F.col(f"first.{p}").alias(n) for p, n in zip(PLACE, NAME, strict=True)]
    return spread_join(places, classes.select(*key, *names), key, "inner")


def later_copies(work: Work, keyed: DataFrame, min_lines: int, long_line: int, by_words: bool) -> DataFrame:
    """Lines to delete: _id, _row, k (number among lines with a word)."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD))
    places = keyed.select("_id", "_row", F.posexplode(lines).alias("k", "line")).select(
        *PLACE,
        F.xxhash64("line").alias("d1"),
        F.xxhash64(F.lit("again"), F.reverse("line")).alias("d2"),
        F.regexp_count("line", F.lit(_WORD)).alias("words"),
    )
    places = work.keep(places.dropDuplicates(list(PLACE)), "places")
    named = work.keep(_named(places, ["d1", "d2"]).select(*PLACE, *NAME, "words", F.col("words").alias("last")), "lines")
    work.drop(places)
    is_later = F.struct(*PLACE) != F.struct(*NAME)

    def lines_of(runs: DataFrame, size: int) -> DataFrame:
        return runs.filter(is_later).select("_id", "_row", F.explode(F.sequence(F.col("k"), F.col("k") + size - 1)).alias("k"))

    found = lines_of(named.filter(F.col("words") >= long_line), 1)
    size, words = 1, ("words", "last") if by_words else ()
    while size < min_lines:
        step = 1 if by_words else min(size, min_lines - size)
        ends = [F.col(n).alias(f"b{n[1:]}") for n in NAME] + [F.col(n).alias(f"b_{n}") for n in words[1:]]
        on = named.select("_id", "_row", (F.col("k") - step).alias("k"), *ends)
        pairs = named.select(*PLACE, *NAME, *words[:1]).join(on, list(PLACE))
        pairs = work.keep(pairs, "pairs")
        key = [f"{side}{n[1:]}" for side in ("l", "r") for n in NAME]
        both = ((F.col("words") + F.col("b_last")).alias("words"), F.col("b_last").alias("last")) if by_words else ()
        renamed = pairs.select(
            *PLACE, *(F.col(n).alias(f"l{n[1:]}") for n in NAME), *(F.col(f"b{n[1:]}").alias(f"r{n[1:]}") for n in NAME), *both
        )
        named = work.keep(_named(renamed, key).select(*PLACE, *NAME, *words), "runs")
        size += step
        if by_words and size < min_lines:
            found = found.unionByName(lines_of(named.filter(F.col("words") >= long_line), size))
    return lines_of(named, min_lines).unionByName(found).distinct()


def _cut(batches):
    """Drops the listed lines; the other columns pass through."""
    for batch in batches:
        names = batch.schema.names
        texts, lists = W.texts_of(batch.column("_text")), batch.column("_deleted").to_pylist()
        kept, count = [], []
        for text, deleted in zip(texts, lists, strict=True):
            if deleted and text is not None:
                gone, k, rest = set(deleted), -1, []
                for line in text.split(b"\n"):
                    if line.strip(b" \t\n\x0b\x0c\r"):
                        k += 1
                        if k in gone:
                            continue
                    rest.append(line)
                text = b"\n".join(rest)
            kept.append(text)
            count.append(len(deleted or ()))
        rest = [batch.column(i) for i, n in enumerate(names) if n not in ("_text", "_deleted")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(np.array(count, np.int64))],
            [*(n for n in names if n not in ("_text", "_deleted")), "_kept", "_n_deleted"],
        )


def deduplicated(
    documents: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE, by_words: bool = True
) -> DataFrame:
    """``documents`` with the columns _kept (the text that is left) and
    _n_deleted (lines) in addition."""
    spark = documents.sparkSession
    work = Work(spark, "line_dedup")
    keyed = documents.select("*", *row_key())
    deleted = later_copies(work, keyed.select("_id", "_row", "text"), min_lines, long_line, by_words)
    listed = work.keep(deleted.groupBy("_id", "_row").agg(F.collect_list("k").alias("_deleted")), "deleted")
    # The list grows with the corpus; it is never broadcast, at no size.
    rows = keyed.join(listed.hint("merge"), ["_id", "_row"], "left").select(*documents.columns, F.col("text").alias("_text"), "_deleted")
    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes) + ", _kept string, _n_deleted long"
    return rows.mapInArrow(_cut, schema)


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", F.col("_n_deleted").alias("n_deleted"), F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256")
    )


def op2_line_dedup(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_deleted, kept_sha256. By the rule of OP2_SQL, which
    judges runs of fewer than three lines one line at a time."""
    return _digests(deduplicated(documents.select("doc_id", "text"), by_words=False))


def op2_line_runs(documents: DataFrame) -> DataFrame:
    """The same by the whole rule, as in the pipeline: runs of three lines or of 50
    words in all."""
    return _digests(deduplicated(documents.select("doc_id", "text")))


OP2_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), marked AS (
  SELECT *, regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') AS filled FROM lines
), numbered AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked WHERE filled
), runs AS (
  SELECT *, lead(line, 1) OVER d AS line2, lead(line, 2) OVER d AS line3 FROM numbered
  WINDOW d AS (PARTITION BY doc_id ORDER BY k)
), ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, k) > 1 AND line3 IS NOT NULL AS run,
    row_number() OVER (PARTITION BY line ORDER BY doc_id, k) > 1
      AND len(regexp_extract_all(line, '[^ \\t\\n\\x0B\\f\\r]+')) >= {LONG_LINE} AS alone
  FROM runs
), gone AS (
  SELECT doc_id, i, alone OR bool_or(run) OVER (
    PARTITION BY doc_id ORDER BY k ROWS BETWEEN {MIN_LINES - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM ranked
), kept AS (
  SELECT m.doc_id,
    count(*) FILTER (WHERE coalesce(g.gone, false)) AS n_deleted,
    coalesce(string_agg(m.line, chr(10) ORDER BY m.i) FILTER (WHERE NOT coalesce(g.gone, false)), '') AS text
  FROM marked m LEFT JOIN gone g ON g.doc_id = m.doc_id AND g.i = m.i
  GROUP BY m.doc_id
)
SELECT d.doc_id, coalesce(k.n_deleted, 0) AS n_deleted, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP2_RUNS_SQL = f"""
WITH marked AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
), numbered AS (
  SELECT *, len(regexp_extract_all(line, '[^ \\t\\n\\x0B\\f\\r]+')) AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM marked WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')
), runs AS (
  SELECT a.doc_id, a.k, n.n, list(b.line ORDER BY b.k) AS run
  FROM numbered a, range(1, {MIN_LINES + 1}) AS n(n), numbered b
  WHERE b.doc_id = a.doc_id AND b.k BETWEEN a.k AND a.k + n.n - 1
  GROUP BY a.doc_id, a.k, n.n
  HAVING count(*) = n.n AND (n.n = {MIN_LINES} OR sum(b.words) >= {LONG_LINE})
), firsts AS (
  SELECT run, min((doc_id, k)) AS first FROM runs GROUP BY run
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS k
  FROM runs JOIN firsts USING (run) WHERE (doc_id, k) <> first
), rest AS (
  SELECT m.doc_id, count(g.k) AS n_deleted,
    string_agg(m.line, chr(10) ORDER BY m.i) FILTER (WHERE g.k IS NULL) AS text
  FROM marked m
  LEFT JOIN numbered n ON n.doc_id = m.doc_id AND n.i = m.i
  LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.k = n.k
  GROUP BY m.doc_id
)
SELECT d.doc_id, coalesce(r.n_deleted, 0) AS n_deleted, sha256(coalesce(r.text, '')) AS kept_sha256
FROM documents d LEFT JOIN rest r USING (doc_id)
"""
