"""Suffix-array dedup: bytes of strings that also start anywhere else.

A string of ``length`` bytes is repeated if it starts at two places, in one text
or in two. Every byte of a repeated string is removed, judged on the input.

Sorting every suffix of a corpus would multiply it by its context, so only some
suffixes are sorted. Each string of ``length`` bytes has one anchor, the place of
the least ``gram``-byte gram in it (the last, if equal): equal strings have equal
anchors at equal distance, so a string is repeated only if its anchor's gram is.
An anchor owns all strings it is the anchor of; it has a context of ``length -
gram`` bytes before and ``length`` bytes from it on, which holds them all.

1. Anchors with their gram and a digest of their context, counted with map-side
   combining. A gram that occurs once settles its anchor: nothing is repeated. A
   context that occurs twice settles all its anchors: all they own is repeated.
2. Only distinct contexts of the same gram are left to compare. By gram, the
   texts from the anchors on, and those before the anchors reversed, are sorted
   by the deep-shallow method (``suffixes``). With the common prefixes of
   neighbours, contexts that agree ``r`` bytes to the right and ``l`` to the left
   share the strings that reach no further, and for every distance between string
   start and anchor one pass finds the contexts that share theirs with another.
3. Grams with more than ``crowd`` distinct contexts (a passage that very many
   texts have in common) would not fit a task. Their strings are counted by
   digest, in ``steps``: of a block of neighbouring strings, the part they all
   contain tells if none can be repeated, the whole they span tells if all are,
   and only undecided blocks go to the next step, down to single strings.

Removed runs are gathered by document and cut out of the text in a last pass.

Defined cases: NULL is an empty text; texts shorter than ``length`` keep all;
repeated rows are separate texts, so they remove each other; rows without doc_id
or with a doc_id of their own several times are told apart by their texts; other
columns are not read. The kept bytes of a text need not be valid UTF-8.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.suffixes import deep_shallow
from ledgerloom.llm.work import Work, row_key, shuffle_partitions
from ledgerloom.operators.lookup import spread_join

LENGTH, GRAM = 400, 50
CROWD = 2_000
STEPS = (32, 4, 1)
#: Contexts sorted and compared in one go inside a task.
BATCH = 20_000


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors, least and greatest distance of the strings they own,
    and hashes of their grams."""
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(len(data) - gram + 1)
    hashes = W.Sums(data).of(starts, starts + gram)
    low = np.uint64(0xFFFFFFFF)
    keyed = (hashes & ~low) | (low - starts.astype(np.uint64))
    place = (low - (W.least_in_window(keyed, length - gram + 1) & low)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return at, at - last, at - first, hashes[at].view(np.int64)


def _anchors(length: int, gram: int):
    def run(batches):
        for batch in batches:
            ids, rows = batch.column("_id").to_numpy(), batch.column("_row").to_numpy()
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for i, text in enumerate(W.texts_of(batch.column("text"))):
                if text is None or len(text) < length:
                    continue
                at, low, high, grams = anchors(text, length, gram)
                digest = xxhash.xxh3_64_intdigest
                context = np.array([digest(text[max(0, p - length + gram): p + length], p if p < length - gram else length) for p in at.tolist()], np.uint64)
                n = len(at)
                for column, values in zip(out, (np.full(n, ids[i]), np.full(n, rows[i]), at, low, high, grams, context.view(np.int64)), strict=True):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(t)) for c, t in zip(out, (np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int64), strict=True)],
                    ["_id", "_row", "at", "low", "high", "gram", "context"],
                )

    return run


ANCHOR = "_id long, _row long, at long, low int, high int, gram long, context long"


def _contexts(length: int, gram: int):
    """Contexts of the listed anchors of each text."""

    def run(batches):
        reach = length - gram
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for text, key, row, listed in zip(texts, *(batch.column(c).to_pylist() for c in ("_id", "_row", "listed")), strict=True):
                n = len(listed)
                at = [x["at"] for x in listed]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * n, pa.int64()),
                        pa.array([row] * n, pa.int64()),
                        pa.array(at, pa.int64()),
                        *(pa.array([x[c] for x in listed], k) for c, k in (("low", pa.int32()), ("high", pa.int32()), ("gram", pa.int64()), ("settled", pa.bool_()), ("crowded", pa.bool_()))),
                        pa.array([text[max(0, p - reach): p] for p in at], pa.binary()),
                        pa.array([text[p: p + length] for p in at], pa.binary()),
                    ],
                    ["_id", "_row", "at", "low", "high", "gram", "settled", "crowded", "before", "after"],
                )

    return run


CONTEXT = "_id long, _row long, at long, low int, high int, gram long, settled boolean, crowded boolean, before binary, after binary"
SPAN = "_id long, _row long, first long, last long"


def shared_distances(gram: np.ndarray, before: list[bytes], after: list[bytes], low: np.ndarray, high: np.ndarray, length: int, reach: int) -> np.ndarray:
    """Whether the string that starts ``d`` bytes before anchor i occurs at
    another anchor of the same gram, for all ``d`` up to ``reach``."""
    n = len(gram)
    prefix = [g.tobytes() for g in gram]
    right_order, right = deep_shallow([p + a for p, a in zip(prefix, after, strict=True)])
    left_order, left = deep_shallow([p + b[::-1] for p, b in zip(prefix, before, strict=True)])
    right, left = np.array(right) - 8, np.array(left) - 8
    right_order, left_order = np.array(right_order), np.array(left_order)
    out = np.zeros((n, reach + 1), bool)
    right_class, left_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d in range(reach + 1):
        # Classes of contexts that agree length - d bytes on, and d bytes back.
        right_class[right_order] = np.cumsum(right < length - d)
        left_class[left_order] = np.cumsum(left < d)
        own = np.flatnonzero((low <= d) & (d <= high))
        key = right_class[own] * (n + 1) + left_class[own]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        out[own[order[1:][same]], d] = True
        out[own[order[:-1][same]], d] = True
    return out


def _runs(at: np.ndarray, hits: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first and last byte (exclusive) of runs of marked distances."""
    edge = np.zeros((hits.shape[0], hits.shape[1] + 2), np.int8)
    edge[:, 1:-1] = hits
    step = np.diff(edge, axis=1)
    row, first = np.nonzero(step == 1)
    _, past = np.nonzero(step == -1)
    return row, at[row] - (past - 1), at[row] - first + length


def _compare(length: int, gram: int):
    """Contexts sorted by gram to spans of unsettled anchors that are repeated."""
    reach = length - gram

    def judged(rows: dict[str, list]) -> pa.RecordBatch:
        grams = np.array(rows["gram"], np.int64)
        low, high, at = (np.array(rows[c], np.int64) for c in ("low", "high", "at"))
        hits = shared_distances(grams, rows["before"], rows["after"], low, high, length, reach)
        hits[np.array(rows["settled"], bool)] = False
        row, first, last = _runs(at, hits, length)
        ids, keys = np.array(rows["_id"], np.int64)[row], np.array(rows["_row"], np.int64)[row]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, keys, first, last)], ["_id", "_row", "first", "last"])

    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                held.setdefault(name, []).extend(column.to_pylist())
            # Whole grams only: the last one may go on.
            while held and len(held["gram"]) >= BATCH and held["gram"][0] != held["gram"][-1]:
                cut = len(held["gram"]) - 1
                while held["gram"][cut - 1] == held["gram"][-1]:
                    cut -= 1
                yield judged({k: v[:cut] for k, v in held.items()})
                held = {k: v[cut:] for k, v in held.items()}
        if held and held["gram"]:
            yield judged(held)

    return run


def _blocks(length: int, step: int):
    """Blocks of ``step`` distances to digests of what their strings all contain
    (core) and of what they span (hull)."""

    def run(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            columns = (batch.column(c).to_pylist() for c in ("anchor", "low", "high", "from", "to", "gram", "before", "after"))
            for anchor, low, high, a, b, gram, before, after in zip(*columns, strict=True):
                text, p = before + after, len(before)
                for first in range(a - a % step, b + 1, step):
                    last = first + step - 1
                    if last < low or first > high:
                        continue
                    core = text[max(0, p - first): max(0, p - last + length)]
                    whole = low <= first and last <= high
                    hull = digest(text[p - last: p - first + length]) if whole else None
                    mark = f"{gram}:{first}:".encode()
                    for column, value in zip(out, (anchor, first, last, digest(mark + core), hull, whole), strict=True):
                        column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["anchor", "first", "last", "core", "hull", "whole"])

    return run


def _crowded_spans(work: Work, contexts: DataFrame, length: int) -> DataFrame:
    """Spans of anchors whose gram has too many contexts, by counting digests."""
    anchor = F.concat_ws(":", "_id", "_row", "at")
    own = contexts.filter("crowded").withColumn("anchor", anchor)
    open_blocks = own.withColumn("from", F.col("low")).withColumn("to", F.col("high"))
    wide = "anchor string, first int, last int, core binary, hull binary, whole boolean"
    found = None
    for step in STEPS:
        cut = open_blocks.select("anchor", "low", "high", "from", "to", "gram", "before", "after")
        blocks = work.keep(cut.mapInArrow(_blocks(length, step), wide), f"blocks{step}")
        cores = blocks.groupBy("core").agg(F.count(F.lit(1)).alias("cores")).filter("cores > 1")
        hulls = blocks.filter("whole").groupBy("core", "hull").agg(
            F.count(F.lit(1)).alias("hulls"), F.min("anchor").alias("witness")
        )
        live = spread_join(blocks, cores, ["core"], "inner")
        live = work.keep(spread_join(live, hulls, ["core", "hull"], "left"), f"live{step}")
        done = live.filter("hulls > 1").select("anchor", "first", "last")
        found = done if found is None else found.unionByName(done)
        # One of those that are settled stays, as others may share a part with it.
        rest = live.filter("hulls IS NULL OR hulls < 2 OR anchor = witness").select(
            "anchor", F.col("first").alias("from"), F.col("last").alias("to")
        )
        open_blocks = spread_join(rest, own, ["anchor"], "inner")
    return spread_join(found, own.filter("NOT settled").select("anchor", "_id", "_row", "at"), ["anchor"], "inner").select(
        "_id", "_row", (F.col("at") - F.col("last")).alias("first"), (F.col("at") - F.col("first") + length).alias("last")
    )


def _strip(batches):
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for text, spans in zip(W.texts_of(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            data, runs, kept, at = text or b"", [], [], 0
            for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
                if runs and first <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], last)
                else:
                    runs.append([first, last])
            for first, last in runs:
                kept.append(data[at:first])
                at = last
            kept = b"".join([*kept, data[at:]])
            removed = sum(b - a for a, b in runs)
            for column, value in zip(out, (len(data), removed, len(runs), hashlib.sha256(kept).hexdigest(), runs, kept), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"],
        )


def repeated_bytes(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed
    (runs as [first, past the last] byte) and kept (the rest)."""
    spark = documents.sparkSession
    work = Work(spark, "suffix_dedup")
    keyed = documents.select("doc_id", "text", *row_key())
    found = work.keep(keyed.select("_id", "_row", "text").mapInArrow(_anchors(length, gram), ANCHOR), "anchors")

    counted = found.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"))
    by_gram = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all")).filter("all > 1")
    open_kinds = work.keep(
        spread_join(counted, by_gram.select("gram", "kinds"), ["gram"], "inner").filter("n > 1 OR kinds > 1"), "kinds"
    )
    live = work.keep(spread_join(found, open_kinds, ["gram", "context"], "inner"), "live")
    work.drop(found)
    settled = live.filter("n > 1").select(
        "_id", "_row", (F.col("at") - F.col("high")).alias("first"), (F.col("at") - F.col("low") + length).alias("last")
    )

    # One anchor stands for all with its context.
    one = F.min(F.struct("_id", "_row", "at", "low", "high")).alias("one")
    listed = live.filter("kinds > 1").groupBy("gram", "context").agg(one, F.first("n").alias("n"), F.first("kinds").alias("kinds"))
    by_text = listed.select(
        "one._id", "one._row",
        F.struct("one.at", "one.low", "one.high", "gram", (F.col("n") > 1).alias("settled"), (F.col("kinds") > crowd).alias("crowded")).alias("item"),
    ).groupBy("_id", "_row").agg(F.collect_list("item").alias("listed"))
    texts = keyed.filter(F.length("text") * 4 >= length).select("_id", "_row", "text")
    # Repeated rows have the same contexts; one of them is enough.
    contexts = work.keep(
        texts.join(by_text, ["_id", "_row"]).mapInArrow(_contexts(length, gram), CONTEXT).dropDuplicates(["_id", "_row", "at"]),
        "contexts",
    )
    parts = shuffle_partitions(spark)
    compared = (
        contexts.filter("NOT crowded")
        .repartition(parts, "gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_compare(length, gram), SPAN)
    )
    spans = settled.unionByName(compared)
    if not contexts.filter("crowded").isEmpty():
        spans = spans.unionByName(_crowded_spans(work, contexts, length))
    gathered = spans.groupBy("_id", "_row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    gathered = work.keep(gathered, "spans")
    return keyed.join(gathered, ["_id", "_row"], "left").select("doc_id", "text", "spans").mapInArrow(
        _strip,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>, kept binary",
    )


def op1_suffix_dedup(documents: DataFrame) -> DataFrame:
    return repeated_bytes(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
