"""MinHash near-duplicates with circulant permutations.

A text is the set of its distinct word shingles; texts are linked if
100 * common >= ``percent`` * united. One document of each connected group is kept.

1. Texts with the same set are one text from here on.
2. One permutation places each shingle on a circle of ``CIRCLE`` slots. A second
   one numbers the slots; coordinate k of a signature is the least number found k
   slots after a shingle of the set. So all coordinates of a shingle are
   neighbours in one table: the second permutation, shifted around the circle.
3. ``BANDS`` groups of ``WIDTH`` coordinates are the buckets of a set. Sets that
   are 0.8 alike miss each other in all of them once in 280 million cases; those
   that are 0.4 alike meet in a quarter of the cases, 0.3 alike in one of 22.
4. Each set is compared, on full sets, with the least one of the buckets that it
   shares most often. What is linked is one component.
5. In buckets that still hold several components, each set is compared with all
   sets of the others. These are cut into groups by their shingles; the union
   of a group's shingles bounds what a set can have in common with any member,
   and only groups that can hold a link are opened.

Every pair that shares a bucket is thus compared, bounded below the threshold, or
already in one component. A bucket with many sets is never in one task: its rows
are joined, not collected, and its sets are dealt to groups by hash.

Defined cases: a NULL text or one without words has an empty set and is linked
with nothing; with fewer words than a shingle the whole sequence is the one
shingle; rows that share a doc_id are one document; rows without doc_id are
linked with nothing, have no component and are kept; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.components import components
from ledgerloom.llm.similar import links_in_groups, packed_texts, sets_of
from ledgerloom.llm.work import Work
from ledgerloom.operators.lookup import spread_join

SHINGLE, PERCENT = 2, 80
BANDS, WIDTH = 64, 6
CIRCLE = 1 << 20
#: Components of fewer documents share groups with others.
SMALL = 64
#: Shingles of the members of a group, on average: few groups a bucket to ask.
GROUP_TOKENS = 1 << 15
#: Shingles looked up at once: 1.5 MB of coordinates, which stay in a core's cache.
LOOKUP = 1 << 10
SEED = 20_177


@lru_cache(maxsize=1)
def _circle(length: int) -> np.ndarray:
    """The second permutation, its start repeated so that no window wraps."""
    order = np.random.default_rng(SEED).permutation(CIRCLE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:length]]), length)


def _slots(tokens: np.ndarray) -> np.ndarray:
    """The first permutation: a bijection of 64 bits, of which the first 20 count."""
    return (W.mixed(tokens.view(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(44)).astype(np.int64)


def signatures(sets: list[np.ndarray], length: int = BANDS * WIDTH) -> np.ndarray:
    """A row of ``length`` coordinates for each set; those of an empty one are the
    greatest number."""
    out = np.full((len(sets), length), np.iinfo(np.uint32).max, np.uint32)
    windows = _circle(length)
    for least, own in zip(out, sets, strict=True):
        slots = _slots(own)
        for at in range(0, len(slots), LOOKUP):
            np.minimum(least, windows[slots[at: at + LOOKUP]].min(axis=0), out=least)
    return out


def band_keys(given: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    bands = given.shape[1] // width
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(given), 1))
    for k in range(width):
        keys = W.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + given[:, k::width][:, :bands].astype(np.uint64))
    return keys.view(np.int64)


def _profile(size: int):
    def run(batches):
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            at = 0
            for a, b in W.slices(texts):
                sets = sets_of(texts[a:b], size)
                n = np.array([len(s) for s in sets], np.int64)
                digest = np.array([np.bitwise_xor.reduce(W.mixed(s.view(np.uint64))) for s in sets], np.uint64)
                total = np.array([s.view(np.uint64).sum(dtype=np.uint64) for s in sets], np.uint64)
                keys = band_keys(signatures(sets))
                counts = np.where(n > 0, keys.shape[1], 0)
                ids = batch.column("doc_id").slice(at, b - a)
                at += b - a
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n), pa.array(digest.view(np.int64)), pa.array(total.view(np.int64)), W.lists(keys[n > 0].ravel(), counts)],
                    ["doc_id", "n", "d1", "d2", "bands"],
                )

    return run


def near_duplicates(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    spark = documents.sparkSession
    work = Work(spark, "minhash")
    docs = documents.select("doc_id", "text", F.lit(0).cast("long").alias("mark"))
    schema = "doc_id long, n long, d1 long, d2 long, bands array<long>"
    profile = work.keep(docs.select("doc_id", "text").mapInArrow(_profile(size), schema), "profile")

    # 1. One document for each set; a document with several texts has several sets.
    full = profile.filter("doc_id IS NOT NULL AND n > 0")
    rep = full.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    reps = work.keep(
        spread_join(full.select("doc_id", "n", "d1", "d2"), rep, ["n", "d1", "d2"], "inner").select("doc_id", "n", "d1", "d2", "rep"),
        "reps",
    )
    same = reps.select("doc_id", "rep").distinct()

    # 3. Buckets with several documents; copies of a set are in by their first.
    first = reps.filter("doc_id = rep").select("doc_id", "d1", "d2").distinct()
    firsts = spread_join(full, first, ["doc_id", "d1", "d2"], "left_semi").dropDuplicates(["doc_id", "d1", "d2"])
    entries = work.keep(firsts.select(F.col("doc_id").alias("doc"), "n", F.explode("bands").alias("key")), "entries")
    buckets = entries.groupBy("key").agg(F.min("doc").alias("lead"), F.max("doc").alias("last")).filter("lead <> last")
    met = work.keep(spread_join(entries, buckets.select("key", "lead"), ["key"], "inner"), "met")
    counts = work.keep(profile.select("doc_id", "n"), "counts")
    work.drop(entries, profile)

    # 4. Each document with the least one it meets most often.
    shares = met.filter("doc <> lead").groupBy("doc", "lead").count()
    best = shares.groupBy("doc").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("grp"))
    asked = work.keep(best.select("doc", "grp"), "asked")
    wanted = met.select("doc").distinct()
    packed = docs.filter("doc_id IS NOT NULL").mapInArrow(packed_texts, "doc long, mark long, packed binary")
    texts = work.keep(packed.join(wanted, "doc", "left_semi"), "texts")
    leads = asked.select("grp").distinct().select("grp", F.col("grp").alias("doc"), F.lit(0).alias("role"))
    links = work.keep(links_in_groups(work, asked, leads, texts, size, percent), "links")
    linked = links.unionByName(same.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    roots = work.keep(components(work, linked), "roots")

    # 5. Buckets that still hold several components.
    more = work.keep(_across(work, met, asked, roots, texts, size, percent), "links")
    if not more.isEmpty():
        roots = work.keep(components(work, linked.unionByName(more)), "roots")
    reached = roots.groupBy(F.col("node").alias("doc_id")).agg(F.min("root").alias("reached"))
    component = F.coalesce("reached", "doc_id")
    return counts.join(work.keep(reached, "reached"), "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _across(
    work: Work, met: DataFrame, asked: DataFrame, roots: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between documents of different components that share a bucket."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    known = spread_join(roots, sizes, ["root"], "inner").select(F.col("node").alias("doc"), "root", "members")
    placed = work.keep(
        spread_join(met.select("key", "doc", "n"), known, ["doc"], "left").select(
            "key", "doc", "n", F.coalesce("root", "doc").alias("root"), F.coalesce("members", F.lit(1)).alias("members")
        ),
        "placed",
    )
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    between = work.keep(spread_join(placed, several.select("key"), ["key"], "left_semi"), "between")
    # Large components are cut into groups; small ones join those that met the
    # same document before.
    found = between.select("doc", "n", "root", "members").distinct()
    led = spread_join(found, asked.select("doc", F.col("grp").alias("led")), ["doc"], "left")
    small = F.col("members") < SMALL
    kind = F.when(small, F.coalesce("led", "root")).otherwise(F.col("root"))
    led = work.keep(led.select("doc", "n", small.alias("small"), kind.alias("kind")), "led")
    chunks = led.groupBy("small", "kind").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("chunks"))
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks"))
    groups = work.keep(
        spread_join(led, chunks, ["small", "kind"], "inner").select(
            "doc", F.xxhash64("small", "kind", chunk).alias("grp"), F.when(F.col("small"), -1).otherwise(0).alias("role")
        ),
        "groups",
    )
    # A bucket's groups, each with its greatest component: a document asks those
    # that have a greater one than its own, so each pair is asked for once.
    table = spread_join(between, groups.select("doc", "grp"), ["doc"], "inner").groupBy("key", "grp").agg(
        F.max(F.struct("members", "root")).alias("top"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    t = {c: F.col(f"t.{c}") for c in table.columns}
    q = {c: F.col(f"q.{c}") for c in between.columns}
    pairs = between.alias("q").join(
        table.alias("t"),
        (q["key"] == t["key"])
        & (F.struct(q["members"], q["root"]) < t["top"])
        & (100 * t["most"] >= percent * q["n"])
        & (percent * t["least"] <= 100 * q["n"]),
    )
    wanted = work.keep(pairs.select(t["grp"].alias("grp"), q["doc"].alias("doc")).distinct(), "wanted")
    return links_in_groups(work, wanted, groups, texts, size, percent)


def op11_minhash(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents)
