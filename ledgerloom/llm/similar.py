"""N-gram Jaccard join with a token-group matrix.

A text is the set of its distinct word shingles; two texts are linked if
100 * common >= ``percent`` * united. The result is one row per document with
the least document reachable over links.

1. Texts with the same set are one text from here on.
2. Linked sets share one of their first ``n - need + 1`` tokens, in any order of
   tokens that is the same for all. The order is rare tokens first, by a table
   of counts of fixed size (``CELLS``) over all texts; it only makes groups
   small, any table would give the same links.
3. Documents are partitioned into groups by the least document that shares a
   token with them, and linked to it where they are similar. Most copies are
   then in one component, and are never compared with each other.
4. What is left are tokens that join documents of different components. Large
   components are cut into groups of about ``GROUP`` documents, and small ones
   form groups with others that had the same least document in step 3. The matrix
   says for each token which groups hold it in a member's first tokens.
   A query asks the groups with larger components that its first tokens name, if
   what follows the token in both is enough for the overlap. The
   overlap with the union of a group's tokens bounds the overlap with every
   member; only groups that reach the needed overlap are opened and compared
   member by member.

5. Links are counted inside the components, where all of them are: each set meets
   every other set of its component that shares a token with it, in groups of
   about ``TASK_TOKENS`` shingles.

For the components, every pair of sets is either compared, known not to reach the threshold, or
already in one component; for the count, every pair is compared. A token of many documents is dealt out by salt; a
group with many queries is copied to several tasks.

Defined cases: a NULL text or one without words has an empty set and is linked
with nothing; with fewer words than a shingle the whole sequence is the one
shingle; rows that share a doc_id are one document; rows without doc_id are
linked with nothing and have no component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.components import components
from ledgerloom.llm.work import Work, shuffle_partitions
from ledgerloom.operators.lookup import spread_join

SHINGLE, PERCENT = 5, 80
CELLS, BLOCK = 1 << 18, 1 << 10
GROUP = 64
#: Rows of one token, or queries of one group, that one task gets.
TASK_ROWS = 2_000
#: Shingles of the sets that one task holds to count links.
TASK_TOKENS = 1 << 18


def sets_of(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, as signed 64-bit numbers."""
    out: list[np.ndarray] = []
    for a, b in W.slices(texts):
        found = W.Words(texts[a:b], W.NOT_SPACE, lower=True)
        grams, _ = W.windows(found.hashes, found.doc, size)
        for i in range(b - a):
            first, last = found.bounds[i], found.bounds[i + 1]
            n = last - first
            if n >= size:
                own = grams[first: last - size + 1]
            elif n:
                own, _ = W.windows(found.hashes[first:last], found.doc[first:last], int(n))
            else:
                own = grams[:0]
            own = np.sort(own.view(np.int64))
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
    return out


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) >> np.uint64(46)).astype(np.int64)


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set that is linked with it."""
    return -(-n * percent // 100)


def _count_cells(size: int):
    def run(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for own in sets_of(W.texts_of(batch.column("text")), size):
                np.add.at(counts, _cells(own), 1)
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([blocks[i].astype("<i4").tobytes() for i in used], pa.binary())],
            ["block", "counts"],
        )

    return run


def _add_blocks(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            add = np.frombuffer(counts, "<i4").astype(np.int64)
            sums[block] = sums[block] + add if block in sums else add
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
        ["block", "counts"],
    )


def token_cells(documents: DataFrame, size: int) -> np.ndarray:
    """How often each of ``CELLS`` classes of tokens occurs: 2 MB at any scale."""
    schema = "block int, counts binary"
    parts = documents.select("text").mapInArrow(_count_cells(size), schema)
    summed = parts.repartition(shuffle_partitions(documents.sparkSession), "block").mapInArrow(_add_blocks, schema)
    out = np.zeros((CELLS // BLOCK, BLOCK), np.int64)
    for block, counts in summed.collect():
        out[block] = np.frombuffer(counts, np.int64)
    return out.reshape(-1)


def first_tokens(own: np.ndarray, cells: np.ndarray, percent: int) -> np.ndarray:
    n = len(own)
    if not n:
        return own
    order = np.lexsort((own, cells[_cells(own)]))
    return own[order[: n - needed(n, percent) + 1]]


def _profile(size: int, percent: int, cells):
    def run(batches):
        table = cells.value
        for batch in batches:
            sets = sets_of(W.texts_of(batch.column("text")), size)
            firsts = [first_tokens(s, table, percent) for s in sets]
            n = np.array([len(s) for s in sets], np.int64)
            digest = np.array(
                [np.bitwise_xor.reduce(W.mixed(s.view(np.uint64))) for s in sets], np.uint64
            ).view(np.int64)
            total = np.array([s.view(np.uint64).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            values = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array(n),
                    pa.array(digest),
                    pa.array(total),
                    W.lists(values, np.array([len(f) for f in firsts], np.int64)),
                ],
                ["doc_id", "mark", "n", "d1", "d2", "firsts"],
            )

    return run


def _shared(batches):
    """Of rows sorted by (token, salt, doc), those of tokens with two documents,
    each with the least document; rows of salted tokens always."""
    before, pending, lead = None, False, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "salt", "doc", "n", "rest")]
        token, salt, doc = columns[:3]
        start = np.ones(len(token), bool)
        start[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        goes_on = before is not None and (token[0], salt[0]) == before[:2]
        group = np.cumsum(start) - 1
        leads = doc[start].copy()
        if goes_on:
            leads[0] = lead
        sizes = np.bincount(group)
        several = sizes > 1
        if goes_on:
            several[0] = True
        use = several[group] | (salt > 0)
        out = [*(c[use] for c in columns), leads[group[use]]]
        if goes_on and pending:
            # The first row of this group was the last of the batch before.
            out = [np.concatenate(([x], y)) for x, y in zip((*before, lead), out, strict=True)]
        pending = bool(sizes[-1] == 1 and not (goes_on and group[-1] == 0) and salt[-1] == 0)
        before, lead = tuple(c[-1] for c in columns), leads[-1]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["token", "salt", "doc", "n", "rest", "lead"]
        )


def packed_texts(batches):
    """Texts compressed for the shuffles: a third of the size of their sets."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = W.texts_of(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array([pack(t or b"") for t in texts], pa.binary())],
            ["doc", "mark", "packed"],
        )


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Group:
    """Members with their sets, and the union that bounds every overlap."""

    def __init__(self) -> None:
        self.members: list[tuple[int, np.ndarray]] = []
        self.union: np.ndarray | None = None

    def linked(self, doc: int, own: np.ndarray, percent: int, every: bool) -> list[int]:
        """Members linked with the set (the first, or ``every``), if the group has
        to be opened."""
        if self.union is None:
            self.union = np.unique(np.concatenate([s for _, s in self.members])) if self.members else own[:0]
        n = len(own)
        found: list[int] = []
        if common(own, self.union) < needed(n, percent):
            return found
        for member, theirs in self.members:
            small, large = sorted((n, len(theirs)))
            if member == doc or small < needed(large, percent):
                continue
            both = common(own, theirs)
            if 100 * both >= percent * (n + len(theirs) - both):
                found.append(member)
                if not every:
                    break
        return found


def _open_groups(size: int, percent: int):
    """Rows sorted by (grp, salt, role): members (-1 in a group of several
    components, else 0), then queries (1); yields links."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, group, several = None, Group(), False
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            a, b = [], []
            sets = sets_of([unpack(x) for x in batch.column("packed").to_pylist()], size)
            columns = [batch.column(c).to_pylist() for c in ("grp", "salt", "role", "doc")]
            for grp, salt, role, doc, own in zip(*columns, sets, strict=True):
                if at != (grp, salt):
                    at, group, several = (grp, salt), Group(), role < 0
                if role < 1:
                    group.members.append((doc, own))
                    continue
                for member in group.linked(doc, own, percent, several):
                    a.append(doc), b.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links_in_groups(
    work: Work, asked: DataFrame, members: DataFrame, texts: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links that queries ``asked`` (grp, doc) have in groups ``members`` (grp, doc, role)."""
    load = asked.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / TASK_ROWS).cast("int").alias("salts"))
    load = work.keep(load, "load")
    queries = spread_join(asked, load, ["grp"], "inner").select(
        "grp", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), "doc"
    )
    copies = members.join(load, "grp").select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "role", "doc"
    )
    rows = spread_join(queries.unionByName(copies), texts.select("doc", "packed"), ["doc"], "inner")
    parts = shuffle_partitions(work.spark)
    return (
        rows.repartition(parts, "grp", "salt")
        .sortWithinPartitions("grp", "salt", "role")
        .mapInArrow(_open_groups(size, percent), "a long, b long")
    )


class Overlaps:
    """Members by shingle, so that a set meets only those that share one with it."""

    def __init__(self, sets: list[np.ndarray], copies: list[int]):
        self.sizes, self.copies = np.array([len(s) for s in sets], np.int64), np.array(copies, np.int64)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.tokens, starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(starts, len(tokens))
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def linked(self, own: np.ndarray, percent: int, but: int | None = None) -> int:
        """Copies of the members linked with a set, other than member ``but``."""
        at = np.searchsorted(self.tokens, own)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == own]
        first, many = self.starts[at], self.starts[at + 1] - self.starts[at]
        each = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        both = np.bincount(self.owners[each], minlength=len(self.sizes))
        is_linked = 100 * both >= percent * (len(own) + self.sizes - both)
        if but is not None:
            is_linked[but] = False
        return int(self.copies[is_linked].sum())


def _count_links(size: int, percent: int):
    """Rows sorted by (root, chunk, salt, not member, doc, mark); yields how many
    documents are linked with each set that asks."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, last, index, members = None, None, None, []
        unpack = zstandard.ZstdDecompressor().decompress
        found: list[tuple[int, int, int]] = []

        def build():
            made = Overlaps([m[2] for m in members], [m[3] for m in members])
            found.extend((m[0], m[1], made.linked(m[2], percent, i)) for i, m in enumerate(members) if m[4])
            return made

        def batch_of():
            columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)] if found else [pa.array([], pa.int64())] * 3
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["doc", "mark", "linked"])

        # A few rows at a time: unpacked texts are several times their size.
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            sets = sets_of([unpack(x) for x in batch.column("packed").to_pylist()], size)
            names = ("root", "chunk", "salt", "doc", "mark", "copies", "member", "asks")
            columns = [batch.column(c).to_pylist() for c in names]
            for root, chunk, salt, doc, mark, copies, member, asks, own in zip(*columns, sets, strict=True):
                if at != (root, chunk, salt):
                    if members and index is None:
                        build()
                    at, last, index, members = (root, chunk, salt), None, None, []
                if last == (doc, mark):  # A repeated row.
                    continue
                last = (doc, mark)
                if member:
                    members.append((doc, mark, own, copies, asks))
                elif members:
                    index = index or build()
                    found.append((doc, mark, index.linked(own, percent)))
            yield batch_of()
        if members and index is None:
            build()
        yield batch_of()

    return run


def _link_counts(work: Work, sets: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """How many documents are linked with each set (doc, mark) by another set;
    ``sets`` has (doc, mark, n, copies, root)."""
    load = sets.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens")).filter("members > 1")
    load = load.select(
        "root",
        F.ceil(F.col("tokens") / TASK_TOKENS).cast("int").alias("chunks"),
        F.ceil(F.col("members") / TASK_ROWS).cast("int").alias("salts"),
    )
    home = spread_join(sets, load, ["root"], "inner").select(
        "*",
        F.pmod(F.xxhash64("doc", "mark"), F.col("chunks")).cast("int").alias("own"),
        F.pmod(F.xxhash64("mark", "doc"), F.col("salts")).cast("int").alias("dealt"),
    )

    def place(chunk, salt, member, asks):
        return F.struct(chunk.alias("chunk"), salt.alias("salt"), member.alias("member"), asks.alias("asks"))

    # A set asks each chunk once, and is a member of its own in every salt.
    yes, no = F.lit(True), F.lit(False)
    asking = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: place(c, F.col("dealt"), c == F.col("own"), yes)
    )
    copied = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("salts") - 1), lambda s: s != F.col("dealt")),
        lambda s: place(F.col("own"), s, yes, no),
    )
    placed = home.select("root", "doc", "mark", "copies", F.explode(F.concat(asking, copied)).alias("p"))
    placed = placed.select("root", "doc", "mark", "copies", "p.*")
    rows = spread_join(placed, texts, ["doc", "mark"], "inner")
    parts = shuffle_partitions(work.spark)
    return (
        rows.repartition(parts, "root", "chunk", "salt")
        .sortWithinPartitions("root", "chunk", "salt", ~F.col("member"), "doc", "mark")
        .mapInArrow(_count_links(size, percent), "doc long, mark long, linked long")
        .groupBy("doc", "mark")
        .agg(F.sum("linked").alias("linked"))
    )


def similar_documents(
    documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT, count_links: bool = True
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links.

    ``n_links`` is the number of other documents linked with this one, those with
    the same set included. Of documents with several texts under one id, each
    set counts as one. Without ``count_links`` there is no such column.
    """
    spark = documents.sparkSession
    work = Work(spark, "similar")
    # Tells texts under one id apart, for the count of links.
    mark = F.xxhash64("text") if count_links else F.lit(0).cast("long")
    docs = documents.select("doc_id", "text", mark.alias("mark"))
    cells = spark.sparkContext.broadcast(token_cells(docs, size))
    mean = float(cells.value.sum()) / CELLS
    profile = work.keep(
        docs.mapInArrow(
            _profile(size, percent, cells), "doc_id long, mark long, n long, d1 long, d2 long, firsts array<long>"
        ),
        "profile",
    )

    # 1. One document for each set.
    same = profile.filter("doc_id IS NOT NULL AND n > 0")
    first = F.min(F.struct("doc_id", "mark")).alias("first")
    rep = same.groupBy("n", "d1", "d2").agg(first).select("n", "d1", "d2", F.col("first.doc_id").alias("rep"), F.col("first.mark").alias("mark"))
    reps = work.keep(
        spread_join(same.select("doc_id", "n", "d1", "d2"), rep, ["n", "d1", "d2"], "inner").select("doc_id", "n", "rep", "mark"),
        "reps",
    )

    # 2. Tokens that several documents have among their first.
    tokens = same.select(F.col("doc_id").alias("doc"), "n", F.posexplode("firsts").alias("pos", "token"))
    tokens = tokens.select("doc", "n", (F.col("n") - F.col("pos")).alias("rest"), "token")
    tokens = tokens.mapInArrow(_salted(cells, mean), "doc long, n long, rest long, token long, salt int")
    parts = shuffle_partitions(spark)
    met = work.keep(
        tokens.repartition(parts, "token", "salt")
        .sortWithinPartitions("token", "salt", "doc")
        .mapInArrow(_shared, "token long, salt int, doc long, n long, rest long, lead long"),
        "met",
    )
    own = reps.filter("doc_id = rep").select(F.col("doc_id").alias("doc")).distinct()
    all_met, met = met, work.keep(spread_join(met, own, ["doc"], "left_semi"), "met")
    counts = work.keep(profile.select("doc_id", "n"), "counts")
    work.drop(all_met, profile)

    # 3. Each document with the least one it shares most of its tokens with.
    shares = met.filter("doc <> lead").groupBy("doc", "lead").count()
    best = shares.groupBy("doc").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("grp"))
    salted = met.filter("salt > 0").select("token", "lead").distinct()
    leads = salted.groupBy("token").agg(F.min("lead").alias("grp"))
    across = spread_join(salted, leads, ["token"], "inner").filter("lead <> grp").select(F.col("lead").alias("doc"), "grp")
    best = work.keep(best, "best")
    asked = work.keep(best.select("doc", "grp").unionByName(across).distinct(), "asked")
    wanted = met.select("doc").distinct()
    packed = docs.filter("doc_id IS NOT NULL").mapInArrow(packed_texts, "doc long, mark long, packed binary")
    texts = work.keep(packed.join(wanted, "doc", "left_semi"), "texts")
    alone = asked.select("grp").distinct().select("grp", F.col("grp").alias("doc"), F.lit(0).alias("role"))
    links = work.keep(links_in_groups(work, asked, alone, texts, size, percent), "links")
    roots = work.keep(components(work, links), "roots")

    # 4. Tokens that join different components: the matrix.
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    known = spread_join(roots, sizes, ["root"], "inner").select(F.col("node").alias("doc"), "root", "members")
    placed = work.keep(
        spread_join(met.select("token", "doc", "n", "rest"), known, ["doc"], "left").select(
            "token", "doc", "n", "rest", F.coalesce("root", "doc").alias("root"), F.coalesce("members", F.lit(1)).alias("members")
        ),
        "placed",
    )
    mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    between = spread_join(placed, mixed.select("token"), ["token"], "left_semi")
    between = work.keep(between, "between")
    # Large components are cut into groups; small ones join those with their lead.
    found = between.select("doc", "root", "members").distinct()
    led = spread_join(found, best.select("doc", F.col("grp").alias("led")), ["doc"], "left")
    small = F.col("members") < GROUP
    led = led.withColumn("kind", F.when(small, F.coalesce("led", "root")).otherwise(F.col("root")))
    led = work.keep(led.select("doc", "root", "members", small.alias("small"), "kind"), "led")
    chunks = led.groupBy("small", "kind").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("chunks"))
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks"))
    groups = work.keep(
        spread_join(led, chunks, ["small", "kind"], "inner").select(
            "doc", F.xxhash64("small", "kind", chunk).alias("grp"), F.when(F.col("small"), -1).otherwise(0).alias("role")
        ),
        "groups",
    )
    placed = spread_join(between, groups.select("doc", "grp"), ["doc"], "inner")
    matrix = placed.groupBy("token", "grp").agg(
        F.max(F.struct("members", "root")).alias("top"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max("rest").alias("rest"),
    )
    queries = between.select("token", "doc", "n", "rest", "root", "members")
    m = {c: F.col(f"m.{c}") for c in matrix.columns}
    q = {c: F.col(f"q.{c}") for c in queries.columns}
    asked = (
        queries.alias("q")
        .join(
            matrix.alias("m"),
            (q["token"] == m["token"])
            & (F.struct(q["members"], q["root"]) < m["top"])
            & (100 * m["most"] >= percent * q["n"])
            & (percent * m["least"] <= 100 * q["n"]),
        )
        .select(m["grp"].alias("grp"), q["doc"].alias("doc"))
        .distinct()
    )
    asked = work.keep(asked, "asked")
    more = work.keep(links_in_groups(work, asked, groups, texts, size, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = work.keep(components(work, links), "roots")

    # Back to all rows.
    reach = roots.select(F.col("node").alias("rep"), "root")
    entries = reps.select("doc_id", "n", "rep", "mark").distinct()
    if not count_links:
        of_doc = spread_join(entries, reach, ["rep"], "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("reached"))
        return counts.join(work.keep(of_doc, "of_doc"), "doc_id", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("reached", "doc_id").alias("component_id")
        )

    # 5. Links inside the components.
    copies = entries.groupBy("rep", "mark", "n").agg(F.count(F.lit(1)).alias("copies"))
    sets = work.keep(spread_join(copies, reach, ["rep"], "left").withColumnRenamed("rep", "doc"), "sets")
    linked = _link_counts(work, sets.filter("root IS NOT NULL"), texts, size, percent)
    of_set = sets.join(work.keep(linked, "linked"), ["doc", "mark"], "left").select(
        F.col("doc").alias("rep"), "mark", "root", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links")
    )
    of_doc = (
        spread_join(entries, of_set, ["rep", "mark"], "inner")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("root", "rep")).alias("reached"), F.sum("links").alias("links"))
    )
    return counts.join(work.keep(of_doc, "of_doc"), "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("reached", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )


def _salted(cells, mean: float):
    """Tokens of very full cells are dealt to several tasks by document."""

    def run(batches):
        table = cells.value
        salts = np.maximum(1, np.ceil((table - 4 * mean) / TASK_ROWS)).astype(np.int64)
        for batch in batches:
            token = batch.column("token").to_numpy(zero_copy_only=False)
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            many = salts[_cells(token)]
            salt = (W.mixed(doc.view(np.uint64)) % many.astype(np.uint64)).astype(np.int64) + (many > 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "n", "rest", "token")), pa.array(salt, pa.int32())],
                ["doc", "n", "rest", "token", "salt"],
            )

    return run


def op3_similar(documents: DataFrame) -> DataFrame:
    return similar_documents(documents)
