"""Prefix trie of conversations by ROLLUP over positional turn columns.

A node of depth d stands for the first d turns (role, text) that one or more
conversations, its members, have in common. A node is named by its smallest
member and its depth.

1. Turns are put in order by a range-partitioned sort; a turn's place is its
   place within its task plus what the tasks before hold of its conversation. A
   turn is known by 128 bits of the SHA-256 of its role and text.
2. Each conversation becomes blocks of ``BLOCK`` positional columns. A block
   carries the key of the node at which the block before ended: the XOR of two
   64-bit hashes of every block so far, each with its number.
3. ``GROUP BY block, prior node, ROLLUP (t0, ..., t7)`` gives the nodes of all
   depths at once, told apart by grouping_id: smallest member, number of members
   and code points before the node.
4. Sums over subtrees need no walk over the trie. Walking down, a conversation is
   a node's smallest member from some depth on. What a conversation saves is the
   text above that depth, so a subtree saves the sum over its members, less what
   lies above its top. Its leaves are the members that are the smallest of a
   childless node. A second ROLLUP adds both up.

No conversation, node or list has to fit one task: ranges and blocks split long
conversations, and members of a node are listed in sorted chunks, of which only
the joined text passes through the digest.

Defined cases: turns are ordered by turn (NULL first), then role, then text; a
NULL role or text is empty; repeated rows are turns of their own; rows without a
conv_id belong to no conversation; a table without conversations gives no node;
other columns are not read. ``c % 100`` has the sign of c.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.work import Work, shuffle_partitions
from ledgerloom.operators.lookup import spread_join

BLOCK = 8
#: Blocks that one window holds; longer conversations have several.
STRETCH = 1024
#: The first turns of a base conversation that others may take over.
OPENING, FAMILY = 5, 100
NO_ENDS = hashlib.sha256().hexdigest()


def _half(digest: str, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def _local_places(batches):
    """Place of each row among the rows of its conversation in this task."""
    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        carried = count if conv[0] == last else 0
        starts = np.flatnonzero(new)
        place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
        place[: starts[1] if len(starts) > 1 else len(conv)] += carried
        last, count = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                pa.array(np.full(len(conv), part, np.int32)),
                pa.array(place + 1),
                *(batch.column(c) for c in ("a", "b", "chars")),
            ],
            ["conv_id", "part", "local", "a", "b", "chars"],
        )


def ordered_turns(work: Work, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, a, b, chars) in order, and (conv_id, n) of all
    conversations."""
    parts = shuffle_partitions(work.spark)
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role, text, F.monotonically_increasing_id().alias("row")
    )
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    # The row number only deals out repeated rows, of which there may be many.
    keys = ["conv_id", "turn", "role", "text", "row"]
    local = work.keep(
        turns.withColumn("digest", digest)
        .withColumn("chars", F.length("text").cast("long"))
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select("conv_id", _half("digest", 1).alias("a"), _half("digest", 17).alias("b"), "chars")
        .mapInArrow(_local_places, "conv_id long, part int, local long, a long, b long, chars long"),
        "local",
    )
    counts = work.keep(local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a task can have turns in tasks before it, so
    # there is at most one row a task.
    moved = counts.select("conv_id", "part", F.sum("n").over(before).alias("moved")).filter("moved > 0")
    placed = local.join(F.broadcast(moved), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("local") + F.coalesce("moved", F.lit(0))).alias("depth"), "a", "b", "chars"
    )
    return placed, work.keep(counts.groupBy("conv_id").agg(F.sum("n").alias("n")), "sizes")


def rebuilt(placed: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first h turns of their family's base,
    h = crc32(conv_id) % 6, and go on with their own turns after the first h."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = F.crc32(F.col("conv_id").cast("string")) % (OPENING + 1)
    bases = sizes.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.least("n", F.lit(OPENING)).alias("offered")
    )
    convs = sizes.select("conv_id", "n", base.alias("base"), h.alias("h")).join(bases, "base", "left")
    convs = convs.select("conv_id", "n", "base", "h", F.least("h", F.coalesce("offered", F.lit(0))).alias("taken"))
    opening = placed.filter((F.col("conv_id") % FAMILY == 0) & (F.col("depth") <= OPENING)).select(
        F.col("conv_id").alias("base"), "depth", "a", "b", "chars"
    )
    taken = convs.filter("taken > 0").join(opening, "base").filter("depth <= taken")
    short = convs.filter("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("lack"))
    own = spread_join(placed.filter(F.col("depth") > h), short, ["conv_id"], "left")
    own = own.withColumn("depth", F.col("depth") - F.coalesce("lack", F.lit(0)))
    columns = ["conv_id", "depth", "a", "b", "chars"]
    lengths = convs.select(
        "conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")
    )
    return own.select(*columns).unionByName(taken.select(*columns)), lengths


def _slots(name: str) -> list[str]:
    return [f"{name}{k}" for k in range(BLOCK)]


def _mark(seed: int, slots: int) -> Column:
    """Hash of the first ``slots`` turns of a block; missing turns leave it as it is."""
    return F.xxhash64(F.lit(seed), "block", *_slots("t")[:slots])


def blocks_of(work: Work, turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Rows (conv_id, block, k1, k2, t0..t7, filled, q0..q8): the positional turn
    ids of each block, the node before it, and the code points before each slot."""
    root = lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(None).cast("long").alias(c) for c in ("a", "b", "chars")))
    block = F.greatest(F.floor((F.col("depth") - 1) / BLOCK), F.lit(0)).cast("long")
    slot = F.when(F.col("depth") > 0, (F.col("depth") - 1) % BLOCK)
    rows = turns.unionByName(root).select(
        "conv_id", block.alias("block"), slot.alias("slot"), F.floor(block / STRETCH).alias("stretch"), "a", "b", "chars"
    )
    # One exchange serves the pivot and the window after it.
    rows = rows.repartition("conv_id", "stretch")
    cells = [
        F.max(F.when(F.col("slot") == k, F.col(c))).alias(f"{c}{k}") for c in ("a", "b", "chars") for k in range(BLOCK)
    ]
    wide = rows.groupBy("conv_id", "stretch", "block").agg(*cells, F.count("slot").alias("filled"))
    ids = [F.when(F.col(f"a{k}").isNotNull(), F.struct(f"a{k}", f"b{k}")).alias(f"t{k}") for k in range(BLOCK)]
    sums, total = [], F.lit(0).cast("long")
    for k in range(BLOCK):
        sums.append(total.alias(f"q{k}"))
        total = total + F.coalesce(f"chars{k}", F.lit(0))
    wide = wide.select("conv_id", "stretch", "block", "filled", *ids, *sums, total.alias(f"q{BLOCK}"))
    before = Window.partitionBy("conv_id", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(c):
        return F.coalesce(c.over(before), F.lit(0))

    run = wide.withColumn("m1", _mark(1, BLOCK)).withColumn("m2", _mark(2, BLOCK)).select(
        "*",
        so_far(F.bit_xor("m1")).alias("k1"),
        so_far(F.bit_xor("m2")).alias("k2"),
        so_far(F.sum(f"q{BLOCK}")).alias("above"),
    )
    run = work.keep(run, "stretches")
    # Conversations of more than STRETCH blocks: totals of the stretches before.
    totals = run.groupBy("conv_id", "stretch").agg(
        F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"), F.sum(f"q{BLOCK}").alias("q")
    )
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    long = totals.join(totals.filter("stretch > 0").select("conv_id").distinct(), "conv_id", "left_semi")
    carry = long.select(
        "conv_id",
        "stretch",
        F.bit_xor("m1").over(earlier).alias("c1"),
        F.bit_xor("m2").over(earlier).alias("c2"),
        F.sum("q").over(earlier).alias("cq"),
    ).filter("stretch > 0")
    far = spread_join(run.filter("stretch > 0"), carry, ["conv_id", "stretch"], "inner")
    far = far.withColumns({
        "k1": F.col("k1").bitwiseXOR(F.col("c1")),
        "k2": F.col("k2").bitwiseXOR(F.col("c2")),
        "above": F.col("above") + F.col("cq"),
    })
    columns = ["conv_id", "block", "filled", "k1", "k2", *_slots("t"), *(f"q{k}" for k in range(BLOCK + 1)), "above"]
    every = run.filter("stretch = 0").select(*columns).unionByName(far.select(*columns))
    placed = {f"q{k}": F.col(f"q{k}") + F.col("above") for k in range(BLOCK + 1)}
    return work.keep(every.withColumns(placed).drop("above"), "blocks")


def _rollup(blocks: DataFrame, measures: str) -> DataFrame:
    """All prefixes of all blocks at once; ``level`` turns of the block are given."""
    t = ", ".join(_slots("t"))
    ends = " OR ".join([f"(level = {k + 1} AND t{k} IS NOT NULL)" for k in range(BLOCK)])
    grouped = blocks.sparkSession.sql(
        f"""
        SELECT block, k1, k2, {t}, {BLOCK} - bit_count(grouping_id()) AS level,
               min(conv_id) AS rep, {measures}
        FROM {{blocks}}
        GROUP BY block, k1, k2, ROLLUP ({t})
        """,
        blocks=blocks,
    )
    return grouped.filter(f"{ends} OR (level = 0 AND block = 0)")


def _by_level(values: list[Column]) -> Column:
    out = F.when(F.col("level") == 0, values[0])
    for level, value in enumerate(values[1:], 1):
        out = out.when(F.col("level") == level, value)
    return out


def _chunks(batches):
    """Sorted (rep, depth, conv_id) to comma-joined ids, a row for each node of a
    batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rep, depth, conv = (batch.column(c).to_numpy() for c in ("rep", "depth", "conv_id"))
        new = np.ones(len(rep), bool)
        new[1:] = (rep[1:] != rep[:-1]) | (depth[1:] != depth[:-1])
        starts = np.flatnonzero(new)
        names = batch.column("conv_id").cast(pa.string()).to_pylist()
        stops = [*starts[1:].tolist(), len(rep)]
        joined = [",".join(names[a:b]) for a, b in zip(starts.tolist(), stops, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[starts]), pa.array(depth[starts]), pa.array(conv[starts]), pa.array(joined, pa.string())],
            ["rep", "depth", "first", "ids"],
        )


def _digests(batches):
    """Chunks sorted by (rep, depth, first): one digest a node, chunk by chunk."""
    at, sha = None, None

    def row(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["rep", "depth", "ends"]
        )

    for batch in batches:
        done = []
        for rep, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("rep", "depth", "ids")), strict=True):
            if at == (rep, depth):
                sha.update(b"," + ids.encode())
                continue
            if at is not None:
                done.append((*at, sha.hexdigest()))
            at, sha = (rep, depth), hashlib.sha256(ids.encode())
        yield row(done)
    if at is not None:
        yield row([(*at, sha.hexdigest())])


def ends_digest(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids that end at each node (rep, depth)."""
    parts = shuffle_partitions(ended.sparkSession)
    chunks = (
        ended.select("rep", "depth", "conv_id")
        .repartitionByRange(parts, "rep", "depth", "conv_id")
        .sortWithinPartitions("rep", "depth", "conv_id")
        .mapInArrow(_chunks, "rep long, depth long, first long, ids string")
    )
    return (
        chunks.repartition(parts, "rep", "depth")
        .sortWithinPartitions("rep", "depth", "first")
        .mapInArrow(_digests, "rep long, depth long, ends string")
    )


def trie_nodes(work: Work, turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, depth, a, b, chars) of the
    conversations ``lengths`` (conv_id, n)."""
    lengths = work.keep(lengths, "lengths")
    blocks = blocks_of(work, turns, lengths)

    # Nodes, each with its key and that of its parent.
    depth = (F.col("block") * BLOCK + F.col("level")).cast("long")
    nodes = _rollup(blocks, "count(*) AS n_convs, " + ", ".join(f"max(q{k}) AS q{k}" for k in range(BLOCK)))

    def key(seed, cut):
        prior = F.col(f"k{seed}")
        return _by_level([prior, *(prior if k == cut else prior.bitwiseXOR(_mark(seed, k - cut)) for k in range(1, BLOCK + 1))])

    nodes = work.keep(
        nodes.select(
            "rep",
            depth.alias("depth"),
            "n_convs",
            _by_level([F.lit(0).cast("long"), *(F.col(f"q{k}") for k in range(BLOCK))]).alias("above"),
            key(1, 0).alias("n1"), key(2, 0).alias("n2"), key(1, 1).alias("p1"), key(2, 1).alias("p2"),
        ),
        "nodes",
    )
    names = nodes.select("depth", "n1", "n2", "rep")
    over = names.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("rep").alias("parent"))
    linked = spread_join(nodes.select("rep", "depth", "n_convs", "above", "p1", "p2"), over, ["depth", "p1", "p2"], "left")
    linked = work.keep(linked.select("rep", "depth", "n_convs", "above", "parent"), "linked")
    children = linked.filter("parent IS NOT NULL").groupBy(
        F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    children = work.keep(children, "children")

    # Conversations: where they end, and what is above their own part.
    last = F.greatest(F.floor((F.col("n") - 1) / BLOCK), F.lit(0)).cast("long")
    tails = lengths.select("conv_id", "n", last.alias("block")).join(blocks, ["conv_id", "block"])
    tails = tails.withColumn("level", F.col("filled").cast("int")).select(
        "conv_id", F.col("n").alias("depth"), F.col(f"q{BLOCK}").alias("total"), key(1, 0).alias("n1"), key(2, 0).alias("n2")
    )
    ended = work.keep(
        spread_join(tails, names, ["depth", "n1", "n2"], "inner").select("rep", "depth", "conv_id", "total"), "ended"
    )
    branches = linked.filter("parent IS NULL OR parent <> rep").select(F.col("rep").alias("conv_id"), F.col("above").alias("shared"))
    branches = work.keep(branches, "branches")
    leaves = ended.filter("rep = conv_id").join(children.select("rep", "depth"), ["rep", "depth"], "left_anti")
    own = (
        ended.select("conv_id", "total")
        .join(branches, "conv_id", "left")
        .join(leaves.select("conv_id", F.lit(1).cast("long").alias("leaf")), "conv_id", "left")
        .select("conv_id", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    )
    own = work.keep(own, "own")
    measured = spread_join(blocks.select("conv_id", "block", "k1", "k2", *_slots("t")), own, ["conv_id"], "inner")
    sums = _rollup(measured, "sum(shared) AS shared, sum(leaf) AS n_leaves").select("rep", depth.alias("depth"), "shared", "n_leaves")

    # Of a node's members all but the smallest save what they share from it down.
    top = branches.select(F.col("conv_id").alias("rep"), F.col("shared").alias("of_rep"))
    saved = F.col("shared") - F.col("of_rep") - (F.col("n_convs") - 1) * F.col("above")
    return (
        spread_join(linked, top, ["rep"], "inner")
        .join(sums, ["rep", "depth"])
        .join(children, ["rep", "depth"], "left")
        .join(ends_digest(ended), ["rep", "depth"], "left")
        .select(
            F.col("rep").alias("conv_id"),
            "depth",
            F.col("parent").alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            saved.alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations as they are."""
    work = Work(conversations.sparkSession, "trie")
    return trie_nodes(work, *ordered_turns(work, conversations))


def op13_prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    work = Work(conversations.sparkSession, "trie")
    placed, sizes = ordered_turns(work, conversations)
    return trie_nodes(work, *rebuilt(placed, sizes))


#: crc32 is the bitwise division by the reflected polynomial, byte by byte.
OP13_SQL = """
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT conv_id, list_reduce(
        [4294967295::UBIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::UBIGINT),
        lambda acc, ch: list_reduce([xor(acc, ch)] || [0::UBIGINT FOR i IN range(8)],
            lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::UBIGINT) ELSE r // 2 END)) AS inverted
    FROM (SELECT DISTINCT conv_id FROM own)
), convs AS (
    SELECT conv_id, (xor(inverted, 4294967295::UBIGINT) % 6)::BIGINT AS h FROM crc
), rebuilt AS (
    SELECT c.conv_id, o.place AS spot, o.role, o.text
    FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.place <= c.h
    UNION ALL
    SELECT c.conv_id, 1000 + o.place, o.role, o.text
    FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h
), seq AS (
    SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
           list({'r': role, 't': text}) OVER w AS path
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY spot)
), steps AS (
    SELECT conv_id, depth, chars, path::VARCHAR AS path FROM seq
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), lengths AS (
    SELECT conv_id, max(depth) AS n FROM steps GROUP BY conv_id
), nodes AS (
    SELECT path, depth, min(conv_id) AS rep, count(*) AS n_convs, any_value(chars) AS chars FROM steps GROUP BY path, depth
), named AS (
    SELECT s.conv_id, s.depth, n.rep, n.n_convs, n.chars FROM steps s JOIN nodes n USING (path, depth)
), edges AS (
    SELECT DISTINCT c.rep, c.depth, p.rep AS parent FROM named c JOIN named p ON p.conv_id = c.conv_id AND p.depth = c.depth - 1
), children AS (
    SELECT parent AS rep, depth - 1 AS depth, count(*) AS n_children FROM edges GROUP BY 1, 2
), below AS (
    SELECT DISTINCT a.rep, a.depth, b.rep AS brep, b.depth AS bdepth, b.n_convs, b.chars
    FROM named a JOIN named b ON b.conv_id = a.conv_id AND b.depth >= a.depth
), sums AS (
    SELECT b.rep, b.depth, count(*) FILTER (WHERE c.rep IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.chars) AS saved
    FROM below b LEFT JOIN children c ON c.rep = b.brep AND c.depth = b.bdepth GROUP BY 1, 2
), ends AS (
    SELECT n.rep, n.depth, sha256(string_agg(n.conv_id::VARCHAR, ',' ORDER BY n.conv_id)) AS ends
    FROM named n JOIN lengths l ON l.conv_id = n.conv_id AND l.n = n.depth GROUP BY 1, 2
)
SELECT n.rep AS conv_id, n.depth::BIGINT AS depth, e.parent AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, coalesce(x.ends, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN edges e ON e.rep = n.rep AND e.depth = n.depth
LEFT JOIN children c ON c.rep = n.rep AND c.depth = n.depth
JOIN sums s ON s.rep = n.rep AND s.depth = n.depth
LEFT JOIN ends x ON x.rep = n.rep AND x.depth = n.depth
"""
