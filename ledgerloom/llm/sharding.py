"""Sharding by extendible hashing.

A document's key is the first 48 bits of the MD5 of its id. The directory knows
shards by a prefix of the key; a shard over ``limit`` bytes of text is split on
the next bit, others stay. So a shard is the shortest prefix whose documents fit.
Bits are taken in blocks of twelve: one aggregation by the longest prefix of a
block gives the bytes of all shorter ones, and only documents in shards that are
still too large go on to the next block. The directory stays a table.

Documents that share the whole key (rows with one doc_id) cannot be parted by
bits; they go to numbered overflow pages of the last prefix, each of equal rows
and no larger than the limit. A single text over the limit is a page by itself.

Defined cases: NULL is a text of no bytes; a missing doc_id is hashed as empty;
equal rows are interchangeable, so which of them lies on which page is not told
apart; an empty table has no shards; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.work import Work
from ledgerloom.operators.lookup import numbered_copies

BITS, BLOCK = 48, 12
SHARD_BYTES = 1 << 20


def _prefix(bits: int, column: str = "_key", length: int = BITS) -> Column:
    return F.shiftright(F.col(column), length - bits)


def sharded(documents: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``documents`` with n_bytes, depth, shard (the prefix) and page."""
    spark = documents.sparkSession
    work = Work(spark, "sharding")
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = documents.select("*", key.cast("long").alias("_key"), size.alias("_bytes"))

    open_keys = rows.select("_key", "_bytes")
    placed: DataFrame | None = None
    for base in range(0, BITS, BLOCK):
        fine = base + BLOCK
        sums = work.keep(open_keys.groupBy(_prefix(fine).alias("fine")).agg(F.sum("_bytes").alias("bytes")), "sums")
        depths = F.explode(F.sequence(F.lit(base and base + 1), F.lit(fine))).alias("depth")
        each = sums.select("fine", "bytes", depths).withColumn("shard", F.expr(f"shiftright(fine, {fine} - depth)"))
        fits = each.groupBy("depth", "shard").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") <= limit)
        best = each.drop("bytes").join(fits, ["depth", "shard"]).groupBy("fine").agg(F.min(F.struct("depth", "shard")).alias("at"))
        settled = work.keep(sums.select("fine").join(best, "fine", "left"), "directory")
        here = (
            rows.withColumn("fine", _prefix(fine))
            .join(settled.filter("at IS NOT NULL"), "fine")
            .select("*", F.col("at.depth").alias("_depth"), F.col("at.shard").alias("_shard"), F.lit(0).cast("long").alias("_page"))
            .drop("fine", "at")
        )
        placed = here if placed is None else placed.unionByName(here)
        too_large = settled.filter("at IS NULL").select("fine")
        if too_large.isEmpty():
            break
        rows = rows.withColumn("fine", _prefix(fine)).join(too_large, "fine", "left_semi").drop("fine")
        open_keys = rows.select("_key", "_bytes")
    else:
        placed = placed.unionByName(_overflow(rows, limit))
    return placed.select(
        *documents.columns,
        F.col("_bytes").alias("n_bytes"),
        F.col("_depth").cast("int").alias("depth"),
        F.col("_shard").alias("shard"),
        F.col("_page").alias("page"),
    )


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of one key each, in pages: pages of one text are numbered from 0 and
    told apart from those of another text by a hash in the upper bits."""
    equal = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_rows"))
    alone = F.count(F.lit(1)).alias("texts")
    keys = rows.select("_key", F.xxhash64("text").alias("_text_hash")).distinct().groupBy("_key").agg(alone)
    fit = F.greatest(F.floor(F.lit(limit) / F.greatest(F.col("_bytes"), F.lit(1))), F.lit(1))
    copies = numbered_copies(equal, "_rows", ["_key"]).join(keys, "_key")
    own = F.when(F.col("texts") > 1, F.shiftleft(F.pmod(F.xxhash64("text"), F.lit(1 << 30)), 32)).otherwise(F.lit(0))
    return copies.select(
        *rows.columns,
        F.lit(BITS).alias("_depth"),
        F.col("_key").alias("_shard"),
        (own + F.floor((F.col("_copy") - 1) / fit)).cast("long").alias("_page"),
    )


def write_shards(documents: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """One folder for each shard; shards are dealt to tasks by their number."""
    out = sharded(documents, limit)
    out.hint("rebalance", "depth", "shard", "page").write.partitionBy("depth", "shard", "page").parquet(path)


def op4_sharding(documents: DataFrame) -> DataFrame:
    return sharded(documents.select("doc_id", "text")).select("doc_id", "n_bytes", "depth", "shard", "page")


OP4_SQL = f"""
WITH keys AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {BITS // 4}))::BIGINT AS k,
         coalesce(octet_length(encode(text)), 0) AS n_bytes
  FROM documents
), prefixes AS (
  SELECT doc_id, n_bytes, d.depth, k >> ({BITS} - d.depth) AS shard
  FROM keys, (SELECT unnest(range(0, {BITS + 1}))::INTEGER AS depth) d
), sizes AS (
  SELECT depth, shard, sum(n_bytes) AS bytes FROM prefixes GROUP BY depth, shard
)
SELECT p.doc_id, p.n_bytes, min(p.depth) AS depth, arg_min(p.shard, p.depth) AS shard, 0::BIGINT AS page
FROM prefixes p JOIN sizes s ON s.depth = p.depth AND s.shard = p.shard
WHERE s.bytes <= {SHARD_BYTES} OR p.depth = {BITS}
GROUP BY p.doc_id, p.n_bytes
"""
