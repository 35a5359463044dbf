"""Reconciliation of two tables that are mostly equal, by digests in levels.

``reconcile.compare_tables`` shuffles every row of both tables. Here rows are
dealt to buckets by the hash of their key, and a bucket is known by its number of
rows and four sums of parts of two row hashes, which do not depend on order and
count repeated rows. Tasks add the sums up, so the shuffle holds a row for each
task and bucket. Buckets that agree are equal and are left alone; those that do
not are looked at again with more bits, and only rows of the last unequal
buckets are shuffled and compared, column by column.

Tables without a difference thus cost one scan each and no shuffle of rows; one
changed row costs two more scans and a bucket of rows. The list of unequal
buckets on the driver is limited by the number of buckets of the first level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.reconcile import _LEFT, _RIGHT, compare_tables

#: Bits of a bucket's number on each level.
LEVELS = (10, 20)
SIDE = "found_in"
_BUCKET, _SUMS = "_bucket", ("_s0", "_s1", "_s2", "_s3")


def _bucket(key: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)


def _halves(columns: Sequence[str]) -> list[Column]:
    """Four numbers of 32 bits of a row; which columns are NULL is part of it."""
    holes = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), holes, *columns)
        out += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    return out


def bucket_digests(df: DataFrame, key: Sequence[str], bits: int) -> DataFrame:
    """A row for each bucket: its number of rows, and the sums."""
    parts = _halves(df.columns)
    rows = df.select(_bucket(key, bits).alias(_BUCKET), *[p.alias(s) for p, s in zip(parts, _SUMS, strict=True)])
    return rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in _SUMS])


def unequal_buckets(left: DataFrame, right: DataFrame, key: Sequence[str], bits: int) -> DataFrame:
    """Buckets that are not the same on both sides."""
    values = F.struct("_n", *_SUMS)
    here = bucket_digests(left, key, bits).select(_BUCKET, values.alias("_here"))
    there = bucket_digests(right, key, bits).select(_BUCKET, values.alias("_there"))
    return here.join(there, _BUCKET, "full_outer").filter(~F.col("_here").eqNullSafe(F.col("_there"))).select(_BUCKET)


def differing_rows(
    left: DataFrame, right: DataFrame, key: Sequence[str] = (), levels: Sequence[int] = LEVELS
) -> DataFrame:
    """Distinct rows that only one side has, with ``found_in`` left or right.

    Without a ``key`` all columns are the key; a changed row is then in two
    buckets. Rows are compared as set operations do: repeated rows count once and
    NULLs are equal.
    """
    columns, key = left.columns, list(key) or left.columns
    right = right.select(*columns)
    first, *more = levels
    # One number a bucket of the first level at most.
    found = sorted(r[0] for r in unequal_buckets(left, right, key, first).collect())
    if not found:
        return left.limit(0).select(*columns, F.lit("left").alias(SIDE))
    suspect = _bucket(key, first).isin(found)
    left, right = left.filter(suspect), right.filter(suspect)
    for bits in more:
        unequal = unequal_buckets(left, right, key, bits)
        left, right = (
            df.withColumn(_BUCKET, _bucket(key, bits)).join(unequal, _BUCKET, "left_semi").select(*columns)
            for df in (left, right)
        )
    here, there = F.col(_LEFT), F.col(_RIGHT)
    return (
        compare_tables(left, right)
        .filter(here != there)
        .select(*columns, F.when(here, "left").otherwise("right").alias(SIDE))
    )
