"""Reconciliation by digests: the rows of the set operations, and little shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import digest_tree as D
from ledgerloom.operators import reconcile as R

SCHEMA = "k long, a string, b double"


def sides(left, right):
    here = [(*r, "left") for r in R.only_left(left, right).collect()]
    return sorted(here + [(*r, "right") for r in R.only_right(left, right).collect()], key=str)


@pytest.mark.parametrize("key", [["k"], []])
@pytest.mark.parametrize("levels", [(2,), (2, 4), (10, 20)])
def test_equals_set_operations(spark, key, levels):
    rng = random.Random(7)
    base = [(rng.choice([None, *range(60)]), rng.choice(["x", "y", None]), rng.choice([None, 0.5, 1.0])) for _ in range(200)]
    other = [r for r in base if rng.random() < 0.9] + [(i, "new", None) for i in range(55, 70)] + base[:40]
    left, right = (spark.createDataFrame(rows, SCHEMA) for rows in (base, other))
    got = D.differing_rows(left, right.select("b", "k", "a"), key, levels)
    assert got.columns == ["k", "a", "b", D.SIDE]
    assert sorted(map(tuple, got.collect()), key=str) == sides(left, right)


def test_repeated_rows_and_nulls_are_no_difference(spark):
    left = spark.createDataFrame([(1, None, None), (1, None, None), (2, "a", 0.0), (None, None, None)], SCHEMA)
    right = spark.createDataFrame([(1, None, None), (2, "a", 0.0), (2, "a", 0.0), (None, None, None)], SCHEMA)
    assert D.differing_rows(left, right, ["k"]).collect() == []
    # NULL in another column, or an empty text, is a difference.
    moved = spark.createDataFrame([(1, "", None), (2, "a", 0.0), (None, None, None)], SCHEMA)
    assert sorted(r.found_in for r in D.differing_rows(left, moved, ["k"]).collect()) == ["left", "right"]


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    assert D.differing_rows(none, none).collect() == []
    assert [tuple(r) for r in D.differing_rows(one, none, ["k"]).collect()] == [(1, "a", 1.0, "left")]
    assert [tuple(r) for r in D.differing_rows(none, one, ["k"]).collect()] == [(1, "a", 1.0, "right")]


def test_only_rows_of_unequal_buckets_are_compared(spark):
    """One changed row of many: the leaves hold a bucket, a third of all rows under
    one key included."""
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").cast("string").alias("a"), F.lit(1.0).alias("b")
    )
    right = left.withColumn("b", F.when(F.col("k") == 7, 2.0).otherwise(F.col("b")))
    assert len(D.unequal_buckets(left, right, ["k"], 10).collect()) == 1
    assert len(D.unequal_buckets(left, right, ["k"], 20).collect()) == 1
    got = D.differing_rows(left, right, ["k"])
    assert sorted((r.k, r.b, r.found_in) for r in got.collect()) == [(7, 1.0, "left"), (7, 2.0, "right")]
    # Equal tables: a row for each bucket and task is shuffled, no row of a table.
    digests = D.bucket_digests(left, ["k"], 10)
    digests.collect()
    plan = digests._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert D.differing_rows(left, left, ["k"]).collect() == []


def test_sums_tell_swapped_pairs_apart(spark):
    """Pairs that cancel out in an exclusive or are different sums."""
    left = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (1, "b", 1.0)], SCHEMA)
    right = spark.createDataFrame([(1, "c", 1.0), (1, "c", 1.0), (1, "b", 1.0)], SCHEMA)
    assert sides(left, right) == sorted(map(tuple, D.differing_rows(left, right, ["k"]).collect()), key=str)
