"""First values in order, with a hot key."""

import random

from pyspark.sql import functions as F

from ledgerloom.operators.first_values import first_of_all, first_values


def test_first_of_each_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["a", "b", "c", "d", "e", None])) for _ in range(300)] + [(9, None)]
    want = {}
    for k, v in rows:
        want.setdefault(k, set())
        if v is not None:
            want[k].add(v)
    got = {r.k: (r.total, r.shown) for r in first_values(spark.createDataFrame(rows, "k int, v string"), ["k"], "v", 3).collect()}
    assert got == {k: (len(v), sorted(v)[:3]) for k, v in want.items()}
    assert first_values(spark.createDataFrame([], "k int, v string"), ["k"], "v", 3).collect() == []


def test_first_of_all_rows(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), (None,)], "v string")
    assert tuple(first_of_all(rows, "v", 2).first()) == (5, ["a", "b"])
    assert tuple(first_of_all(rows.filter("false"), "v", 2).first()) == (0, [])


def test_a_hot_key_is_cut_before_the_exchange(spark):
    """A key with a third of all values sends N of a task, not all."""
    hot = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.format_string("%06d", "id").alias("v")
    )
    found = first_values(hot, ["k"], "v", 4)
    row = found.filter("k = 7").first()
    assert row.total == 10_001 and row.shown == ["000000", "000003", "000006", "000007"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    every = first_of_all(hot, "v", 3)
    assert "TakeOrderedAndProject" in every._jdf.queryExecution().executedPlan().toString()
    assert every.first().shown == ["000000", "000001", "000002"]
