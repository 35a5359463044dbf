import random
from collections import Counter

import pytest
from conftest import day, rows

from ledgerloom.catalog import checks as catalog
from ledgerloom.operators import checks, lookup, reconcile, versions

DDL = "k int, v string, n int"


def test_keep_freshest_counts_null_as_newest(spark):
    df = spark.createDataFrame(
        [(1, "2018-01-01", 1), (1, None, 2), (1, None, 3), (2, "a", 1), (2, "b", 1)], DDL
    )
    assert rows(versions.keep_freshest(df, ["k"], ["v"])) == [(1, None, 3), (2, "b", 1)]


def test_repeats(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 1), (2, "a", 1), (None, "a", 1), (None, "b", 1)], DDL
    )
    assert rows(versions.repeated_keys(df, ["k"])) == [(1, 2), (None, 2)]
    assert rows(versions.rows_with_repeated_key(df, ["k"])) == [(1, "a", 1), (1, "b", 1)]
    assert versions.distinct_keys(df, ["k"]).count() == 3


def test_comparison_equals_set_operations(spark):
    rng = random.Random(5)
    make = lambda: [
        (rng.choice([1, 2, None]), rng.choice(["a", "b", None]), rng.choice([1, None]))
        for _ in range(12)
    ]
    left, right = spark.createDataFrame(make(), DDL), spark.createDataFrame(make(), DDL)
    assert rows(reconcile.only_left(left, right)) == rows(left.subtract(right))
    assert rows(reconcile.only_right(left, right)) == rows(right.subtract(left))
    assert rows(reconcile.common_rows(left, right)) == rows(left.intersect(right))
    got = reconcile.difference_summary(left, right).first()
    assert tuple(got) == (
        left.subtract(right).count(),
        right.subtract(left).count(),
        left.intersect(right).count(),
    )


def test_corrected_rows(spark):
    old = spark.createDataFrame([(1, "mortgge", 1), (2, "card", 1)], DDL)
    new = spark.createDataFrame([(1, "mortgage", 1), (2, "card", 1), (3, "loan", 1)], DDL)
    assert rows(reconcile.corrected_rows(old, new, ["k"])) == [(1, "mortgage", 1)]


@pytest.mark.parametrize("run", [1, 2, 10_000])
def test_gaps_with_repeated_days(spark, monkeypatch, run):
    monkeypatch.setattr(lookup, "RUN", run)
    rng = random.Random(3)
    data = [
        (rng.randint(1, 4), day(f"2024-01-{rng.randint(1, 20):02d}") if rng.random() > 0.1 else None)
        for _ in range(60)
    ]
    df = spark.createDataFrame(data, "account_rk int, effective_date date")
    expected = Counter()
    for k in range(1, 5):
        days = sorted(d for a, d in data if a == k and d)
        for here, there in zip(days, days[1:]):
            if (there - here).days != 1:
                expected[(k, here, there, (there - here).days)] += 1
    assert Counter(tuple(r) for r in checks.date_gaps(df).collect()) == expected


def test_left_join_many_equals_left_join(spark):
    few = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 7)], "k int, n int")
    assert rows(lookup.left_join_many(few, many, ["k"])) == rows(few.join(many, "k", "left"))


def test_enforced_key(spark):
    good = spark.createDataFrame([(1, "a", 1), (2, None, 1)], DDL)
    assert rows(checks.enforce_key(good, ["k"], "t")) == rows(good)
    for bad in [(1, "b", 2)], [(None, "b", 2)]:
        df = good.union(spark.createDataFrame(bad, DDL))
        with pytest.raises(Exception, match="t: key is not unique or NULL"):
            checks.enforce_key(df, ["k"], "t").collect()


def test_display_order(spark):
    df = spark.createDataFrame([(None, "a", 1), (2, "a", 1), (1, "b", 1), (1, None, 1)], DDL)
    got = [(r.k, r.v) for r in versions.in_key_order(df, ["k", "v"]).collect()]
    assert got == [(1, "b"), (1, None), (2, "a"), (None, "a")]


def test_overlapping_versions(spark):
    data = [
        (1, "2018-01-01", "2018-01-31"),
        (1, "2018-01-05", "2018-01-06"),
        (1, "2018-01-31", None),
        (1, "2018-03-01", "2018-03-02"),
        (2, "2018-01-01", "2018-01-31"),
        (2, "2018-02-01", None),
        (3, "2018-01-01", "2018-01-01"),
        (3, "2018-01-01", "2018-01-01"),
    ]
    df = spark.createDataFrame(data, "k int, f string, t string").selectExpr(
        "k", "CAST(f AS DATE) AS f", "CAST(t AS DATE) AS t"
    )
    got = checks.overlapping_versions(df, ["k"], "f", "t")
    assert rows(got) == sorted(
        [
            (1, day("2018-01-05"), 1, day("2018-01-31")),
            (1, day("2018-01-31"), 1, day("2018-01-31")),
            (1, day("2018-03-01"), 1, checks.OPEN_END),
            (3, day("2018-01-01"), 2, None),
        ],
        key=str,
    )


def test_daily_rows_of_one_file_are_counted_by_several_tasks(spark, tmp_path):
    spark.range(0, 100, 1, 1).selectExpr(
        "id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "1.5D AS c_acctbal"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    got = catalog.gap_check_daily(spark, str(tmp_path))
    assert rows(got) == sorted(
        [(k, day("2024-01-05"), day("2024-01-07"), 2) for k in (7, 32, 57, 82)], key=str
    )
    # The rows are made, and first counted, above an exchange of the customers.
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange" in plan[plan.rindex("Generate"):]
