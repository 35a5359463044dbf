import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.operators import upsert as U

DDL = "k1 int, k2 int, a int, b string"
KEY, ATTRS = ["k1", "k2"], ["a", "b"]


def order(row):
    return tuple((v is not None, v if v is not None else 0) for v in row[2:])


def by_hand(target, stage, valid=lambda r: True):
    """The load rule, row by row."""
    table = {r[:2]: r for r in target}
    inserted = updated = 0
    groups = {}
    for r in set(stage):
        if None not in r[:2] and valid(r):
            groups.setdefault(r[:2], []).append(r)
    for key, found in groups.items():
        if key not in table:
            table[key] = min(found, key=order)
            inserted += 1
            continue
        changed = [r for r in found if r != table[key]]
        if changed:
            table[key] = min(changed, key=order)
            updated += 1
    rejects = [r for r in stage if table.get(r[:2]) != r]
    return sorted(table.values(), key=str), inserted, updated, sorted(rejects, key=str)


def random_rows(rng, n, unique):
    out = {}
    for i in range(n):
        key = (rng.choice([1, 2, 3, None]) if not unique else rng.randint(1, 3), rng.randint(1, 12))
        row = (*key, rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]))
        out[key if unique else i] = row
    return list(out.values())


WAYS = [U.merge_rows, U.merge_rows_by_probing]


@pytest.mark.parametrize("merge", WAYS)
@pytest.mark.parametrize("seed", range(4))
def test_load_equals_the_rule(spark, seed, merge):
    rng = random.Random(seed)
    target, stage = random_rows(rng, 25, True), random_rows(rng, 80, False)
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(stage, DDL)
    valid = F.coalesce(F.col("a") != 3, F.lit(True))
    merged = merge(t, s, KEY, ATTRS, valid)
    table, inserted, updated, rejects = by_hand(target, stage, lambda r: r[2] != 3)
    assert rows(U.snapshot(merged)) == table
    counts = U.load_counters(merged, s).first()
    assert (counts.input_count, counts.inserted_count, counts.updated_count) == (
        len(stage),
        inserted,
        updated,
    )
    assert counts.skipped_count == len(stage) - inserted - updated
    got = U.rejected_rows(U.snapshot(merged), s, KEY, ATTRS, valid)
    assert rows(got.drop(U.REASON)) == rejects
    doubtful = U.contested_rows(s, KEY, ATTRS, valid)
    again = U.rejected_rows(U.snapshot(merged), doubtful, KEY, ATTRS, valid)
    assert rows(again.drop(U.REASON)) == rejects
    ahead = U.rejects_of_load(t, s, KEY, ATTRS, valid)
    assert rows(ahead) == rows(got)


def test_changed_version_wins_over_the_equal_one(spark):
    """Of two staged versions, one equal to the stored row, the other is taken."""
    t = spark.createDataFrame([(1, 1, 1, "x")], DDL)
    s = spark.createDataFrame([(1, 1, 1, "x"), (1, 1, 2, "x")], DDL)
    for merge in WAYS:
        assert rows(U.snapshot(merge(t, s, KEY, ATTRS))) == [(1, 1, 2, "x")]


def test_columns_outside_the_load(spark):
    """They keep their value on update and are NULL on insert."""
    t = spark.createDataFrame([(1, 1, 1, "x", 9)], DDL + ", extra int")
    s = spark.createDataFrame([(1, 1, 2, "x"), (2, 2, 5, "z")], DDL)
    for merge in WAYS:
        got = U.snapshot(merge(t, s, KEY, ATTRS))
        assert rows(got) == [(1, 1, 2, "x", 9), (2, 2, 5, "z", None)]


def test_reasons(spark):
    t = spark.createDataFrame([(1, 1, 1, "x")], DDL)
    s = spark.createDataFrame(
        [(None, 1, 1, "x"), (2, 1, 3, "x"), (1, 1, 2, "x"), (1, 1, 4, "x")], DDL
    )
    valid = F.col("a") != 3
    after = U.snapshot(U.merge_rows(t, s, KEY, ATTRS, valid))
    got = U.rejected_rows(after, s, KEY, ATTRS, valid)
    assert sorted(r[U.REASON] for r in got.collect()) == ["invalid", "null_key", "other_version"]


def test_second_load_changes_nothing(spark):
    t = spark.createDataFrame([(1, 1, 1, "x")], DDL)
    s = spark.createDataFrame([(1, 1, 2, None), (2, 1, 3, "x")], DDL)
    once = U.snapshot(U.merge_rows(t, s, KEY, ATTRS))
    again = U.merge_rows(once, s, KEY, ATTRS)
    assert rows(U.snapshot(again)) == rows(once)
    assert again.filter(F.col(U.ACTION).isin(U.UPDATE, U.INSERT)).isEmpty()
    assert again.filter(F.col(U.ACTION) == U.SAME).count() == 2


def test_unmatched_rows_after_replacing(spark):
    s = spark.createDataFrame([(1, 1, None, "x"), (1, 1, 2, "x"), (1, 1, 2, "x")], DDL)
    stored = U.replace_with_distinct(s)
    assert stored.count() == 2
    assert rows(U.unmatched_rows(s, stored)) == [(1, 1, None, "x")]
    assert rows(U.unmatched_after_replace(s)) == rows(U.unmatched_rows(s, stored))


def test_unmatched_rows_equal_a_plain_anti_join(spark):
    rng = random.Random(2)
    make = lambda: spark.createDataFrame(random_rows(rng, 60, False), DDL)
    stage, stored = make(), make()
    expected = stage.join(stored, stage.columns, "left_anti")
    assert rows(U.unmatched_rows(stage, stored)) == rows(expected)


def test_append_distinct_keeps_stored_repeats(spark):
    t = spark.createDataFrame([(1, 1, 1, "x"), (1, 1, 1, "x")], DDL)
    s = spark.createDataFrame([(1, 1, 1, "x"), (2, 2, 2, "y"), (2, 2, 2, "y")], DDL)
    assert U.append_distinct(t, s).count() == 4


def test_update_from_touches_differing_rows_only(spark):
    t = spark.createDataFrame([(1, 1, 1, "x"), (2, 1, 1, "y")], DDL)
    c = spark.createDataFrame([(1, 1, None)], "k1 int, k2 int, a int")
    assert rows(U.update_from(t, c, KEY, ["a"])) == [(1, 1, None, "x"), (2, 1, 1, "y")]


def test_rows_of_doubtful_keys_are_found_without_a_shuffle_of_the_stage(spark):
    rng = random.Random(3)
    valid = F.coalesce(F.col("a") != 3, F.lit(True))
    for _ in range(5):
        t = spark.createDataFrame(random_rows(rng, 20, True), DDL)
        s = spark.createDataFrame(random_rows(rng, 40, False), DDL)
        after = U.snapshot(U.merge_rows(t, s, KEY, ATTRS, valid))
        keys = U.repeated_or_invalid(s, KEY, valid)
        assert U.contested_rows(s, KEY, ATTRS, valid).select(*KEY).dropna().join(keys, KEY, "left_anti").isEmpty()
        doubtful = U.contested_rows(s, KEY, ATTRS, valid, F.broadcast(spark.createDataFrame(keys.collect(), keys.schema)))
        assert "Exchange hash" not in doubtful._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in keys._jdf.queryExecution().executedPlan().toString()
        got = U.rejected_rows(after, doubtful, KEY, ATTRS, valid)
        assert rows(got) == rows(U.rejected_rows(after, s, KEY, ATTRS, valid))
