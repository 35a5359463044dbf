"""Keyed tables in buckets: same rows as a whole rewrite, and little touched."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import upsert as U
from ledgerloom.plans.audit import AuditLog
from ledgerloom.plans.jobs import IngestSpec, Warehouse
from ledgerloom.schemas import ACCOUNT, TableSpec
from ledgerloom.sources import buckets as B
from ledgerloom.sources.tables import TableStore

SPEC = TableSpec(
    "ds",
    "items",
    T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("v", T.LongType()), T.StructField("w", T.StringType())]),
    key=("a", "b"),
)
COUNT = 8


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "house"), buckets={"items": COUNT})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def make(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema)


def files(store):
    root = Path(store.folder(SPEC)) / "buckets" / "data"
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def bucket_of(spark, rows):
    key = F.pmod(F.xxhash64("a", "b"), F.lit(COUNT))
    return {(r.a, r.b): r.k for r in make(spark, rows).select("a", "b", key.alias("k")).collect()}


def test_load_equals_merge_rows(spark, store):
    rng = random.Random(1)
    table = [(i, rng.choice("xy"), rng.randrange(5), None) for i in range(300)]
    store.rewrite(SPEC, make(spark, table))
    for _ in range(4):
        stage = [(rng.randrange(400), rng.choice("xyz"), rng.choice([None, 1, 2]), rng.choice([None, "q"])) for _ in range(120)]
        stage += stage[:10] + [(None, "x", 1, None), (5, None, 1, None)]
        given, before = make(spark, stage), make(spark, rows_of(store.read(SPEC)))
        valid = F.coalesce(F.col("v"), F.lit(0)) < 2
        merged = U.merge_rows(before, given, SPEC.key, ["v", "w"], valid)
        expected = rows_of(U.snapshot(merged))
        counts = merged.agg(*U.action_counts()).first().asDict()
        load = store.bucketed(SPEC).merge(given, ["v", "w"], valid)
        assert {k: load.counts[k] for k in counts} == counts
        assert rows_of(store.read(SPEC)) == expected


def test_few_keys_touch_few_buckets(spark, store):
    table = [(i, "x", 1, None) for i in range(800)]
    store.rewrite(SPEC, make(spark, table))
    where = bucket_of(spark, table)
    own = [r for r in table if where[r[0], r[1]] in (2, 5)][:8]
    before = files(store)
    change = make(spark, [(a, b, 7, w) for a, b, _, w in own])
    load = store.bucketed(SPEC).merge(change, ["v", "w"])
    assert set(load.read) == set(load.written) == set(load.touched) == {where[r[0], r[1]] for r in own}
    after = files(store)
    for name, written in before.items():
        if "_bucket=2/" not in name and "_bucket=5/" not in name:
            assert after[name] == written
    new = {n for n in after if n not in before}
    assert {n.split("/")[1] for n in new} == {f"{B.BUCKET}={k}" for k in load.written}
    read = store.bucketed(SPEC).read(load.read).inputFiles()
    assert all("_bucket=2/" in f or "_bucket=5/" in f for f in read)
    assert store.read(SPEC).filter("v = 7").count() == len(own)


def test_nothing_changed_writes_nothing(spark, store):
    table = [(i, "x", 1, None) for i in range(100)]
    store.rewrite(SPEC, make(spark, table))
    before = files(store)
    load = store.bucketed(SPEC).merge(make(spark, table[:20]), ["v", "w"])
    assert load.counts["same"] == 20 and load.written == () and files(store) == before


def test_new_keys_are_added_without_reading(spark, store):
    store.rewrite(SPEC, make(spark, [(i, "x", 1, None) for i in range(50)]))
    table = store.bucketed(SPEC)
    before = files(store)
    load = table.merge(make(spark, [(10_000, "new", 1, None)]), ["v", "w"])
    assert load.read == () and len(load.written) == 1 and load.counts["inserted"] == 1
    assert before.items() <= files(store).items()
    # Segments of a bucket are few: the load after the last one merges them.
    bucket = load.written[0]
    more = [(i, "new", 1, None) for i in range(20_000, 20_100)]
    where = bucket_of(spark, more)
    more = [r for r in more if where[r[0], r[1]] == bucket][: B.MOST_SEGMENTS - 1]
    for row in more[:-1]:
        assert table.merge(make(spark, [row]), ["v", "w"]).read == ()
    assert [s[0] for s in table.segments()].count(bucket) == B.MOST_SEGMENTS
    load = table.merge(make(spark, more[-1:]), ["v", "w"])
    assert load.read == (bucket,) and [s[0] for s in table.segments()].count(bucket) == 1
    assert store.read(SPEC).count() == 50 + 1 + len(more)


def test_a_load_that_dies_changes_nothing(spark, store, monkeypatch):
    table = [(i, "x", 1, None) for i in range(60)]
    store.rewrite(SPEC, make(spark, table))
    change = make(spark, [(1, "x", 9, None), (999, "x", 9, None)])

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(B.BucketedTable, "_commit", dies)
        with pytest.raises(RuntimeError):
            store.bucketed(SPEC).merge(change, ["v", "w"])
    assert rows_of(store.read(SPEC)) == rows_of(make(spark, table))
    store.bucketed(SPEC).merge(change, ["v", "w"])
    assert store.read(SPEC).filter("v = 9").count() == 2
    # What the dead load wrote is gone.
    store.bucketed(SPEC).merge(change, ["v", "w"])
    kept = {s for v in store.bucketed(SPEC)._versions() for s in store.bucketed(SPEC).segments(v)}
    assert {n.split("/")[0] for n in files(store)} <= {f"generation={g}" for _, g in kept}


def test_empty_table_and_empty_stage(spark, store):
    table = store.bucketed(SPEC)
    assert not store.exists(SPEC) and store.read(SPEC).count() == 0
    load = table.merge(make(spark, []), ["v", "w"])
    assert load.written == () and load.touched == ()
    store.rewrite(SPEC, make(spark, []))
    assert store.exists(SPEC) and store.read(SPEC).collect() == []
    table.merge(make(spark, [(1, "x", 1, None)]), ["v", "w"])
    store.append(SPEC, make(spark, [(2, "x", 1, None)]))
    assert rows_of(store.read(SPEC)) == [(1, "x", 1, None), (2, "x", 1, None)]
    store.truncate(SPEC)
    assert store.read(SPEC).collect() == []


def test_bits_are_those_of_the_manifest(spark, store):
    """Every stored key is a hit, in low and high bytes of the bitmap."""
    table = [(i, "x", 1, None) for i in range(2_000)]
    store.rewrite(SPEC, make(spark, table))
    touched, read = store.bucketed(SPEC)._probe(make(spark, table))
    assert touched == read == list(range(COUNT))
    single = [store.bucketed(SPEC)._probe(make(spark, [r]))[1] for r in table[:20]]
    where = bucket_of(spark, table[:20])
    assert single == [[where[r[0], r[1]]] for r in table[:20]]


def test_warehouse_load(spark, tmp_path):
    """The account load of a warehouse, rejects and counters included."""
    rows = [("1995-01-01", "1995-12-31", str(i % 40), f"n{i}", "Актив", "1", "643") for i in range(60)]
    text = spark.createDataFrame(rows, "data_actual_date string, data_actual_end_date string, account_rk string, account_number string, char_type string, currency_rk string, currency_code string")
    out = {}
    for kind, counts in (("plain", {}), ("buckets", {ACCOUNT.name: 4})):
        store = TableStore(spark, str(tmp_path / kind), buckets=counts)
        house = Warehouse(store, AuditLog(store), listed_rejects=3)
        spec = IngestSpec(ACCOUNT, "yyyy-MM-dd")
        stats = [house.load_rows(spec, text.limit(30)), house.load_rows(spec, text), house.load_rows(spec, text)]
        out[kind] = stats, rows_of(store.read(ACCOUNT))
    assert out["plain"] == out["buckets"]
    # Ids 0 to 19 came twice, with another number the second time.
    message = out["plain"][0][1].message
    assert message.startswith("20: ") and message.count("; ") == 2
