"""The conversation trie against a dictionary of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def nodes_of(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    given = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        given[c] = own.get(base, [])[:h] + turns[h:] if rebuild else turns
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in given.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        own_text = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = sum(saved[k] for k in children[path]) + own_text
    out = []
    for path, found in members.items():
        ends = ",".join(map(str, sorted(c for c in found if len(given[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found), len(path), parent, len(found), len(children[path]), leaves[path], saved[path], digest))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(-130, 130, 7), 100, 200, 205, 301, 302, 399]:
        for turn in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 25])):
            text = rng.choice(["a", "bb", "", None, "ü😀"]) if turn > 2 else "x"
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(["user", "user", None]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_prefixes(spark, seed):
    rows = random_rows(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(T.op13_prefix_trie(frame)) == nodes_of(rows)
    assert got(T.prefix_trie(frame)) == nodes_of(rows, rebuild=False)


def test_long_conversations_cross_stretches_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "STRETCH", 2)
    rows = [(7, i, "user", f"t{i % 5}") for i in range(300)] + [(8, i, "user", f"t{i % 5}") for i in range(290)]
    rows += [(9, i, "user", f"t{i % 5}" if i < 100 else "other") for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(T.op13_prefix_trie(frame)) == nodes_of(rows)


def test_defined_cases(spark):
    rows = [
        (None, 1, "user", "no conversation"),
        (1, None, None, None), (1, None, None, None),  # repeated rows are turns
        (2, 5, "user", "b"), (2, 5, "user", "a"), (2, 5, "a", "z"),  # ties: role, then text
        (3, 0, "user", "x" * 40_000),
        (405, 0, "user", "its base is absent"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("block", "rep", "depth", "a", "n", "level", "part"):
        frame = frame.withColumn(name, F.lit("other"))
    assert got(T.op13_prefix_trie(frame)) == nodes_of(rows)
    assert T.op13_prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ends_come_in_chunks(spark):
    """A node where many conversations end gets one digest from several tasks."""
    rows = [(i, 0, "user", "same") for i in range(3_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert got(T.prefix_trie(frame)) == nodes_of(rows, rebuild=False)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_sql_twin(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    twin = sorted(con.sql(T.OP13_SQL).fetchall(), key=str)
    rows = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    assert twin == nodes_of(rows) == got(T.op13_prefix_trie(spark.read.parquet(path)))
