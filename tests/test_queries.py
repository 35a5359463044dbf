"""Every registered query against its SQL twin on the smallest data set."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in sorted(DATA.glob("*.parquet"))]

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def sorted_rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, str(DATA))
    answer = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted_rows(got.collect(), got.columns) == sorted_rows(answer.fetchall(), columns)


def test_core_queries_all_have_sql():
    from ledgerloom.catalog import ORACLE, QUERIES

    assert QUERIES.keys() == ORACLE.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_csv_queries_do_not_disturb_each_other(spark):
    """Two data sets at a time: neither overwrites the other's files."""
    for name in ("csv_roundtrip", "csv_text_roundtrip", "csv_encoding"):
        first = entry.queries()[name](spark, str(DATA))
        second = entry.queries()[name](spark, str(DATA.parent / "sf0.01"))
        assert first.count() > 0 and second.count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
