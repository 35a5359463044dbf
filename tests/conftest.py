import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark import SparkConf

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.plans.audit import AuditLog
from ledgerloom.plans.jobs import Warehouse
from ledgerloom.session import build_session
from ledgerloom.sources.tables import TableStore


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Set only where the session's environment does not name a shared folder.
    shared = SparkConf().get("spark.checkpoint.dir") or str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "ledgerloom-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=shared,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "house"))


@pytest.fixture
def house(store):
    ticks = iter(range(10_000))
    start = dt.datetime(2020, 1, 1)
    clock = lambda: start + dt.timedelta(seconds=next(ticks))
    return Warehouse(store, AuditLog(store, clock))


@pytest.fixture
def frame(spark):
    """Rows of a table spec, missing columns NULL."""

    def make(spec, rows, columns=None):
        names = columns or spec.columns
        full = [tuple(dict(zip(names, r)).get(c) for c in spec.columns) for r in rows]
        schema = type(spec.schema)([type(f)(f.name, f.dataType, True) for f in spec.schema])
        return spark.createDataFrame(full, schema)

    return make


def day(text):
    return dt.date.fromisoformat(text)


def money(value):
    return None if value is None else Decimal(value).quantize(Decimal("1e-8"))


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
