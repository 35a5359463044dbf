"""One key owning a third of the rows is split over tasks, and nothing is lost."""

import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.operators.lookup import left_join_many
from ledgerloom.operators import upsert as U
from ledgerloom.operators.reconcile import corrected_rows
from ledgerloom.operators.versions import rows_with_repeated_key
from ledgerloom.plans.turnover import account_turnover

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def tight(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in old.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def executed(df):
    """The final plan after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=60_000):
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )


def split(plan):
    return "skew=true" in plan or "isSkew=true" in plan or re.search("SortMergeJoin\\(skew", plan)


def test_hot_key_on_the_many_side(tight):
    few = tight.range(0, 1000).select(F.col("id").alias("k"))
    joined = left_join_many(few, hot(tight), ["k"])
    assert split(executed(joined))
    assert joined.count() == few.join(hot(tight), "k", "left").count()


def test_hot_repeated_key(tight):
    found = rows_with_repeated_key(hot(tight), ["k"])
    assert split(executed(found))
    assert found.count() == 20_001


def test_hot_key_of_a_corrected_file(tight):
    table = tight.createDataFrame([(7, "old"), (9, "old")], "k bigint, v string")
    found = corrected_rows(table, hot(tight), ["k"])
    assert split(executed(found))
    assert found.count() == 20_001


def test_hot_key_in_a_stage(tight):
    """Different versions of one key, then copies of one row."""
    stored = tight.createDataFrame([(7, "x")], "k bigint, v string")
    found = U.rejected_rows(stored, hot(tight), ["k"], ["v"])
    assert split(executed(found))
    assert found.count() == 60_000
    doubtful = U.contested_rows(hot(tight), ["k"], ["v"])
    assert split(executed(doubtful))
    assert doubtful.count() == 20_001


def test_hot_copies_of_one_row(tight):
    """Copies are counted before the shuffle and written out by several tasks."""
    copies = hot(tight).selectExpr("IF(k = 7, 7, k % 5) AS k", "IF(k = 7, 'same', 'other') AS v")
    found = U.unmatched_rows(copies, copies.filter("k <> 7"))
    assert found.count() == 20_001
    tasks = found.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def test_hot_key_in_an_update(tight):
    changes = tight.createDataFrame([(7, "new"), (8, "new")], "k bigint, v string").distinct()
    got = U.update_from(hot(tight), changes, ["k"], ["v"])
    assert split(executed(got))
    assert got.count() == 60_000
    assert got.filter("v = 'new'").count() == 20_002


def test_hot_account_reaches_each_task_once(tight, frame):
    """A third of the postings on one account leaves a row per task and day."""
    day = dt.date(2018, 1, 5)
    postings = tight.range(0, 30_000, 1, 6).selectExpr(
        "DATE'2018-01-05' AS oper_date",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS credit_account_rk",
        "CAST(2 AS BIGINT) AS debet_account_rk",
        "CAST(1 AS DECIMAL(23,8)) AS credit_amount",
        "CAST(1 AS DECIMAL(23,8)) AS debet_amount",
    )
    got = account_turnover(postings, frame(S.ACCOUNT, []), frame(S.EXCHANGE_RATE, []), day)
    hot_rows = got.filter("account_rk IN (1, 2)")
    assert rows(hot_rows, "account_rk", "credit_amount", "debet_amount") == [
        (1, 10_001, 0),
        (2, 1, 30_000),
    ]
