"""Properties of physical plans that keep the jobs usable on big tables."""

from decimal import Decimal

import pytest
from conftest import day

from ledgerloom.catalog import checks, loads, marts

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_account_days_are_made_after_the_last_shuffle(spark, no_broadcast):
    text = plan(marts.balance_period(spark, DATA))
    assert text.index("explode(days") < text.index("Exchange")
    # The three inputs meet on one key: no exchange between joins and windows.
    top = text[: text.index("SortMergeJoin")]
    assert "Exchange" not in top


def test_postings_are_summed_before_the_first_shuffle(spark, no_broadcast):
    lines = plan(marts.turnover_month(spark, DATA)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "o_totalprice" in line and "FileScan" in line)
    above = [line for line in lines[:scan] if "Exchange" in line or "partial_sum(credit#" in line]
    assert "partial_sum(credit#" in above[-1]


def test_losers_are_dropped_before_the_shuffle(spark):
    for df in (checks.dedupe_latest(spark, DATA), loads.BALANCES.snapshot(spark, DATA)):
        lines = [l for l in plan(df).splitlines() if "WindowGroupLimit" in l or "Exchange hash" in l]
        first = next(i for i, l in enumerate(lines) if "Partial" in l)
        assert "Exchange" in lines[first - 1] and "Final" in lines[first - 2]


def test_comparison_is_one_aggregation(spark):
    text = plan(checks.recon_only_left(spark, DATA))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_rejects_read_the_stage_twice_and_the_target_once(spark, no_broadcast):
    made = loads.BALANCES
    parts = made.stage_text(spark, DATA)._jdf.queryExecution().executedPlan().toString().count("FileScan")
    text = plan(made.rejects(spark, DATA))
    assert text.count("FileScan") == 2 * parts + 1


def test_report_is_one_lazy_plan(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: pytest.fail("wrote a table"))
    plan(marts.ledger_report_month(spark, DATA))


def test_daily_sums_are_read_and_shuffled_once(spark, no_broadcast):
    text = plan(marts.balance_turnover_mart(spark, DATA))
    assert text.count("orders.parquet") <= 1


def test_no_cross_joins_and_no_python(spark):
    names = ("turnover_day", "balance_period", "ledger_report", "holiday_mart", "apply_correction", "upsert_snapshot")
    from ledgerloom.catalog import QUERIES

    for name in names:
        text = plan(QUERIES[name](spark, DATA))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
            assert word not in text, (name, word)


def test_only_needed_columns_and_dates_are_read(spark, store, frame):
    from ledgerloom import schemas as S
    from ledgerloom.plans.turnover import account_turnover

    one = (day("2018-01-05"), 1, 2, 1, 1)
    store.rewrite(S.POSTING, frame(S.POSTING, [(*one[:3], Decimal(1), Decimal(1))]))
    store.rewrite(S.ACCOUNT, frame(S.ACCOUNT, []))
    store.rewrite(S.EXCHANGE_RATE, frame(S.EXCHANGE_RATE, []))
    text = plan(
        account_turnover(
            store.read(S.POSTING), store.read(S.ACCOUNT), store.read(S.EXCHANGE_RATE), day("2018-01-05")
        )
    )
    assert "PartitionFilters: [isnotnull(oper_date" in text
    assert "account_number" not in text
