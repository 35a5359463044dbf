"""Blocked running balances equal the day loop."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import day, rows
from pyspark.sql import functions as F
from test_balance import FIRST, LAST, chained, random_ledger

from ledgerloom import schemas as S
from ledgerloom.plans import balance_blocks as B
from ledgerloom.plans.balance import balance_for_period, balance_points


def frames(frame, versions, moved, seeds):
    return frame(S.ACCOUNT, versions), frame(S.TURNOVER, moved), frame(S.DAILY_BALANCE, seeds)


@pytest.mark.parametrize(("seed", "days"), [(0, 1), (1, 3), (2, 5), (3, 92)])
def test_equals_days_chained(frame, seed, days):
    ledger = random_ledger(seed)
    got = B.balance_in_blocks(*frames(frame, *ledger), FIRST, LAST, block_days=days)
    assert rows(got) == chained(*ledger)
    late = LAST - dt.timedelta(days=2)
    shown = B.balance_in_blocks(*frames(frame, *ledger), FIRST, LAST, shown_from=late, block_days=days)
    assert rows(shown) == [r for r in chained(*ledger) if r[0] >= late]


@pytest.mark.parametrize("second", [(day("2018-01-05"), None), (day("2018-01-01"), day("2018-01-09"))])
def test_overlapping_versions_fail(frame, second):
    versions = [
        (day("2018-01-01"), day("2018-01-10"), 1, "3" * 20, "А", 1, "810"),
        (*second, 1, "3" * 20, "А", 1, "810"),
    ]
    got = B.balance_in_blocks(*frames(frame, versions, [], []), FIRST, LAST, block_days=2)
    with pytest.raises(Exception, match="overlapping versions"):
        got.collect()


def test_one_account_with_a_third_of_all_rows(frame):
    """Twelve years of one account beside other accounts' days: same balances, and
    no window holds more than a block of it."""
    first, n = day("2006-01-01"), 4_000
    last = first + dt.timedelta(days=n - 1)
    versions = [(first, None, 0, "3" * 20, "А", 1, "810")]
    versions += [(first, None, k, "3" * 20, "П", 1, "810") for k in range(1, 401)]
    one, two = Decimal(1), Decimal(2)
    moved = [(first + dt.timedelta(days=i), 0, one, one, two, two) for i in range(n)]
    moved += [(first + dt.timedelta(days=(37 * i) % n), 1 + i % 400, one, one, two, two) for i in range(2 * n)]
    given = frames(frame, versions, sorted(set(moved)), [(first - dt.timedelta(days=1), 0, Decimal(5), Decimal(5))])
    shown = last - dt.timedelta(days=3)
    plain = balance_for_period(*given, first, last, shown_from=shown)
    blocked = B.balance_in_blocks(*given, first, last, shown_from=shown)
    assert rows(blocked) == rows(plain)
    points = balance_points(*given, first, last, spread=True)
    at = F.floor(F.datediff(F.coalesce("moved_on", "v_from"), F.lit(first)) / B.BLOCK_DAYS)
    largest = points.groupBy("account_rk", at).count().agg(F.max("count")).first()[0]
    assert largest <= B.BLOCK_DAYS
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(account_rk" in plan and "block" in plan
