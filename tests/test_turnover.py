import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from conftest import day, money, rows
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.plans.turnover import account_turnover


@pytest.fixture
def tables(frame):
    accounts = frame(
        S.ACCOUNT,
        [
            (day("2018-01-01"), day("2018-12-31"), 1, "3" * 20, "А", 10, "840"),
            (day("2018-01-01"), day("2018-12-31"), 2, "3" * 20, "П", 11, "978"),
            # A version that ended long ago still takes part.
            (day("2000-01-01"), day("2000-12-31"), 3, "3" * 20, "П", 34, "643"),
            (day("2001-01-01"), day("2018-12-31"), 3, "3" * 20, "П", 34, "643"),
        ],
    )
    rates = frame(
        S.EXCHANGE_RATE,
        [
            (day("2018-01-01"), day("2018-01-02"), 10, Decimal("56.12345678"), "840"),
            (day("2018-01-03"), day("2018-01-03"), 10, Decimal("57"), "840"),
            (day("2018-01-01"), None, 11, Decimal("70"), "978"),
        ],
    )
    return accounts, rates


def test_sides_rates_and_unknown_accounts(frame, tables):
    postings = frame(
        S.POSTING,
        [
            (day("2018-01-02"), 1, 2, Decimal("10.01"), Decimal("10.01")),
            (day("2018-01-03"), 1, 9, Decimal("1"), Decimal("2")),
            (day("2018-01-03"), 9, 1, None, Decimal("5")),
            (day("2018-01-04"), 1, 2, Decimal("99"), Decimal("99")),
        ],
    )
    got = account_turnover(postings, *tables, day("2018-01-02"), day("2018-01-03"))
    z = money("0")
    assert rows(got) == sorted(
        [
            (day("2018-01-02"), 1, money("10.01"), money("561.79580237"), z, z),
            (day("2018-01-02"), 2, z, z, money("10.01"), money("10.01")),
            (day("2018-01-03"), 1, money("1"), money("57"), money("5"), money("285")),
            (day("2018-01-03"), 9, z, z, money("2"), money("2")),
        ],
        key=str,
    )


def test_every_account_version_multiplies(frame, tables):
    postings = frame(S.POSTING, [(day("2018-01-02"), 3, 8, Decimal("4"), Decimal("4"))])
    got = {r.account_rk: r.credit_amount for r in account_turnover(postings, *tables, day("2018-01-02")).collect()}
    assert got == {3: money("8"), 8: money("0")}


def test_two_rates_for_an_account_day_fail(frame, tables):
    accounts, rates = tables
    clash = rates.union(
        frame(S.EXCHANGE_RATE, [(day("2018-01-02"), day("2018-01-05"), 10, Decimal("1"), "840")])
    )
    postings = frame(S.POSTING, [(day("2018-01-02"), 1, 8, Decimal("4"), Decimal("4"))])
    with pytest.raises(Exception, match="two rates for account 1"):
        account_turnover(postings, accounts, clash, day("2018-01-02")).collect()


def test_hot_account_equals_sums_by_hand(frame, tables):
    rng = random.Random(1)
    data = [
        (
            day("2018-01-01") + dt.timedelta(days=rng.randint(0, 4)),
            rng.choice([1, 1, 1, 2, 3, 4]),
            rng.choice([1, 2, 5]),
            Decimal(rng.randint(1, 10**6)) / 100,
            Decimal(rng.randint(1, 10**6)) / 100,
        )
        for _ in range(300)
    ]
    sums = defaultdict(lambda: [Decimal(0), Decimal(0)])
    for d, credit, debet, ca, da in data:
        sums[d, credit][0] += ca * (2 if credit == 3 else 1)
        sums[d, debet][1] += da
    got = account_turnover(frame(S.POSTING, data), *tables, day("2018-01-01"), day("2018-01-05"))
    assert rows(got, "on_date", "account_rk", "credit_amount", "debet_amount") == sorted(
        [(d, a, money(c), money(x)) for (d, a), (c, x) in sums.items()], key=str
    )


def test_account_days_are_dealt_out_for_the_lookups(spark, frame, tables):
    """Few bytes in the shuffle, but several hash tables of a task hold them."""
    start = day("2018-01-02")
    postings = spark.range(0, 4000, 1, 2).selectExpr(
        "DATE'2018-01-02' AS oper_date",
        "id AS credit_account_rk",
        "id AS debet_account_rk",
        "CAST(1 AS DECIMAL(23,8)) AS credit_amount",
        "CAST(2 AS DECIMAL(23,8)) AS debet_amount",
    )
    got = account_turnover(postings, *tables, start).withColumn("task", F.spark_partition_id())
    by_task = Counter(r["task"] for r in got.collect())
    assert sum(by_task.values()) == 4000
    assert len(by_task) > 4 and max(by_task.values()) < 500
