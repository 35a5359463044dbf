from collections import Counter
from decimal import Decimal

import pytest
from conftest import day, money, rows
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.catalog import inputs, marts
from ledgerloom.plans import balance_repair as R
from ledgerloom.plans.loan_holiday import loan_holiday_info

D = Decimal


def sums(frame):
    return frame(
        S.SOURCE_BALANCE,
        [
            (1, day("2024-01-01"), D(0), D(10)),
            (1, day("2024-01-02"), D(11), D(20)),
            (1, day("2024-01-03"), D(20), D(30)),
            (1, day("2024-01-05"), D(99), D(40)),
            (2, day("2024-01-01"), D(0), None),
            (2, day("2024-01-02"), D(5), D(6)),
            (2, day("2024-01-03"), D(7), D(8)),
        ],
    )


def test_corrections(frame):
    df = sums(frame)
    assert rows(R.correct_opening(df)) == [
        (1, day("2024-01-02"), money(10)),
        (2, day("2024-01-03"), money(6)),
    ]
    assert rows(R.correct_closing(df)) == [
        (1, day("2024-01-01"), money(11)),
        (2, day("2024-01-02"), money(7)),
    ]
    fixed = {(r[0], r[1]): r[2] for r in rows(R.apply_opening_correction(df))}
    assert len(fixed) == 7
    assert fixed[1, day("2024-01-02")] == money(10)
    assert fixed[2, day("2024-01-03")] == money(6)
    assert fixed[1, day("2024-01-05")] == money(99)


def test_balance_turnover(frame):
    accounts = frame(S.SOURCE_ACCOUNT, [(1, 7, "840"), (3, 8, "000"), (4, 9, None)])
    names = frame(S.CURRENCY_NAME, [("840", "Dollar")])
    got = R.balance_turnover(accounts, sums(frame), names)
    assert rows(got, "account_rk", "currency_name", "department_rk") == sorted(
        [(1, "Dollar", 7)] * 4 + [(3, "-1", 8), (4, "-1", 9)], key=str
    )


def test_loan_holidays(frame):
    v1, v2, end = day("2023-01-01"), day("2023-03-15"), day("2999-12-31")
    key = ["deal_rk", "product_rk", "deal_num", "effective_from_date", "effective_to_date"]
    deals = frame(S.DEAL, [(1, 5, "n1", v1, end), (2, 5, "n2", v2, end), (3, None, "n3", v1, end)], key)
    holidays = frame(
        S.LOAN_HOLIDAY,
        [(1, "A", v1, end), (1, "B", v1, end), (2, "A", v1, end)],
        ["deal_rk", "loan_holiday_type_cd", "effective_from_date", "effective_to_date"],
    )
    products = frame(S.PRODUCT, [(5, "loan", v1, end), (5, "card", v2, end)])
    got = loan_holiday_info(deals, holidays, products)
    assert got.columns == S.LOAN_HOLIDAY_INFO.columns
    assert rows(got, "deal_rk", "deal_number", "loan_holiday_type_cd", "product_name", "effective_from_date") == sorted(
        [
            (1, "n1", "A", "loan", v1),
            (1, "n1", "B", "loan", v1),
            (2, "n2", None, "card", None),
            (3, "n3", None, None, None),
        ],
        key=str,
    )


def test_repeated_days_are_mended_without_multiplying(frame):
    d1, d2 = day("2024-01-01"), day("2024-01-02")
    data = [(1, d1, D(0), D(10)), (1, d1, D(0), D(20)), (1, d2, D(10), D(1)), (1, d2, D(10), D(2))]
    df = frame(S.SOURCE_BALANCE, data)
    # Every pair that does not meet is reported, and each day is mended once.
    assert R.correct_opening(df).count() == 2
    fixed = R.apply_opening_correction(df)
    assert rows(fixed, "effective_date", "account_in_sum") == sorted(
        [(d1, money(0))] * 2 + [(d2, money(20))] * 2, key=str
    )


@pytest.fixture
def customers(spark, tmp_path):
    """A folder with customers whose daily sums take far more room than their file."""
    spark.range(0, 2000, 1, 1).selectExpr(
        "id AS c_custkey",
        "CAST(id % 25 AS INT) AS c_nationkey",
        "CAST(id % 100 AS DOUBLE) AS c_acctbal",
        "'BUILDING' AS c_mktsegment",
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(25).selectExpr(
        "CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name"
    ).write.parquet(f"{tmp_path}/nation.parquet")
    return str(tmp_path)


def broadcast_sides(df):
    """Joins of the final plan with a side that goes whole through the driver."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("BroadcastHashJoin")


def test_account_days_of_the_mart_are_not_broadcast(spark, customers):
    got = marts.balance_turnover_mart(spark, customers)
    # The names of the currencies alone.
    assert broadcast_sides(got) <= 1
    assert got.count() == 80 + 80 * 9 + 23 * 80 * 10


def test_account_days_are_not_broadcast_to_mend_opening_sums(spark, customers):
    got = marts.correct_in(spark, customers)
    assert broadcast_sides(got) == 0
    # Nations 1 to 8 each have a day that does not meet the day before.
    assert got.count() == 8 * 80


def test_account_days_are_not_broadcast_to_mend_closing_sums(spark, customers):
    got = marts.correct_out(spark, customers)
    assert broadcast_sides(got) == 0
    assert got.count() == 8 * 80


def test_no_task_holds_the_days_of_all_accounts_of_a_file(spark, customers):
    days = inputs.daily_sums(spark, customers)
    by_task = Counter(r[0] for r in days.select(F.spark_partition_id()).collect())
    assert sum(by_task.values()) == days.count() == 80 * 9 + 23 * 80 * 10
    assert max(by_task.values()) <= 2 * days.count() / len(by_task) and len(by_task) > 4
    assert marts.apply_correction(spark, customers).count() == days.count()
