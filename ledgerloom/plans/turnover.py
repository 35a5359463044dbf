"""Daily account turnover from postings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import dealt, rates_by_day

_AMOUNT = "DECIMAL(23,8)"


def posting_sides(postings: DataFrame) -> DataFrame:
    """Each posting as its credit row and its debit row, in one scan."""
    return postings.selectExpr(
        "oper_date AS on_date",
        f"""inline(array(
              struct(credit_account_rk AS account_rk,
                CAST(credit_amount AS {_AMOUNT}) AS credit, CAST(0 AS {_AMOUNT}) AS debet),
              struct(debet_account_rk AS account_rk,
                CAST(0 AS {_AMOUNT}) AS credit, CAST(debet_amount AS {_AMOUNT}) AS debet)))""",
    )


def account_turnover(
    postings: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    first: dt.date,
    last: dt.date | None = None,
) -> DataFrame:
    """Credit and debit sums per account and day, plain and in roubles.

    Days ``first..last`` inclusive come from one plan. Postings are summed per
    (day, account) before any lookup: that combines on the map side, so a hot
    account costs one row per task, and the joins see account-days instead of
    postings. A rate belongs to an account-day, hence sum * rate = sum of
    products, exactly, in decimals. Accounts without a dimension row or a rate
    count with rate 1. Every version row of an account takes part, whatever
    its dates. Two rates for one account-day fail the job: the table's key
    would be broken.
    """
    start, end = F.lit(first), F.lit(last or first)
    summed = (
        posting_sides(postings.filter(F.col("oper_date").between(start, end)))
        .groupBy("on_date", "account_rk")
        .agg(_total("credit").alias("credit"), _total("debet").alias("debet"))
    )
    daily_rates = rates_by_day(rates, start, end)
    return (
        dealt(summed, "account_rk")
        .join(accounts.select("account_rk", "currency_rk"), "account_rk", "left")
        .join(daily_rates, ["currency_rk", "on_date"], "left")
        .selectExpr(
            "*", "coalesce(rate, CAST(1 AS DECIMAL(12,8))) AS used_rate"
        )
        .groupBy("on_date", "account_rk")
        .agg(
            _total("credit").alias("credit_amount"),
            _total("credit * used_rate").alias("credit_amount_rub"),
            _total("debet").alias("debet_amount"),
            _total("debet * used_rate").alias("debet_amount_rub"),
            F.expr(
                """coalesce(min(rate) <> max(rate), FALSE)
                     OR count(rate) BETWEEN 1 AND count(*) - 1"""
            ).alias("several_rates"),
        )
        .selectExpr(
            "on_date",
            "account_rk",
            "credit_amount",
            """IF(several_rates,
                 raise_error(concat('two rates for account ', account_rk, ' on ', on_date)),
                 credit_amount_rub) AS credit_amount_rub""",
            "debet_amount",
            "debet_amount_rub",
        )
    )


def _total(amount: str) -> Column:
    return F.expr(f"CAST(sum({amount}) AS {_AMOUNT})")
