"""Daily account balances: opening seed, one day, a whole period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import overlaps, valid_on
from ledgerloom.operators.lookup import rates_by_day
from ledgerloom.schemas import ACTIVE, PASSIVE

_AMOUNT = "DECIMAL(23,8)"
_BY_ACCOUNT = "PARTITION BY account_rk ORDER BY v_from, v_to, moved_on NULLS FIRST"


def seed_balance(balances: DataFrame, rates: DataFrame, as_of: dt.date) -> DataFrame:
    """Opening balances of ``as_of`` in the form of the balance mart."""
    day = F.lit(as_of)
    that_day = rates_by_day(rates, day, day).drop("on_date")
    return (
        balances.filter(F.col("on_date") == day)
        .join(that_day, "currency_rk", "left")
        .selectExpr(
            "on_date",
            "account_rk",
            f"CAST(balance_out AS {_AMOUNT}) AS balance_out",
            f"""CAST(CAST(balance_out AS {_AMOUNT}) * coalesce(rate, CAST(1 AS DECIMAL(12,8)))
                  AS {_AMOUNT}) AS balance_out_rub""",
        )
    )


def _signed(suffix: str = "") -> str:
    """Change of a balance; NULL for an account that is neither kind."""
    debet = f"coalesce(debet_amount{suffix}, 0)"
    credit = f"coalesce(credit_amount{suffix}, 0)"
    return f"""CASE char_type WHEN '{ACTIVE}' THEN {debet} - {credit}
                 WHEN '{PASSIVE}' THEN {credit} - {debet} END"""


def balance_for_day(
    accounts: DataFrame, turnover: DataFrame, balances: DataFrame, on_date: dt.date
) -> DataFrame:
    """Balances of one day from the stored balances of the day before."""
    day = F.lit(on_date)
    before = balances.filter(F.col("on_date") == F.date_sub(day, 1)).selectExpr(
        "account_rk", "balance_out AS prev", "balance_out_rub AS prev_rub"
    )
    moved = turnover.filter(F.col("on_date") == day).drop("on_date")
    valid = valid_on(day, F.col("data_actual_date"), F.col("data_actual_end_date"))
    return (
        accounts.filter(valid)
        .select("account_rk", "char_type", day.alias("on_date"))
        .join(before, "account_rk", "left")
        .join(moved, "account_rk", "left")
        .selectExpr(
            "on_date",
            "account_rk",
            f"CAST(coalesce(prev, 0) + {_signed()} AS {_AMOUNT}) AS balance_out",
            f"""CAST(coalesce(prev_rub, 0) + {_signed('_rub')} AS {_AMOUNT})
                  AS balance_out_rub""",
        )
    )


def balance_for_period(
    accounts: DataFrame,
    turnover: DataFrame,
    balances: DataFrame,
    first: dt.date,
    last: dt.date,
    shown_from: dt.date | None = None,
) -> DataFrame:
    """Balances of every day in ``first..last``, equal to chaining single days.

    With ``shown_from`` only the days from then on are made, for example the
    last day alone; their values are the same.

    A balance only changes on days with turnover, so the running sums are built
    over those sparse rows and each is spread over the days it holds at the very
    end. Everything before that is exchanged once, by account, with at most one
    row per account-day of turnover; the account x day rows, which are the bulk,
    are made after the last shuffle.

    Chaining rules kept: an account without a row on the previous day restarts
    from zero, and so does one whose previous balance was NULL (unknown kind).
    """
    points = balance_points(accounts, turnover, balances, first, last)
    by_account = f"OVER ({_BY_ACCOUNT})"
    # A point is a turnover row of a version, or a version without turnover.
    neighbours = points.selectExpr(
        "*",
        f"lag(v_from) {by_account} AS prev_from",
        f"lag(v_to) {by_account} AS prev_to",
        f"lag(known) {by_account} AS prev_known",
        f"lag(moved_on) {by_account} AS prev_moved",
        f"lead(v_from) {by_account} AS next_from",
        f"lead(moved_on) {by_account} AS next_moved",
    )
    return balance_rows(neighbours, first, last, shown_from, _totals)


def balance_points(
    accounts: DataFrame,
    turnover: DataFrame,
    balances: DataFrame,
    first: dt.date,
    last: dt.date,
    spread: bool = False,
) -> DataFrame:
    """Turnover rows within account versions, and versions without turnover.

    With ``spread`` the turnover of one account may be split over tasks: an inner
    join can be, the right side of a left join can not.
    """
    start, end = F.lit(first), F.lit(last)
    touches = overlaps(
        F.col("data_actual_date"), F.col("data_actual_end_date"), start, end
    )
    versions = (
        accounts.filter(touches)
        .selectExpr(
            "account_rk",
            "char_type",
            f"greatest(data_actual_date, DATE'{first}') AS v_from",
            f"least(coalesce(data_actual_end_date, DATE'{last}'), DATE'{last}') AS v_to",
        )
        .filter("v_from <= v_to")
    )
    moved = turnover.filter(F.col("on_date").between(start, end)).selectExpr(
        "account_rk AS moved_rk",
        "on_date AS moved_on",
        "debet_amount",
        "credit_amount",
        "debet_amount_rub",
        "credit_amount_rub",
    )
    seed = balances.filter(F.col("on_date") == F.date_sub(start, 1)).selectExpr(
        "account_rk", "balance_out AS seed", "balance_out_rub AS seed_rub"
    )
    within = F.expr("account_rk = moved_rk AND moved_on BETWEEN v_from AND v_to")
    if spread:
        paired, version = versions.join(moved, within), ["account_rk", "v_from", "v_to"]
        alone = versions.join(paired.select(*version).distinct(), version, "left_anti")
        rows = paired.unionByName(alone, allowMissingColumns=True)
    else:
        rows = versions.join(moved, within, "left")
    return (
        rows
        .selectExpr(
            "account_rk",
            "v_from",
            "v_to",
            f"char_type IN ('{ACTIVE}', '{PASSIVE}') AS known",
            "moved_on",
            f"{_signed()} AS change",
            f"{_signed('_rub')} AS change_rub",
        )
        .join(seed, "account_rk", "left")
    )


def _totals(marked: DataFrame) -> DataFrame:
    """Running sums of an account, and what they were at its last break."""
    so_far = f"OVER ({_BY_ACCOUNT} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    # Every window has the same keys and order: one sort serves them all. The
    # balance is what was added since the last break, as a difference of totals.
    return marked.selectExpr(
        "*",
        f"sum(step) {so_far} AS total",
        f"sum(step_rub) {so_far} AS total_rub",
    ).selectExpr(
        "*",
        f"last(IF(breaks, total - step, NULL), TRUE) {so_far} AS base",
        f"last(IF(breaks, total_rub - step_rub, NULL), TRUE) {so_far} AS base_rub",
    )


def balance_rows(
    neighbours: DataFrame,
    first: dt.date,
    last: dt.date,
    shown_from: dt.date | None,
    totals_of: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Days of the points, each of which knows its neighbours of the account."""
    neighbours = neighbours.selectExpr("*", "coalesce(prev_from <> v_from, TRUE) AS starts")
    opens = f"starts AND v_from = DATE'{first}'"
    marked = neighbours.selectExpr(
        "*",
        """coalesce(IF(starts, prev_to >= v_from,
             prev_to <> v_to OR prev_moved <=> moved_on), FALSE) AS overlapping""",
        """starts AND NOT coalesce(prev_known AND date_add(prev_to, 1) = v_from, FALSE)
             AS breaks""",
        f"IF({opens}, coalesce(seed, 0), 0) + coalesce(change, 0) AS step",
        f"IF({opens}, coalesce(seed_rub, 0), 0) + coalesce(change_rub, 0) AS step_rub",
    )
    totals = totals_of(marked)
    # A point holds until the day before the next one of its version; the first
    # point of a version also covers the days before its own turnover.
    shown = f"DATE'{shown_from or first}'"
    spread = totals.selectExpr(
        "*",
        "IF(starts, v_from, moved_on) AS holds_from",
        "IF(next_from = v_from, date_sub(next_moved, 1), v_to) AS holds_to",
    ).selectExpr(
        "account_rk",
        "known",
        "moved_on",
        "change",
        "change_rub",
        "total - base AS after",
        "total_rub - base_rub AS after_rub",
        f"""IF(overlapping,
             raise_error(concat('overlapping versions or turnover rows of account ',
               account_rk)),
             IF(holds_to >= {shown}, sequence(greatest(holds_from, {shown}), holds_to),
               NULL)) AS days""",
    ).selectExpr("*", "explode(days) AS on_date")

    def value(suffix: str) -> str:
        return f"""CAST(IF(known, IF(coalesce(on_date < moved_on, FALSE),
              after{suffix} - coalesce(change{suffix}, 0), after{suffix}), NULL)
            AS {_AMOUNT}) AS balance_out{suffix}"""

    return spread.selectExpr("on_date", "account_rk", value(""), value("_rub"))
