"""Day-to-day continuity of account balances: find breaks, mend, reload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.upsert import update_from
from ledgerloom.schemas import BALANCE_TURNOVER

_KEY = ["account_rk", "effective_date"]

# Fixed value: stands for a currency without a name.
NO_NAME = "-1"


def _neighbours(balances: DataFrame, by_next_day: bool) -> DataFrame:
    """Pairs (day before, day) of one account whose sums do not meet.

    The join date is the later day when corrections belong there, else the
    earlier one. NULL sums never count as different. Both sides are all daily
    balances, so they are merged: the planner's estimate of rows that were
    exploded on the way here is far too low, and it would broadcast them.
    """
    before = balances.select(
        "account_rk",
        (F.date_add("effective_date", 1) if by_next_day else F.col("effective_date")).alias(
            "effective_date"
        ),
        "account_out_sum",
    )
    after = balances.select(
        "account_rk",
        (F.col("effective_date") if by_next_day else F.date_sub("effective_date", 1)).alias(
            "effective_date"
        ),
        "account_in_sum",
    )
    return before.join(after.hint("merge"), _KEY, "inner").filter(
        F.col("account_in_sum") != F.col("account_out_sum")
    )


def correct_opening(balances: DataFrame) -> DataFrame:
    """Days whose opening sum should be the closing sum of the day before."""
    return _neighbours(balances, True).select(
        *_KEY, F.col("account_out_sum").alias("correct_account_in_sum")
    )


def correct_closing(balances: DataFrame) -> DataFrame:
    """Days whose closing sum should be the opening sum of the day after."""
    return _neighbours(balances, False).select(
        *_KEY, F.col("account_in_sum").alias("correct_account_out_sum")
    )


def opening_fixes(balances: DataFrame) -> DataFrame:
    """One right opening sum per account-day that needs one.

    All corrections are read from the values before the change, so one never
    causes another. Each row is offered to its own day (opening sum) and to the
    next one (closing sum); one aggregation per account-day then tells whether
    they meet. Repeated days thus never multiply: of several closing sums the
    smallest counts, or the greatest if all opening sums equal the smallest.
    """
    offers = balances.selectExpr(
        "account_rk",
        """inline(array(
              struct(effective_date, account_in_sum AS opening,
                CAST(NULL AS DECIMAL(23,8)) AS closing),
              struct(date_add(effective_date, 1) AS effective_date,
                CAST(NULL AS DECIMAL(23,8)) AS opening, account_out_sum AS closing)))""",
    )
    low, high = F.min("closing"), F.max("closing")
    low_differs = (F.min("opening") != low) | (F.max("opening") != low)
    return (
        offers.groupBy(*_KEY)
        .agg(
            F.when(low_differs, low)
            .when(F.min("opening") != high, high)
            .alias("account_in_sum")
        )
        .filter(F.col("account_in_sum").isNotNull())
    )


def with_fixes(balances: DataFrame, fixes: DataFrame) -> DataFrame:
    return update_from(balances, fixes, _KEY, ["account_in_sum"])


def apply_opening_correction(balances: DataFrame) -> DataFrame:
    """The balances with wrong opening sums replaced."""
    return with_fixes(balances, opening_fixes(balances))


def balance_turnover(
    accounts: DataFrame, balances: DataFrame, currencies: DataFrame
) -> DataFrame:
    """All accounts with their daily sums and the name of their currency."""
    name: Column = F.coalesce("currency_name", F.lit(NO_NAME))
    named = accounts.join(
        currencies.select("currency_cd", "currency_name"), "currency_cd", "left"
    ).select("account_rk", "department_rk", name.alias("currency_name"))
    sums = balances.select(*_KEY, "account_in_sum", "account_out_sum")
    # Sums have one row per account and day: no account outgrows the calendar.
    # They are the many side by nature, so never broadcast on an estimate.
    return named.join(sums.hint("merge"), "account_rk", "left").select(*BALANCE_TURNOVER.columns)
