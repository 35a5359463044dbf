"""Monthly balance report by ledger account."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import overlaps
from ledgerloom.schemas import HOME_CURRENCY_CODES, LEDGER_REPORT

# Fixed value: the ledger account is this many leading digits of the number.
LEDGER_DIGITS = 5


_MEASURES = {
    "balance_in": "opening",
    "turn_deb": "debet",
    "turn_cre": "credit",
    "balance_out": "closing",
}
_AMOUNT = "DECIMAL(23,8)"


def report_period(report_date: dt.date) -> tuple[Column, Column]:
    """First and last day of the month reported on (constant expressions)."""
    day = F.lit(report_date)
    return F.add_months(day, -1), F.date_sub(day, 1)


def ledger_report(
    accounts: DataFrame,
    ledger: DataFrame,
    balances: DataFrame,
    turnover: DataFrame,
    report_date: dt.date,
    allow_unmapped: bool = False,
) -> DataFrame:
    """Opening and closing balance, debit and credit turnover per ledger account.

    Each measure is given for home currency, other currencies and in total, all
    in roubles. The two balances and the turnover of the month are brought to
    one row per account by a single aggregation, then joined once to the account
    versions of the month; the last aggregation combines on the map side down to
    one row per (chapter, ledger account, kind).

    An account whose ledger account is unknown would have no chapter, which the
    key forbids: the job fails unless ``allow_unmapped``.
    """
    first, last = report_period(report_date)
    facts = (
        balances.filter(F.col("on_date").isin(F.date_sub(first, 1), last))
        .select("account_rk", (F.col("on_date") == last).alias("at_end"), "balance_out_rub")
        .selectExpr(
            "account_rk",
            "IF(at_end, NULL, balance_out_rub) AS opening",
            "IF(at_end, balance_out_rub, NULL) AS closing",
            f"CAST(NULL AS {_AMOUNT}) AS debet",
            f"CAST(NULL AS {_AMOUNT}) AS credit",
        )
        .unionByName(
            turnover.filter(F.col("on_date").between(first, last)).selectExpr(
                "account_rk",
                f"CAST(NULL AS {_AMOUNT}) AS opening",
                f"CAST(NULL AS {_AMOUNT}) AS closing",
                "debet_amount_rub AS debet",
                "credit_amount_rub AS credit",
            )
        )
        .groupBy("account_rk")
        .agg(
            *[
                F.expr(f"CAST(sum({c}) AS {_AMOUNT}) AS {c}")
                for c in ("opening", "debet", "credit", "closing")
            ]
        )
    )
    touches = overlaps(
        F.col("data_actual_date"), F.col("data_actual_end_date"), first, last
    )
    codes = ", ".join(f"'{c}'" for c in HOME_CURRENCY_CODES)
    prefix = f"substring(account_number, 1, {LEDGER_DIGITS})"
    lines = (
        accounts.filter(touches)
        .selectExpr(
            "account_rk",
            f"{prefix} AS prefix",
            f"try_cast({prefix} AS INT) AS ledger_account",
            "char_type AS characteristic",
            f"currency_code IN ({codes}) AS home",
        )
        .join(ledger.select("ledger_account", "chapter"), "ledger_account", "left")
        .join(facts, "account_rk", "left")
    )
    sums = [
        F.expr(f"sum({value}) AS {measure}_{scope}")
        for measure, fact in _MEASURES.items()
        for scope, value in {
            "rub": f"CASE WHEN home THEN {fact} ELSE 0 END",
            "val": f"CASE WHEN NOT home THEN {fact} ELSE 0 END",
            "total": fact,
        }.items()
    ]
    grouped = lines.groupBy("chapter", "prefix", "characteristic").agg(*sums)
    chapter = F.col("chapter")
    if not allow_unmapped:
        chapter = F.expr(
            """IF(chapter IS NULL,
                 raise_error(concat('no ledger account for prefix ', prefix)), chapter)"""
        )
    keys = {
        "from_date": first,
        "to_date": last,
        "chapter": chapter,
        "ledger_account": F.col("prefix"),
        "characteristic": F.col("characteristic"),
    }
    measured = set(grouped.columns)
    return grouped.select(
        *[
            keys[f.name].alias(f.name)
            if f.name in keys
            else F.expr(f"CAST({f.name if f.name in measured else 'NULL'} AS {_AMOUNT}) AS {f.name}")
            for f in LEDGER_REPORT.schema
        ]
    )
