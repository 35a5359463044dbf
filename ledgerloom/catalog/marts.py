"""Registered queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.catalog import inputs as I
from ledgerloom.functions.casts import empty_columns, typed
from ledgerloom.plans.balance_blocks import balance_in_blocks
from ledgerloom.plans.balance import balance_for_day, balance_for_period, seed_balance
from ledgerloom.plans.balance_repair import (
    apply_opening_correction,
    balance_turnover,
    correct_closing,
    correct_opening,
)
from ledgerloom.plans.jobs import Warehouse
from ledgerloom.plans.ledger_report import ledger_report
from ledgerloom.plans.loan_holiday import loan_holiday_info
from ledgerloom.plans.turnover import account_turnover
from ledgerloom.sources.csv_files import Delimited, read_delimited, write_delimited
from ledgerloom.sources.tables import TableStore, shared_folder


def _turnover(spark, sf_dir, first, last=None, real_dates=False) -> DataFrame:
    return account_turnover(
        I.postings(spark, sf_dir, real_dates),
        I.accounts(spark, sf_dir),
        I.rates(spark, sf_dir),
        first,
        last,
    )


def turnover_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turnover(spark, sf_dir, I.ONE_DAY)


def turnover_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turnover(spark, sf_dir, I.MONTH_START, I.MONTH_END)


def turnover_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders on their real days, from the first to the last, in one plan."""
    day = F.col("oper_date")
    first, last = I.postings(spark, sf_dir, True).agg(F.min(day), F.max(day)).first()
    return _turnover(spark, sf_dir, first or I.MONTH_START, last or I.MONTH_END, real_dates=True)


def balance_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_balance(
        I.opening_balances(spark, sf_dir), I.rates(spark, sf_dir), I.SEED_DAY
    )


def balance_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First day of the month, from the seed."""
    return balance_for_day(
        I.accounts(spark, sf_dir),
        _turnover(spark, sf_dir, I.MONTH_START),
        balance_seed(spark, sf_dir),
        I.MONTH_START,
    )


def balance_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_for_period(
        I.accounts(spark, sf_dir),
        turnover_month(spark, sf_dir),
        balance_seed(spark, sf_dir),
        I.MONTH_START,
        I.MONTH_END,
    )


def balance_period_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by blocks of a week, an account's history being several tasks."""
    return balance_in_blocks(
        I.accounts(spark, sf_dir),
        turnover_month(spark, sf_dir),
        balance_seed(spark, sf_dir),
        I.MONTH_START,
        I.MONTH_END,
        block_days=7,
    )


def _report(spark: SparkSession, sf_dir: str, complete: bool) -> DataFrame:
    # Needed for the balances and for the report: both read one exchange.
    turnover = turnover_month(spark, sf_dir)
    seed = balance_seed(spark, sf_dir)
    accounts = I.accounts(spark, sf_dir)
    closing = balance_for_period(
        accounts, turnover, seed, I.MONTH_START, I.MONTH_END, shown_from=I.MONTH_END
    )
    return ledger_report(
        accounts,
        I.ledger_accounts(spark, sf_dir, complete),
        seed.unionByName(closing),
        turnover,
        I.REPORT_DAY,
        allow_unmapped=not complete,
    )


def ledger_report_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, complete=True)


def ledger_report_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ledger accounts are missing; their lines keep a NULL chapter."""
    return _report(spark, sf_dir, complete=False)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written as a delimited file with NULL texts and read back."""
    path = shared_folder(spark, "report_csv")
    write_delimited(ledger_report_month(spark, sf_dir), path)
    return typed(
        read_delimited(spark, path, S.LEDGER_REPORT.columns), S.LEDGER_REPORT
    )


def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separators, quotes, Cyrillic letters and missing values survive a file."""
    part = I.table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_rk",
        """CASE WHEN p_brand = 'Brand#1' THEN NULL
             ELSE concat('Счёт; "', p_name, '", ', p_type) END AS product_name""",
    )
    style = Delimited(sep=",")
    path = shared_folder(spark, "text_csv")
    write_delimited(part, path, style)
    return read_delimited(spark, path, part.columns, style).select(
        F.col("product_rk").cast("bigint").alias("product_rk"), "product_name"
    )


def csv_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file in a single-byte Cyrillic code page is recognised and decoded."""
    part = I.table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_rk", "concat('Счёт ', p_name) AS product_name"
    )
    style = Delimited()
    path = shared_folder(spark, "encoded_csv")
    write_delimited(part, path, style, encoding="windows-1251")
    return read_delimited(spark, path, part.columns, style).select(
        F.col("product_rk").cast("bigint").alias("product_rk"), "product_name"
    )


def stored_ledger_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by way of the jobs: every layer written, read and audited."""
    root = shared_folder(spark, "month")
    house = Warehouse(TableStore(spark, root))
    store = house.store
    store.rewrite(S.POSTING, I.postings(spark, sf_dir))
    store.rewrite(S.ACCOUNT, I.accounts(spark, sf_dir))
    store.rewrite(S.EXCHANGE_RATE, I.rates(spark, sf_dir))
    store.rewrite(
        S.LEDGER_ACCOUNT,
        empty_columns(I.ledger_accounts(spark, sf_dir), S.LEDGER_ACCOUNT),
    )
    store.replace_dates(S.BALANCE, I.opening_balances(spark, sf_dir), [I.SEED_DAY])
    house.fill_turnover(I.MONTH_START, I.MONTH_END)
    house.seed_balances(I.SEED_DAY)
    house.fill_balances(I.MONTH_START, I.MONTH_END)
    house.fill_ledger_report(I.REPORT_DAY)
    return store.read(S.LEDGER_REPORT)


def mart_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account's row of one day of the stored balance mart."""
    store = TableStore(spark, shared_folder(spark, "lookup"))
    store.replace_dates(S.DAILY_BALANCE, balance_seed(spark, sf_dir), [I.SEED_DAY])
    return store.look_up(S.DAILY_BALANCE, on_date=I.SEED_DAY, account_rk=1)


def holiday_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_holiday_info(
        I.deals(spark, sf_dir), I.holidays(spark, sf_dir), I.products(spark, sf_dir)
    )


def correct_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct_opening(I.daily_sums(spark, sf_dir))


def correct_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct_closing(I.daily_sums(spark, sf_dir))


def apply_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_opening_correction(I.daily_sums(spark, sf_dir))


def balance_turnover_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance_turnover(
        I.source_accounts(spark, sf_dir),
        I.daily_sums(spark, sf_dir),
        I.currency_names(spark, sf_dir),
    )


QUERIES = {
    "turnover_day": turnover_day,
    "turnover_month": turnover_month,
    "turnover_period": turnover_period,
    "balance_seed": balance_seed,
    "balance_day": balance_day,
    "balance_period": balance_period,
    "balance_period_blocks": balance_period_blocks,
    "ledger_report": ledger_report_month,
    "ledger_report_unmapped": ledger_report_unmapped,
    "csv_roundtrip": csv_roundtrip,
    "csv_text_roundtrip": csv_text_roundtrip,
    "csv_encoding": csv_encoding,
    "stored_ledger_report": stored_ledger_report,
    "mart_lookup": mart_lookup,
    "holiday_mart": holiday_mart,
    "correct_in": correct_in,
    "correct_out": correct_out,
    "apply_correction": apply_correction,
    "balance_turnover_mart": balance_turnover_mart,
}

# --- independent SQL -------------------------------------------------------

_A = "CAST({0} AS DECIMAL(23,8))"


# A rate for each currency and day it holds on; several if periods overlap.
_PRICE = """SELECT currency_rk, reduced_cource AS price,
      CAST(unnest(generate_series(data_actual_date, data_actual_end_date, INTERVAL 1 DAY)) AS DATE) AS day
    FROM rate"""


def _turnover_sql(posting: str, first=None, last=None) -> str:
    """Each side summed by itself; the sides meet per account and day. Without
    dates, all days there are."""
    days = f"oper_date >= DATE '{first}' AND oper_date <= DATE '{last}'" if first else "oper_date IS NOT NULL"

    def side(name: str) -> str:
        return f"""SELECT oper_date AS day, {name}_account_rk AS account_rk,
          CAST(sum({name}_amount) AS DECIMAL(20,8)) AS {name}
        FROM {posting} WHERE {days} GROUP BY ALL"""

    amounts = ", ".join(
        f"""{_A.format(name)} AS {name}_amount, {_A.format(f'{name} * unit')} AS {name}_amount_rub"""
        for name in ("credit", "debet")
    )
    return f"""SELECT day AS on_date, account_rk, {amounts} FROM (
      SELECT day, account_rk, COALESCE(credit, CAST(0 AS DECIMAL(20,8))) AS credit,
        COALESCE(debet, CAST(0 AS DECIMAL(20,8))) AS debet,
        COALESCE(price, CAST(1 AS DECIMAL(12,8))) AS unit
      FROM (SELECT * FROM ({side('credit')}) FULL JOIN ({side('debet')}) USING (day, account_rk))
      LEFT JOIN (SELECT account_rk, currency_rk FROM account) USING (account_rk)
      LEFT JOIN ({_PRICE}) USING (currency_rk, day))"""


_SEED_SQL = f"""SELECT DATE '{I.SEED_DAY}' AS on_date, o.account_rk, o.balance_out,
      {_A.format('o.balance_out * COALESCE(p.price, CAST(1 AS DECIMAL(12,8)))')} AS balance_out_rub
    FROM (SELECT * FROM ({_PRICE}) WHERE day = DATE '{I.SEED_DAY}') p
    RIGHT JOIN opening o USING (currency_rk)"""


def _signed_sql(before: str, suffix: str) -> str:
    debet, credit = f"COALESCE(t.debet_amount{suffix}, 0)", f"COALESCE(t.credit_amount{suffix}, 0)"
    return _A.format(
        f"""CASE a.char_type WHEN 'А' THEN COALESCE({before}, 0) + {debet} - {credit}
        WHEN 'П' THEN COALESCE({before}, 0) - {debet} + {credit} END"""
    )


# The month as a literal day-by-day recursion, one chain per account.
_CHAIN_SQL = f"""SELECT a.account_rk, DATE '{I.SEED_DAY}' AS on_date, TRUE AS valid,
      s.balance_out, s.balance_out_rub
    FROM account a LEFT JOIN seed s ON s.account_rk = a.account_rk
    UNION ALL
    SELECT a.account_rk, c.on_date + 1,
      c.on_date + 1 BETWEEN a.data_actual_date
        AND COALESCE(a.data_actual_end_date, c.on_date + 1),
      {_signed_sql('CASE WHEN c.valid THEN c.balance_out END', '')},
      {_signed_sql('CASE WHEN c.valid THEN c.balance_out_rub END', '_rub')}
    FROM chain c JOIN account a ON a.account_rk = c.account_rk
    LEFT JOIN turnover t ON t.account_rk = c.account_rk AND t.on_date = c.on_date + 1
    WHERE c.on_date < DATE '{I.MONTH_END}'"""

_PERIOD_SQL = f"""SELECT on_date, account_rk, balance_out, balance_out_rub
    FROM chain WHERE valid AND on_date >= DATE '{I.MONTH_START}'"""

_MONTH = {
    "turnover": _turnover_sql("posting", I.MONTH_START, I.MONTH_END),
    "seed": _SEED_SQL,
    "chain": _CHAIN_SQL,
    "balance": f"SELECT * FROM seed UNION ALL {_PERIOD_SQL}",
}
_LEDGER_INPUTS = ("account", "posting", "rate", "opening")


def _report_sql(ledger: str) -> str:
    """Figures per account as rows of (measure, amount), then a cross table."""
    figures = {
        "balance_in": ("balance_out_rub", f"balance WHERE on_date = DATE '{I.SEED_DAY}'"),
        "balance_out": ("balance_out_rub", f"balance WHERE on_date = DATE '{I.MONTH_END}'"),
        "turn_deb": ("debet_amount_rub", "turnover"),
        "turn_cre": ("credit_amount_rub", "turnover"),
    }
    rows = " UNION ALL ".join(
        f"SELECT account_rk, '{name}' AS measure, {value} AS amount FROM {source}"
        for name, (value, source) in figures.items()
    )
    cells = []
    for name in figures:
        total = f"sum(amount) FILTER (measure = '{name}')"
        for scope, here, others in (("rub", "home", "abroad"), ("val", "abroad", "home")):
            part = f"sum(amount) FILTER (measure = '{name}' AND class = '{here}')"
            # Accounts of the other class count as nothing, which is not NULL.
            cells.append(
                f"""{_A.format(f"CASE WHEN bool_or(class = '{others}') THEN COALESCE({part}, 0) ELSE {part} END")}
        AS {name}_{scope}"""
            )
        cells.append(f"{_A.format(total)} AS {name}_total")
    twins = [f"{_A.format('NULL')} AS r_{m}" for m in S.REPORT_MEASURES]
    body = f"""SELECT DATE '{I.MONTH_START}' AS from_date, DATE '{I.MONTH_END}' AS to_date,
      (SELECT any_value(c.chapter) FROM {ledger} c WHERE c.ledger_account = CAST(prefix AS INTEGER)) AS chapter,
      prefix AS ledger_account, kind AS characteristic, {', '.join(cells + twins)}
    FROM (SELECT account_rk, left(account_number, 5) AS prefix, char_type AS kind,
            CASE currency_code WHEN '810' THEN 'home' WHEN '643' THEN 'home' ELSE 'abroad' END AS class
          FROM account
          WHERE NOT (data_actual_date > DATE '{I.MONTH_END}'
            OR COALESCE(data_actual_end_date < DATE '{I.MONTH_START}', FALSE)))
    LEFT JOIN ({rows}) USING (account_rk)
    GROUP BY prefix, kind"""
    return _recursive(body, *_LEDGER_INPUTS, ledger)


def _recursive(body: str, *names: str) -> str:
    sql = I.with_inputs(body, *names, more=_MONTH)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


# For each day, the sums on the other side of midnight.
_EVENINGS = """evening AS (SELECT account_rk, effective_date + 1 AS effective_date,
      list(account_out_sum) AS sums FROM daily_sum GROUP BY ALL)"""
_MORNINGS = """morning AS (SELECT account_rk, effective_date - 1 AS effective_date,
      list(account_in_sum) AS sums FROM daily_sum GROUP BY ALL)"""


def _mended_sql(columns: str, known: str, others: str, body: str) -> str:
    """``fixes``: of the sums over midnight, those that are not the known one."""
    sql = I.with_inputs(body, "daily_sum")
    fixes = f"""fixed AS (SELECT d.*, list_filter(m.sums, lambda x: x <> d.{known}) AS fixes
      FROM daily_sum d LEFT JOIN {columns} m USING (account_rk, effective_date))"""
    head, _, tail = sql.rpartition(body)
    return f"{head.rstrip()}, {others}, {fixes} {body}{tail}"


ORACLE = {
    "turnover_day": I.with_inputs(
        _turnover_sql("posting", I.ONE_DAY, I.ONE_DAY), "account", "posting", "rate"
    ),
    "turnover_month": I.with_inputs(_MONTH["turnover"], "account", "posting", "rate"),
    "turnover_period": I.with_inputs(
        _turnover_sql("posting_all"),
        "account",
        "posting_all",
        "rate",
    ),
    "balance_seed": I.with_inputs(_SEED_SQL, "opening", "rate"),
    "balance_day": _recursive(
        f"{_PERIOD_SQL} AND on_date = DATE '{I.MONTH_START}'", *_LEDGER_INPUTS
    ),
    "balance_period": _recursive(_PERIOD_SQL, *_LEDGER_INPUTS),
    "balance_period_blocks": _recursive(_PERIOD_SQL, *_LEDGER_INPUTS),
    "ledger_report": _report_sql("ledger"),
    "ledger_report_unmapped": _report_sql("ledger_part"),
    "csv_roundtrip": _report_sql("ledger"),
    "csv_encoding": """SELECT p_partkey AS product_rk, 'Счёт ' || p_name AS product_name
    FROM part""",
    "stored_ledger_report": _report_sql("ledger"),
    "csv_text_roundtrip": """SELECT p_partkey AS product_rk,
      CASE WHEN p_brand = 'Brand#1' THEN NULL
        ELSE 'Счёт; "' || p_name || '", ' || p_type END AS product_name
    FROM part""",
    "holiday_mart": I.with_inputs(
        "SELECT "
        + ", ".join(
            {
                "effective_from_date": "h.effective_from_date",
                "effective_to_date": "h.effective_to_date",
                "product_name": "p.product_name",
                "deal_number": "d.deal_num AS deal_number",
            }.get(c, f"h.{c}" if c.startswith("loan_holiday") else f"d.{c}")
            for c in S.LOAN_HOLIDAY_INFO.columns
        )
        + """ FROM deal d
    LEFT JOIN holiday h ON h.deal_rk = d.deal_rk
      AND h.effective_from_date = d.effective_from_date
    LEFT JOIN product p ON p.product_rk = d.product_rk
      AND p.effective_from_date = d.effective_from_date""",
        "deal",
        "holiday",
        "product",
    ),
    "correct_in": _mended_sql(
        "evening",
        "account_in_sum",
        _EVENINGS,
        "SELECT account_rk, effective_date, unnest(fixes) AS correct_account_in_sum FROM fixed",
    ),
    "correct_out": _mended_sql(
        "morning",
        "account_out_sum",
        _MORNINGS,
        "SELECT account_rk, effective_date, unnest(fixes) AS correct_account_out_sum FROM fixed",
    ),
    "apply_correction": _mended_sql(
        "evening",
        "account_in_sum",
        _EVENINGS,
        """SELECT account_rk, effective_date, account_out_sum,
      CASE WHEN len(fixes) > 0 THEN fixes[1] ELSE account_in_sum END AS account_in_sum FROM fixed""",
    ),
    "balance_turnover_mart": I.with_inputs(
        """SELECT account_rk, COALESCE((SELECT any_value(n.currency_name) FROM currency_name n
        WHERE n.currency_cd = s.currency_cd), '-1') AS currency_name,
      s.department_rk, effective_date, account_in_sum, account_out_sum
    FROM daily_sum RIGHT JOIN source_account s USING (account_rk)""",
        "source_account",
        "daily_sum",
        "currency_name",
    ),
    "mart_lookup": I.with_inputs(
        f"SELECT * FROM ({_SEED_SQL}) WHERE account_rk = 1", "opening", "rate"
    ),
}
