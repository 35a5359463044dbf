"""Ledger-shaped inputs derived from the star-schema tables, and their SQL twins.

Each input is a projection of whole tables. What makes the data interesting
(unknown accounts, closed accounts, missing rates, repeated and changed rows)
follows from attributes such as segment, priority or nation, so every row of
the source takes part at any size. On purpose about two fifths of the postings
hit one account and more than a third of the accounts share one currency.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerloom.operators.lookup import dealt

MONTH_START = dt.date(1995, 1, 1)
MONTH_END = dt.date(1995, 1, 31)
SEED_DAY = dt.date(1994, 12, 31)
REPORT_DAY = dt.date(1995, 2, 1)
ONE_DAY = dt.date(1995, 1, 10)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its footer is looked up once, however often it is read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# --- ledger ----------------------------------------------------------------


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "DATE '1995-01-01' AS data_actual_date",
        """CASE c_mktsegment WHEN 'BUILDING' THEN DATE '1995-01-15'
             WHEN 'FURNITURE' THEN NULL ELSE DATE '1995-12-31' END AS data_actual_end_date""",
        "c_custkey AS account_rk",
        """concat(CAST(30100 + c_nationkey % 18 AS STRING),
             lpad(CAST(c_custkey AS STRING), 15, '0')) AS account_number""",
        """CASE WHEN c_nationkey = 24 THEN 'X' WHEN c_custkey % 2 = 0 THEN 'А'
             ELSE 'П' END AS char_type""",
        "CAST(CASE WHEN c_nationkey <= 8 THEN 0 ELSE c_nationkey END AS BIGINT) AS currency_rk",
        """CASE WHEN c_nationkey <= 4 THEN '643' WHEN c_nationkey <= 8 THEN '810'
             ELSE CAST(100 + c_nationkey AS STRING) END AS currency_code""",
    )


def postings(spark: SparkSession, sf_dir: str, real_dates: bool = False) -> DataFrame:
    """All orders as postings, on their own day or on that day of one month."""
    day = (
        "CAST(o_orderdate AS DATE)"
        if real_dates
        else """date_add(DATE '1995-01-01',
             datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01') % 31)"""
    )
    amount = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(23,8))"
    return table(spark, sf_dir, "orders").selectExpr(
        f"{day} AS oper_date",
        "o_custkey AS credit_account_rk",
        """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(-1 AS BIGINT)
             ELSE o_orderkey div 10 END AS debet_account_rk""",
        f"{amount} AS credit_amount",
        f"{amount} AS debet_amount",
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .filter("n_nationkey > 8")
        .selectExpr("n_nationkey", "explode(sequence(-1, 366)) AS week")
        .selectExpr(
            "date_add(DATE '1995-01-01', 7 * week) AS data_actual_date",
            """CASE WHEN n_nationkey = 10 THEN NULL
                 ELSE date_add(DATE '1995-01-01', 7 * week + 6) END AS data_actual_end_date""",
            "CAST(n_nationkey AS BIGINT) AS currency_rk",
            """CAST(1 + n_nationkey * 0.25BD + week * 0.01BD AS DECIMAL(12,8))
                 AS reduced_cource""",
            "CAST(100 + n_nationkey AS STRING) AS code_iso_num",
        )
    )


def opening_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts in debt have no stored opening balance."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal > 0")
        .selectExpr(
            "DATE '1994-12-31' AS on_date",
            "c_custkey AS account_rk",
            "CAST(CASE WHEN c_nationkey <= 8 THEN 0 ELSE c_nationkey END AS BIGINT) AS currency_rk",
            "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS balance_out",
        )
    )


def ledger_accounts(spark: SparkSession, sf_dir: str, complete: bool = True) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    if not complete:
        nation = nation.filter("n_nationkey NOT IN (16, 17)")
    return nation.selectExpr(
        "30100 + n_nationkey % 18 AS ledger_account",
        "CASE WHEN n_nationkey % 18 < 9 THEN 'А' ELSE 'В' END AS chapter",
    ).distinct()


# --- source copies ---------------------------------------------------------

_VERSION_BY_STATUS = """CASE o_orderstatus WHEN 'F' THEN DATE '2023-01-01'
     WHEN 'O' THEN DATE '2023-03-15' ELSE DATE '2023-08-11' END"""
_VERSION_BY_TYPE = """CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN DATE '2023-01-01'
     WHEN p_type IN ('MEDIUM', 'PROMO') THEN DATE '2023-03-15'
     ELSE DATE '2023-08-11' END"""
_OPEN_END = "DATE '2999-12-31'"


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deals; the product is the lowest part of the order's lines."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg({"l_partkey": "min"})
        .toDF("o_orderkey", "product_rk")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey", "left")
        .selectExpr(
            "o_orderkey AS deal_rk",
            "concat('N', CAST(o_orderkey AS STRING)) AS deal_num",
            "concat('Deal ', o_orderpriority) AS deal_name",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS deal_sum",
            "o_custkey AS client_rk",
            "o_custkey AS account_rk",
            "o_orderkey AS agreement_rk",
            "CAST(o_orderdate AS DATE) AS deal_start_date",
            "o_custkey % 25 AS department_rk",
            "product_rk",
            "o_orderstatus AS deal_type_cd",
            f"{_VERSION_BY_STATUS} AS effective_from_date",
            f"{_OPEN_END} AS effective_to_date",
        )
    )


def deals_in_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals of the middle version; the low-priority ones occur twice."""
    late = deals(spark, sf_dir).filter("deal_type_cd = 'O'")
    return late.unionByName(late.filter("deal_name = 'Deal 5-LOW'"))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every deal but the urgent ones had a loan holiday."""
    start = "date_add(DATE '2023-01-01', CAST(o_orderkey % 90 AS INT))"
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority <> '1-URGENT'")
        .selectExpr(
            "o_orderkey AS deal_rk",
            "substring(o_orderpriority, 1, 1) AS loan_holiday_type_cd",
            f"{start} AS loan_holiday_start_date",
            f"date_add({start}, 180) AS loan_holiday_finish_date",
            f"""CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                  ELSE date_add({start}, 170) END AS loan_holiday_fact_finish_date""",
            "CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS loan_holiday_finish_flg",
            f"date_add({start}, 365) AS loan_holiday_last_possible_date",
            f"{_VERSION_BY_STATUS} AS effective_from_date",
            f"{_OPEN_END} AS effective_to_date",
        )
    )


def _named_part(part: DataFrame, name: str, version: str) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS product_rk",
        f"{name} AS product_name",
        f"{version} AS effective_from_date",
        f"{_OPEN_END} AS effective_to_date",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product versions; one brand is stored under two names."""
    part = table(spark, sf_dir, "part")
    return _named_part(part, "p_name", _VERSION_BY_TYPE).unionByName(
        _named_part(
            part.filter("p_brand = 'Brand#4'"), "concat(p_name, '*')", _VERSION_BY_TYPE
        )
    )


_ONE_VERSION = "DATE '2023-03-15'"


def product_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older state: small sizes only, one brand misspelt, one stored twice."""
    small = table(spark, sf_dir, "part").filter("p_size <= 25")
    name = "CASE WHEN p_brand = 'Brand#2' THEN concat('x', p_name) ELSE p_name END"
    return _named_part(small, name, _ONE_VERSION).unionByName(
        _named_part(small.filter("p_brand = 'Brand#3'"), name, _ONE_VERSION)
    )


def product_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer state: every part, one brand under a second name as well."""
    part = table(spark, sf_dir, "part")
    return _named_part(part, "p_name", _ONE_VERSION).unionByName(
        _named_part(
            part.filter("p_brand = 'Brand#4'"), "concat(p_name, '*')", _ONE_VERSION
        )
    )


def client_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versions of a client record, many per client and day."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id AS client_rk",
        "CAST(ts AS DATE) AS effective_from_date",
        """CASE WHEN event_type = 'signup' THEN NULL
             ELSE date_add(CAST(ts AS DATE), length(event_type)) END AS effective_to_date""",
        "ts AS client_open_dttm",
        "event_id",
        "props",
    )


def daily_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of opening and closing sums per account.

    One nation misses a day, one has no sums at all, and on day i the opening
    sums of nation i do not meet the closing sums of the day before. The
    customers are dealt out before they become ten rows each: a small file is
    one task, and whatever groups the sums would hold all of them in it.
    """
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal"
    )
    return (
        dealt(customers.filter("c_nationkey <> 9"))
        .selectExpr("*", "explode(sequence(0, 9)) AS i")
        .filter("NOT (c_nationkey = 7 AND i = 5)")
        .selectExpr(
            "c_custkey AS account_rk",
            "date_add(DATE '2024-01-01', i) AS effective_date",
            """CAST(CAST(c_acctbal AS DECIMAL(18,2)) + i * 10
                 + CASE WHEN c_nationkey = i THEN 5 ELSE 0 END AS DECIMAL(23,8))
                 AS account_in_sum""",
            """CAST(CAST(c_acctbal AS DECIMAL(18,2)) + (i + 1) * 10 AS DECIMAL(23,8))
                 AS account_out_sum""",
        )
    )


def source_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS account_rk",
        "CAST(c_nationkey AS BIGINT) AS department_rk",
        "CAST(c_nationkey AS STRING) AS currency_cd",
    )


def currency_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .filter("n_nationkey <> 3")
        .selectExpr(
            "CAST(n_nationkey AS STRING) AS currency_cd", "n_name AS currency_name"
        )
    )


def account_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days per customer: irregular, with repeated days."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS account_rk", "CAST(o_orderdate AS DATE) AS effective_date"
    )


# --- the same inputs for the independent SQL check --------------------------

_SQL_VERSION_BY_STATUS, _SQL_VERSION_BY_TYPE = _VERSION_BY_STATUS, _VERSION_BY_TYPE
_MONEY = "CAST(CAST({0} AS DECIMAL(18,2)) AS DECIMAL(23,8))"
_SQL_RUB_KEY = "CAST(CASE WHEN c_nationkey <= 8 THEN 0 ELSE c_nationkey END AS BIGINT)"
_HOLIDAY_START = "(DATE '2023-01-01' + CAST(o_orderkey % 90 AS INTEGER))"


def _posting_sql(day: str) -> str:
    return f"""SELECT {day} AS oper_date, o_custkey AS credit_account_rk,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN -1
        ELSE o_orderkey // 10 END AS debet_account_rk,
      {_MONEY.format('o_totalprice')} AS credit_amount,
      {_MONEY.format('o_totalprice')} AS debet_amount
    FROM orders"""


def _part_sql(name: str, version: str, where: str = "TRUE") -> str:
    return f"""SELECT p_partkey AS product_rk, {name} AS product_name,
      {version} AS effective_from_date, DATE '2999-12-31' AS effective_to_date
    FROM part WHERE {where}"""


_MISSPELT = "CASE WHEN p_brand = 'Brand#2' THEN 'x' || p_name ELSE p_name END"

SQL = {
    "account": f"""SELECT DATE '1995-01-01' AS data_actual_date,
      CASE c_mktsegment WHEN 'BUILDING' THEN DATE '1995-01-15'
        WHEN 'FURNITURE' THEN NULL ELSE DATE '1995-12-31' END AS data_actual_end_date,
      c_custkey AS account_rk,
      CAST(30100 + c_nationkey % 18 AS VARCHAR)
        || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS account_number,
      CASE WHEN c_nationkey = 24 THEN 'X' WHEN c_custkey % 2 = 0 THEN 'А'
        ELSE 'П' END AS char_type,
      {_SQL_RUB_KEY} AS currency_rk,
      CASE WHEN c_nationkey <= 4 THEN '643' WHEN c_nationkey <= 8 THEN '810'
        ELSE CAST(100 + c_nationkey AS VARCHAR) END AS currency_code
    FROM customer""",
    "posting": _posting_sql(
        """(DATE '1995-01-01' + CAST(
        date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 31 AS INTEGER))"""
    ),
    "posting_all": _posting_sql("CAST(o_orderdate AS DATE)"),
    "rate": """SELECT DATE '1995-01-01' + CAST(7 * week AS INTEGER) AS data_actual_date,
      CASE WHEN n_nationkey = 10 THEN NULL
        ELSE DATE '1995-01-01' + CAST(7 * week + 6 AS INTEGER) END AS data_actual_end_date,
      CAST(n_nationkey AS BIGINT) AS currency_rk,
      CAST(1 + n_nationkey * 0.25 + week * 0.01 AS DECIMAL(12,8)) AS reduced_cource,
      CAST(100 + n_nationkey AS VARCHAR) AS code_iso_num
    FROM nation, range(-1, 367) AS weeks(week) WHERE n_nationkey > 8""",
    "opening": f"""SELECT DATE '1994-12-31' AS on_date, c_custkey AS account_rk,
      {_SQL_RUB_KEY} AS currency_rk, {_MONEY.format('c_acctbal')} AS balance_out
    FROM customer WHERE c_acctbal > 0""",
    "ledger": """SELECT DISTINCT 30100 + n_nationkey % 18 AS ledger_account,
      CASE WHEN n_nationkey % 18 < 9 THEN 'А' ELSE 'В' END AS chapter
    FROM nation""",
    "ledger_part": """SELECT DISTINCT 30100 + n_nationkey % 18 AS ledger_account,
      CASE WHEN n_nationkey % 18 < 9 THEN 'А' ELSE 'В' END AS chapter
    FROM nation WHERE n_nationkey NOT IN (16, 17)""",
    "deal": f"""SELECT o_orderkey AS deal_rk, 'N' || CAST(o_orderkey AS VARCHAR) AS deal_num,
      'Deal ' || o_orderpriority AS deal_name, {_MONEY.format('o_totalprice')} AS deal_sum,
      o_custkey AS client_rk, o_custkey AS account_rk, o_orderkey AS agreement_rk,
      CAST(o_orderdate AS DATE) AS deal_start_date, o_custkey % 25 AS department_rk,
      (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS product_rk,
      o_orderstatus AS deal_type_cd, {_SQL_VERSION_BY_STATUS} AS effective_from_date,
      DATE '2999-12-31' AS effective_to_date
    FROM orders""",
    "deal_file": """SELECT * FROM deal WHERE deal_type_cd = 'O'
      UNION ALL
      SELECT * FROM deal WHERE deal_type_cd = 'O' AND deal_name = 'Deal 5-LOW'""",
    "holiday": f"""SELECT o_orderkey AS deal_rk,
      substring(o_orderpriority, 1, 1) AS loan_holiday_type_cd,
      {_HOLIDAY_START} AS loan_holiday_start_date,
      {_HOLIDAY_START} + 180 AS loan_holiday_finish_date,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {_HOLIDAY_START} + 170 END
        AS loan_holiday_fact_finish_date,
      CASE WHEN o_orderpriority = '2-HIGH' THEN 'Y' ELSE 'N' END AS loan_holiday_finish_flg,
      {_HOLIDAY_START} + 365 AS loan_holiday_last_possible_date,
      {_SQL_VERSION_BY_STATUS} AS effective_from_date,
      DATE '2999-12-31' AS effective_to_date
    FROM orders WHERE o_orderpriority <> '1-URGENT'""",
    "product": _part_sql("p_name", _SQL_VERSION_BY_TYPE)
    + " UNION ALL "
    + _part_sql("p_name || '*'", _SQL_VERSION_BY_TYPE, "p_brand = 'Brand#4'"),
    "product_table": _part_sql(_MISSPELT, _ONE_VERSION, "p_size <= 25")
    + " UNION ALL "
    + _part_sql(_MISSPELT, _ONE_VERSION, "p_size <= 25 AND p_brand = 'Brand#3'"),
    "product_file": _part_sql("p_name", _ONE_VERSION)
    + " UNION ALL "
    + _part_sql("p_name || '*'", _ONE_VERSION, "p_brand = 'Brand#4'"),
    "client": """SELECT user_id AS client_rk, CAST(ts AS DATE) AS effective_from_date,
      CASE WHEN event_type = 'signup' THEN NULL
        ELSE CAST(ts AS DATE) + CAST(length(event_type) AS INTEGER) END AS effective_to_date,
      ts AS client_open_dttm, event_id, props
    FROM events""",
    "daily_sum": """SELECT c_custkey AS account_rk,
      DATE '2024-01-01' + CAST(i AS INTEGER) AS effective_date,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) + i * 10
        + CASE WHEN c_nationkey = i THEN 5 ELSE 0 END AS DECIMAL(23,8)) AS account_in_sum,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) + (i + 1) * 10 AS DECIMAL(23,8)) AS account_out_sum
    FROM customer, range(0, 10) AS days(i)
    WHERE c_nationkey <> 9 AND NOT (c_nationkey = 7 AND i = 5)""",
    "source_account": """SELECT c_custkey AS account_rk,
      CAST(c_nationkey AS BIGINT) AS department_rk,
      CAST(c_nationkey AS VARCHAR) AS currency_cd FROM customer""",
    "currency_name": """SELECT CAST(n_nationkey AS VARCHAR) AS currency_cd,
      n_name AS currency_name FROM nation WHERE n_nationkey <> 3""",
    "account_day": """SELECT o_custkey AS account_rk,
      CAST(o_orderdate AS DATE) AS effective_date FROM orders""",
}


def with_inputs(body: str, *names: str, more: dict[str, str] | None = None) -> str:
    """``body`` under a WITH clause of the named inputs (and any ``more``)."""
    parts = {n: SQL[n] for n in names} | (more or {})
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {ctes}\n{body}"
