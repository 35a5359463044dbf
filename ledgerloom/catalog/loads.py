"""Registered queries over the keyed loads: text rows in, typed tables out.

Every stage is a whole table in the all-text form a delimited file has, plus
changed, repeated and unacceptable rows; every target is what an earlier load
left: all customers outside one segment, some with other values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.catalog import inputs as I
from ledgerloom.functions.casts import DOTTED_DATE, ISO_DATE, empty_columns, typed
from ledgerloom.functions.messages import lines_summary, mismatch_lines
from ledgerloom.functions.predicates import valid_currency
from ledgerloom.operators import upsert as U
from ledgerloom.operators.first_values import first_of_all
from ledgerloom.plans.audit import AuditLog
from ledgerloom.plans.jobs import IngestSpec, Warehouse
from ledgerloom.session import at_once
from ledgerloom.sources.csv_files import Delimited, write_delimited
from ledgerloom.sources.tables import TableStore, shared_folder
from ledgerloom.streaming.file_drop import load_dropped_files


@dataclass(frozen=True)
class Load:
    """A keyed load over derived inputs."""

    spec: S.TableSpec
    date_pattern: str
    stage_text: Callable[[SparkSession, str], DataFrame]
    target: Callable[[SparkSession, str], DataFrame]
    columns: Sequence[str] | None = None
    valid: Callable[[], Column] | None = None

    @property
    def wanted(self) -> list[str]:
        return list(self.columns or self.spec.columns)

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.wanted if c not in self.spec.key]

    def stage(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return typed(
            self.stage_text(spark, sf_dir), self.spec, self.date_pattern, self.wanted
        )

    def _by(self, way: Callable[..., DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
        return way(
            self.target(spark, sf_dir),
            self.stage(spark, sf_dir),
            self.spec.key,
            self.attributes,
            self.valid() if self.valid else None,
        )

    def merged(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self._by(U.merge_rows, spark, sf_dir)

    def snapshot(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return U.snapshot(self.merged(spark, sf_dir))

    def probed(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The snapshot by the form that leaves the target where it is."""
        return U.snapshot(self._by(U.merge_rows_by_probing, spark, sf_dir))

    def counters(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return U.load_counters(
            self.merged(spark, sf_dir), self.stage(spark, sf_dir)
        )

    def rejects(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self._by(U.rejects_of_load, spark, sf_dir)


# --- opening balances ------------------------------------------------------

_CENTS = "CAST(c_acctbal AS DECIMAL(18,2))"


def balance_stage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = I.table(spark, sf_dir, "customer")

    def rows(df: DataFrame, plus: str) -> DataFrame:
        return df.selectExpr(
            "'31.12.1994' AS on_date",
            "CAST(c_custkey AS STRING) AS account_rk",
            """CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL
                 ELSE CAST(c_nationkey AS STRING) END AS currency_rk""",
            f"CAST({_CENTS} + {plus} AS STRING) AS balance_out",
        )

    changed = "CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END"
    return (
        rows(customer, changed)
        .unionByName(rows(customer.filter("c_nationkey = 4"), "5"))
        .unionByName(rows(customer.filter("c_nationkey = 6"), changed))
    )


def balance_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        I.table(spark, sf_dir, "customer")
        .filter("c_mktsegment <> 'BUILDING'")
        .selectExpr(
            "DATE '1994-12-31' AS on_date",
            "c_custkey AS account_rk",
            "CAST(c_nationkey AS BIGINT) AS currency_rk",
            f"CAST({_CENTS} AS DECIMAL(23,8)) AS balance_out",
        )
    )


BALANCES = Load(S.BALANCE, DOTTED_DATE, balance_stage_text, balance_target)

# --- currencies with unacceptable rows -------------------------------------


def currency_stage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS currency_rk",
        "'1995-01-01' AS data_actual_date",
        "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE '2050-12-31' END AS data_actual_end_date",
        """CASE c_nationkey WHEN 3 THEN '999' WHEN 4 THEN '0' WHEN 6 THEN NULL
             ELSE CAST(100 + c_nationkey AS STRING) END AS currency_code""",
        """CASE c_nationkey WHEN 7 THEN 'NON' WHEN 8 THEN 'usd' WHEN 9 THEN '~'
             WHEN 10 THEN NULL ELSE concat(chr(65 + c_nationkey), 'BC') END AS code_iso_char""",
    )


def currency_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        I.table(spark, sf_dir, "customer")
        .filter("c_mktsegment <> 'BUILDING'")
        .selectExpr(
            "c_custkey AS currency_rk",
            "DATE '1995-01-01' AS data_actual_date",
            "DATE '2050-12-31' AS data_actual_end_date",
            """CASE WHEN c_mktsegment = 'MACHINERY' THEN '555'
                 ELSE CAST(100 + c_nationkey AS STRING) END AS currency_code""",
            "concat(chr(65 + c_nationkey), 'BC') AS code_iso_char",
        )
    )


CURRENCIES = Load(
    S.CURRENCY,
    ISO_DATE,
    currency_stage_text,
    currency_target,
    valid=lambda: valid_currency(F.col("currency_code"), F.col("code_iso_char")),
)

# --- accounts --------------------------------------------------------------


def account_stage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "customer").selectExpr(
        "'1995-01-01' AS data_actual_date",
        "'1995-12-31' AS data_actual_end_date",
        "CAST(c_custkey AS STRING) AS account_rk",
        """concat(CAST(30100 + c_nationkey % 18 AS STRING),
             lpad(CAST(c_custkey AS STRING), 15, '0'), '-extra') AS account_number""",
        "CASE WHEN c_custkey % 2 = 0 THEN 'Актив' ELSE 'Пассив' END AS char_type",
        "CAST(c_nationkey AS STRING) AS currency_rk",
        "CAST(100 + c_nationkey AS STRING) AS currency_code",
    )


def account_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        I.table(spark, sf_dir, "customer")
        .filter("c_mktsegment <> 'BUILDING'")
        .selectExpr(
            "DATE '1995-01-01' AS data_actual_date",
            """CASE WHEN c_mktsegment = 'FURNITURE' THEN DATE '1995-06-30'
                 ELSE DATE '1995-12-31' END AS data_actual_end_date""",
            "c_custkey AS account_rk",
            """concat(CAST(30100 + c_nationkey % 18 AS STRING),
                 lpad(CAST(c_custkey AS STRING), 15, '0')) AS account_number""",
            """CASE WHEN c_mktsegment = 'MACHINERY' THEN 'X'
                 WHEN c_custkey % 2 = 0 THEN 'А' ELSE 'П' END AS char_type""",
            "CAST(c_nationkey AS BIGINT) AS currency_rk",
            "CAST(100 + c_nationkey AS STRING) AS currency_code",
        )
    )


ACCOUNTS = Load(S.ACCOUNT, ISO_DATE, account_stage_text, account_target)

# --- exchange rates: one per customer and order day, some days twice -------


def rate_stage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "orders").selectExpr(
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS data_actual_date",
        """CASE WHEN o_orderstatus = 'P' THEN NULL
             ELSE CAST(date_add(CAST(o_orderdate AS DATE), 6) AS STRING) END
             AS data_actual_end_date""",
        "CAST(o_custkey AS STRING) AS currency_rk",
        # From 1 to 2 in steps of 1e-8; orders 10^8 apart share a rate.
        """CAST(CAST(1 + CAST(o_orderkey % 100000000 AS DECIMAL(9,0)) / 100000000
             AS DECIMAL(12,8)) AS STRING) AS reduced_cource""",
        "substring(o_orderpriority, 1, 5) AS code_iso_num",
    )


def rate_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all customers' latest days were loaded before, at 1."""
    return (
        I.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("day"))
        .selectExpr(
            "CAST(day AS DATE) AS data_actual_date",
            "date_add(CAST(day AS DATE), 6) AS data_actual_end_date",
            "o_custkey AS currency_rk",
            "CAST(1 AS DECIMAL(12,8)) AS reduced_cource",
            "CAST('1-U' AS STRING) AS code_iso_num",
        )
    )


RATES = Load(S.EXCHANGE_RATE, ISO_DATE, rate_stage_text, rate_target)

# --- ledger accounts: long names are cut, sixteen columns stay empty -------


def ledger_stage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "part").selectExpr(
        "p_brand AS chapter",
        "p_name AS chapter_name",
        "CAST(p_size AS STRING) AS section_number",
        "concat(p_name, ' ', p_type) AS section_name",
        "concat(p_type, ' ', p_brand) AS subsection_name",
        "CAST(300 + p_size % 5 AS STRING) AS ledger1_account",
        "CASE WHEN p_type = 'PROMO' THEN NULL ELSE repeat(p_name, 6) END AS ledger1_account_name",
        "CAST(p_partkey AS STRING) AS ledger_account",
        "repeat(concat(p_name, ' '), 16) AS ledger_account_name",
        "CASE WHEN p_size > 25 THEN 'Актив' ELSE 'Пассив' END AS characteristic",
        "'2008-01-01' AS start_date",
        "'2050-12-31' AS end_date",
    )


def ledger_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the smaller sizes; the promoted ones as they are in the stage."""
    stage = typed(
        ledger_stage_text(spark, sf_dir), S.LEDGER_ACCOUNT, ISO_DATE, S.LEDGER_FILE_COLUMNS
    ).filter("section_number <= 25")
    older = stage.withColumns(
        {
            "section_name": F.when(
                F.col("ledger1_account_name").isNotNull(), F.lit("old")
            ).otherwise(F.col("section_name")),
            "is_correct": F.lit("1"),
        }
    )
    return empty_columns(older, S.LEDGER_ACCOUNT)


LEDGER = Load(
    S.LEDGER_ACCOUNT,
    ISO_DATE,
    ledger_stage_text,
    ledger_target,
    columns=S.LEDGER_FILE_COLUMNS,
)

# --- keyless tables --------------------------------------------------------


def posting_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as postings; partial ones lack an amount, final ones repeat."""

    def rows(df: DataFrame) -> DataFrame:
        return df.selectExpr(
            "CAST(CAST(o_orderdate AS DATE) AS STRING) AS oper_date",
            "CAST(o_custkey AS STRING) AS credit_account_rk",
            "CAST(o_orderkey div 10 AS STRING) AS debet_account_rk",
            """CASE WHEN o_orderstatus = 'P' THEN NULL
                 ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END
                 AS credit_amount""",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS debet_amount",
        )

    orders = I.table(spark, sf_dir, "orders")
    return rows(orders).unionByName(rows(orders.filter("o_orderstatus = 'F'")))


def posting_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(posting_text(spark, sf_dir), S.POSTING, ISO_DATE)


def load_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.replace_with_distinct(posting_stage(spark, sf_dir))


def posting_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a table loaded before the postings of final orders existed."""
    stored = I.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    held = typed(
        stored.selectExpr(
            "CAST(CAST(o_orderdate AS DATE) AS STRING) AS oper_date",
            "CAST(o_custkey AS STRING) AS credit_account_rk",
            "CAST(o_orderkey div 10 AS STRING) AS debet_account_rk",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS credit_amount",
            "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS debet_amount",
        ),
        S.POSTING,
        ISO_DATE,
    )
    return U.unmatched_rows(posting_stage(spark, sf_dir), held)


def replace_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = I.table(spark, sf_dir, "events")
    return U.replace_with_distinct(
        events.unionByName(events.filter("event_type = 'error'"))
    )


def append_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = I.deals(spark, sf_dir).filter("deal_type_cd <> 'O'")
    return U.append_distinct(stored, I.deals_in_file(spark, sf_dir))


# --- messages --------------------------------------------------------------


def reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mismatch_lines(BALANCES.rejects(spark, sf_dir), S.BALANCE.key)


def reject_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_summary(reject_lines(spark, sf_dir))


def reject_message_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows were rejected, and the first ten lines."""
    found = first_of_all(reject_lines(spark, sf_dir), "line", 10)
    return found.select(F.col("total").alias("rejected_rows"), F.array_join("shown", "; ").alias("message"))


def posting_reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = posting_stage(spark, sf_dir)
    return mismatch_lines(U.unmatched_after_replace(stage), S.POSTING.columns)


# --- jobs end to end -------------------------------------------------------


def _fresh_warehouse(spark: SparkSession, name: str) -> tuple[Warehouse, str]:
    root = shared_folder(spark, name)
    store = TableStore(spark, f"{root}/tables")
    return Warehouse(store, AuditLog(store)), root


def file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier table stored, file written, landed, loaded, and read again."""
    house, root = _fresh_warehouse(spark, "file_load")
    house.store.replace_dates(S.BALANCE, balance_target(spark, sf_dir), [I.SEED_DAY])
    write_delimited(balance_stage_text(spark, sf_dir), f"{root}/ft_balance_f.csv")
    house.load_file(IngestSpec(S.BALANCE, DOTTED_DATE), f"{root}/ft_balance_f.csv")
    return house.store.read(S.BALANCE)


def bucket_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts kept in buckets: stored, loaded with a stage, and read again."""
    root = shared_folder(spark, "bucket_load")
    store = TableStore(spark, f"{root}/tables", buckets={S.ACCOUNT.name: 16})
    store.rewrite(S.ACCOUNT, account_target(spark, sf_dir))
    Warehouse(store, AuditLog(store)).load_rows(IngestSpec(S.ACCOUNT, ISO_DATE), account_stage_text(spark, sf_dir))
    return store.read(S.ACCOUNT)


def file_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of that load as the audit log shows them."""
    house, root = _fresh_warehouse(spark, "file_load_audit")
    house.store.replace_dates(S.BALANCE, balance_target(spark, sf_dir), [I.SEED_DAY])
    write_delimited(balance_stage_text(spark, sf_dir), f"{root}/ft_balance_f.csv")
    house.load_file(IngestSpec(S.BALANCE, DOTTED_DATE), f"{root}/ft_balance_f.csv")
    return house.audit.latest().select(
        "process",
        "table_name",
        "status",
        F.col("input_rows").alias("input_count"),
        F.col("inserted_rows").alias("inserted_count"),
        F.col("updated_rows").alias("updated_count"),
        F.col("skipped_rows").alias("skipped_count"),
    )


def month_of_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same postings, each on that day of one month."""
    return posting_text(spark, sf_dir).withColumn(
        "oper_date", F.concat(F.lit("1995-01-"), F.right("oper_date", F.lit(2)))
    )


def _day_of_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """The six files of a day, as folders of parts."""
    texts = {
        S.BALANCE: balance_stage_text,
        S.POSTING: month_of_postings,
        S.ACCOUNT: account_stage_text,
        S.CURRENCY: currency_stage_text,
        S.EXCHANGE_RATE: rate_stage_text,
        S.LEDGER_ACCOUNT: ledger_stage_text,
    }
    at_once(
        spark,
        {
            spec.name: partial(write_delimited, text(spark, sf_dir), f"{root}/in/{spec.name}.csv")
            for spec, text in texts.items()
        },
    )
    return f"{root}/in"


_COUNTED = ("input", "inserted", "updated", "skipped")


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six files into empty detail tables; the audit log of the day."""
    house, root = _fresh_warehouse(spark, "daily_load")
    house.load_detail(_day_of_files(spark, sf_dir, root), ISO_DATE)
    return house.audit.latest().select(
        "table_name", "status", *[F.col(f"{c}_rows").alias(f"{c}_count") for c in _COUNTED]
    )


def import_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files for one import, one of them without a needed column."""
    house, root = _fresh_warehouse(spark, "import_audit")
    rates = RATES.stage(spark, sf_dir)
    write_delimited(rates, f"{root}/good.csv")
    write_delimited(rates.drop("currency_rk"), f"{root}/bad.csv")
    try:
        house.import_many({f"{root}/bad.csv": S.CURRENCY, f"{root}/good.csv": S.EXCHANGE_RATE})
    except ExceptionGroup as problems:
        if len(problems.exceptions) != 1:
            raise
    return house.audit.latest().select(
        "process", "table_name", "status", F.col("inserted_rows").alias("inserted_count")
    )


def dropped_files_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load as a stream over a folder of dropped files."""
    house, root = _fresh_warehouse(spark, "file_drop")
    house.store.replace_dates(S.BALANCE, balance_target(spark, sf_dir), [I.SEED_DAY])
    write_delimited(balance_stage_text(spark, sf_dir), f"{root}/drop", Delimited())
    load_dropped_files(
        house, IngestSpec(S.BALANCE, DOTTED_DATE), f"{root}/drop", f"{root}/progress"
    )
    return house.store.read(S.BALANCE)


QUERIES = {
    "upsert_snapshot": BALANCES.snapshot,
    "upsert_snapshot_probed": BALANCES.probed,
    "upsert_counters": BALANCES.counters,
    "upsert_rejects": BALANCES.rejects,
    "upsert_filtered": CURRENCIES.snapshot,
    "upsert_filtered_counters": CURRENCIES.counters,
    "upsert_filtered_rejects": CURRENCIES.rejects,
    "load_accounts": ACCOUNTS.snapshot,
    "load_accounts_counters": ACCOUNTS.counters,
    "load_rates": RATES.snapshot,
    "load_rates_counters": RATES.counters,
    "load_rates_rejects": RATES.rejects,
    "load_ledger_accounts": LEDGER.snapshot,
    "load_ledger_accounts_counters": LEDGER.counters,
    "load_postings": load_postings,
    "posting_unmatched": posting_unmatched,
    "posting_reject_lines": posting_reject_lines,
    "replace_distinct": replace_distinct,
    "append_distinct": append_distinct,
    "reject_lines": reject_lines,
    "reject_message": reject_message,
    "reject_message_first": reject_message_first,
    "file_load": file_load,
    "bucket_load": bucket_load,
    "file_load_audit": file_load_audit,
    "dropped_files_load": dropped_files_load,
    "daily_load": daily_load,
    "import_audit": import_audit,
}

# --- independent SQL -------------------------------------------------------


def _date(text: str) -> str:
    return f"CAST({text} AS DATE)"


_BALANCE_ROW = """SELECT DATE '1994-12-31' AS on_date, c_custkey AS account_rk,
      CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey END AS BIGINT)
        AS currency_rk,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) + {plus} AS DECIMAL(23,8)) AS balance_out
    FROM customer WHERE {where}"""
_PLUS_ONE = "CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END"

STAGE_SQL = {
    "balance": " UNION ALL ".join(
        [
            _BALANCE_ROW.format(plus=_PLUS_ONE, where="TRUE"),
            _BALANCE_ROW.format(plus="5", where="c_nationkey = 4"),
            _BALANCE_ROW.format(plus=_PLUS_ONE, where="c_nationkey = 6"),
        ]
    ),
    "currency": """SELECT c_custkey AS currency_rk, DATE '1995-01-01' AS data_actual_date,
      CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE DATE '2050-12-31' END
        AS data_actual_end_date,
      CASE c_nationkey WHEN 3 THEN '999' WHEN 4 THEN '0' WHEN 6 THEN NULL
        ELSE CAST(100 + c_nationkey AS VARCHAR) END AS currency_code,
      CASE c_nationkey WHEN 7 THEN 'NON' WHEN 8 THEN 'usd' WHEN 9 THEN '~'
        WHEN 10 THEN NULL ELSE chr(65 + c_nationkey) || 'BC' END AS code_iso_char
    FROM customer""",
    "account": """SELECT DATE '1995-01-01' AS data_actual_date,
      DATE '1995-12-31' AS data_actual_end_date, c_custkey AS account_rk,
      left(CAST(30100 + c_nationkey % 18 AS VARCHAR)
        || lpad(CAST(c_custkey AS VARCHAR), 15, '0') || '-extra', 20) AS account_number,
      left(CASE WHEN c_custkey % 2 = 0 THEN 'Актив' ELSE 'Пассив' END, 1) AS char_type,
      CAST(c_nationkey AS BIGINT) AS currency_rk,
      CAST(100 + c_nationkey AS VARCHAR) AS currency_code
    FROM customer""",
    "rate": """SELECT CAST(o_orderdate AS DATE) AS data_actual_date,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) + 6 END
        AS data_actual_end_date,
      o_custkey AS currency_rk,
      CAST((100000000 + o_orderkey % 100000000) * CAST(0.00000001 AS DECIMAL(9,8)) AS DECIMAL(12,8))
        AS reduced_cource,
      left(o_orderpriority, 3) AS code_iso_num
    FROM orders""",
    "ledger": """SELECT left(p_brand, 1) AS chapter, left(p_name, 16) AS chapter_name,
      p_size AS section_number, left(p_name || ' ' || p_type, 22) AS section_name,
      left(p_type || ' ' || p_brand, 21) AS subsection_name,
      300 + p_size % 5 AS ledger1_account,
      CASE WHEN p_type = 'PROMO' THEN NULL ELSE left(repeat(p_name, 6), 47) END
        AS ledger1_account_name,
      CAST(p_partkey AS INTEGER) AS ledger_account,
      left(repeat(p_name || ' ', 16), 153) AS ledger_account_name,
      CASE WHEN p_size > 25 THEN 'А' ELSE 'П' END AS characteristic,
      DATE '2008-01-01' AS start_date, DATE '2050-12-31' AS end_date
    FROM part""",
}
_TARGET = {
    "balance": """SELECT DATE '1994-12-31' AS on_date, c_custkey AS account_rk,
      CAST(c_nationkey AS BIGINT) AS currency_rk,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS balance_out
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "currency": """SELECT c_custkey AS currency_rk, DATE '1995-01-01' AS data_actual_date,
      DATE '2050-12-31' AS data_actual_end_date,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN '555'
        ELSE CAST(100 + c_nationkey AS VARCHAR) END AS currency_code,
      chr(65 + c_nationkey) || 'BC' AS code_iso_char
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "account": """SELECT DATE '1995-01-01' AS data_actual_date,
      CASE WHEN c_mktsegment = 'FURNITURE' THEN DATE '1995-06-30'
        ELSE DATE '1995-12-31' END AS data_actual_end_date,
      c_custkey AS account_rk,
      CAST(30100 + c_nationkey % 18 AS VARCHAR)
        || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS account_number,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'X'
        WHEN c_custkey % 2 = 0 THEN 'А' ELSE 'П' END AS char_type,
      CAST(c_nationkey AS BIGINT) AS currency_rk,
      CAST(100 + c_nationkey AS VARCHAR) AS currency_code
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "rate": """SELECT CAST(max(o_orderdate) AS DATE) AS data_actual_date,
      CAST(max(o_orderdate) AS DATE) + 6 AS data_actual_end_date,
      o_custkey AS currency_rk, CAST(1 AS DECIMAL(12,8)) AS reduced_cource,
      '1-U' AS code_iso_num
    FROM orders GROUP BY o_custkey""",
    "ledger": """SELECT * REPLACE (CASE WHEN ledger1_account_name IS NOT NULL
        THEN 'old' ELSE section_name END AS section_name)
    FROM stage WHERE section_number <= 25""",
}

_CURRENCY_OK = """currency_code IS NOT NULL AND code_iso_char IS NOT NULL
      AND CAST(currency_code AS INTEGER) BETWEEN 1 AND 998
      AND regexp_full_match(code_iso_char, '[A-Z]{3}') AND code_iso_char <> 'NON'"""


def _load_ctes(name: str, load: Load, ok: str = "TRUE") -> dict[str, str]:
    """The load rule step by step, with explicit joins and a window."""
    key, attributes = load.spec.key, load.attributes
    on_key = " AND ".join(f"t.{k} = s.{k}" for k in key)
    differ = " OR ".join(f"t.{a} IS DISTINCT FROM s.{a}" for a in attributes)
    order = ", ".join(f"{a} NULLS FIRST" for a in attributes)
    keys = ", ".join(key)
    return {
        "stage": STAGE_SQL[name],
        "target": _TARGET[name],
        "differing": f"""SELECT s.*, t.{key[0]} IS NULL AS is_new
          FROM (SELECT DISTINCT * FROM stage WHERE {ok}) s
          LEFT JOIN target t ON {on_key} WHERE t.{key[0]} IS NULL OR {differ}""",
        "winner": f"""SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY {keys} ORDER BY {order}) AS place FROM differing)
          WHERE place = 1""",
        "loaded": "SELECT "
        + ", ".join(f"t.{k}" for k in key)
        + ", "
        + ", ".join(
            f"CASE WHEN s.{key[0]} IS NULL THEN t.{a} ELSE s.{a} END AS {a}"
            for a in attributes
        )
        + f""" FROM target t LEFT JOIN winner s ON {on_key}
          UNION ALL SELECT {keys}, {', '.join(attributes)} FROM winner WHERE is_new""",
    }


def _snapshot_sql(name: str, load: Load, ok: str = "TRUE") -> str:
    return I.with_inputs(
        f"SELECT {', '.join(load.wanted)} FROM loaded", more=_load_ctes(name, load, ok)
    )


_COUNTERS = """(SELECT count(*) FROM stage) AS input_count,
      (SELECT count(*) FROM winner WHERE is_new) AS inserted_count,
      (SELECT count(*) FROM winner WHERE NOT is_new) AS updated_count,
      (SELECT count(*) FROM stage) - (SELECT count(*) FROM winner) AS skipped_count"""


def _counters_sql(name: str, load: Load, ok: str = "TRUE") -> str:
    return I.with_inputs(f"SELECT {_COUNTERS}", more=_load_ctes(name, load, ok))


def _reject_ctes(name: str, load: Load, ok: str = "TRUE") -> dict[str, str]:
    key = load.spec.key
    on_key = " AND ".join(f"t.{k} = s.{k}" for k in key)
    differ = " OR ".join(f"t.{a} IS DISTINCT FROM s.{a}" for a in load.attributes)
    return _load_ctes(name, load, ok) | {
        "rejected": f"""SELECT s.*, CASE WHEN NOT s.is_ok THEN 'invalid'
            WHEN t.{key[0]} IS NULL THEN 'missing' ELSE 'other_version' END AS reject_reason
          FROM (SELECT *, COALESCE({ok}, FALSE) AS is_ok FROM stage) s
          LEFT JOIN loaded t ON {on_key} WHERE t.{key[0]} IS NULL OR {differ}"""
    }


def _rejects_sql(name: str, load: Load, ok: str = "TRUE") -> str:
    return I.with_inputs(
        f"SELECT {', '.join(load.wanted)}, reject_reason FROM rejected",
        more=_reject_ctes(name, load, ok),
    )


_LINE = """'Несоответствие данных - on_date: ' || CAST(on_date AS VARCHAR)
      || ', account_rk: ' || CAST(account_rk AS VARCHAR)"""

_POSTING_ROW = """SELECT CAST(o_orderdate AS DATE) AS oper_date,
      o_custkey AS credit_account_rk, o_orderkey // 10 AS debet_account_rk,
      CASE WHEN o_orderstatus = 'P' THEN NULL
        ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(23,8)) END AS credit_amount,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(23,8)) AS debet_amount
    FROM orders"""
_POSTINGS = {
    "stage": f"{_POSTING_ROW} UNION ALL {_POSTING_ROW} WHERE o_orderstatus = 'F'",
    "stored": "SELECT DISTINCT * FROM stage",
    "unmatched": """SELECT s.* FROM stage s LEFT JOIN stored d
      ON d.oper_date = s.oper_date AND d.credit_account_rk = s.credit_account_rk
      AND d.debet_account_rk = s.debet_account_rk AND d.credit_amount = s.credit_amount
      AND d.debet_amount = s.debet_amount WHERE d.oper_date IS NULL""",
}


def _ledger_sql() -> str:
    """All 28 columns: rows stored before keep their mark, the rest is NULL."""
    filled = {"is_correct": "CASE WHEN section_number <= 25 THEN '1' END"}
    kinds = {"integer": "INTEGER", "string": "VARCHAR"}
    out = [
        f.name
        if f.name in LEDGER.wanted
        else f"{filled.get(f.name, 'CAST(NULL AS ' + kinds[f.dataType.typeName()] + ')')} AS {f.name}"
        for f in S.LEDGER_ACCOUNT.schema
    ]
    return I.with_inputs(
        f"SELECT {', '.join(out)} FROM loaded", more=_load_ctes("ledger", LEDGER)
    )


_DEAL_COLUMNS = ", ".join(S.DEAL.columns)


def _day_sql() -> str:
    """Into an empty table goes one row per key that some acceptable row has."""
    keyed = {
        "ft_balance_f": ("balance", BALANCES, "TRUE"),
        "md_account_d": ("account", ACCOUNTS, "TRUE"),
        "md_currency_d": ("currency", CURRENCIES, _CURRENCY_OK),
        "md_exchange_rate_d": ("rate", RATES, "TRUE"),
        "md_ledger_account_s": ("ledger", LEDGER, "TRUE"),
    }
    parts = [
        f"""SELECT '{table}' AS table_name, count(*) AS input_count,
      count(DISTINCT ({', '.join(load.spec.key)})) FILTER ({ok}) AS inserted_count
    FROM ({STAGE_SQL[name]})"""
        for table, (name, load, ok) in keyed.items()
    ]
    parts.append(
        f"""SELECT 'ft_posting_f', count(*), count(DISTINCT s) FROM (SELECT * REPLACE (
        make_date(1995, 1, day(oper_date)) AS oper_date) FROM ({_POSTINGS['stage']})) s"""
    )
    return f"""SELECT table_name, 'SUCCESS' AS status, input_count, inserted_count,
      CAST(0 AS BIGINT) AS updated_count, input_count - inserted_count AS skipped_count
    FROM ({' UNION ALL '.join(parts)})"""

ORACLE = {
    "upsert_snapshot": _snapshot_sql("balance", BALANCES),
    "upsert_snapshot_probed": _snapshot_sql("balance", BALANCES),
    "upsert_counters": _counters_sql("balance", BALANCES),
    "upsert_rejects": _rejects_sql("balance", BALANCES),
    "upsert_filtered": _snapshot_sql("currency", CURRENCIES, _CURRENCY_OK),
    "upsert_filtered_counters": _counters_sql("currency", CURRENCIES, _CURRENCY_OK),
    "upsert_filtered_rejects": _rejects_sql("currency", CURRENCIES, _CURRENCY_OK),
    "load_accounts": _snapshot_sql("account", ACCOUNTS),
    "load_accounts_counters": _counters_sql("account", ACCOUNTS),
    "load_rates": _snapshot_sql("rate", RATES),
    "load_rates_counters": _counters_sql("rate", RATES),
    "load_rates_rejects": _rejects_sql("rate", RATES),
    "load_ledger_accounts": _ledger_sql(),
    "load_ledger_accounts_counters": _counters_sql("ledger", LEDGER),
    "load_postings": I.with_inputs("SELECT * FROM stored", more=_POSTINGS),
    "posting_unmatched": f"""WITH stage AS ({_POSTINGS['stage']})
    SELECT * FROM stage s WHERE credit_amount IS NULL OR NOT EXISTS (
      SELECT 1 FROM ({_POSTING_ROW} WHERE o_orderstatus = 'O') d
      WHERE d = s)""",
    "posting_reject_lines": I.with_inputs(
        """SELECT 'Несоответствие данных - oper_date: ' || CAST(oper_date AS VARCHAR)
      || ', credit_account_rk: ' || CAST(credit_account_rk AS VARCHAR)
      || ', debet_account_rk: ' || CAST(debet_account_rk AS VARCHAR)
      || ', credit_amount: ' || COALESCE(CAST(credit_amount AS VARCHAR), '')
      || ', debet_amount: ' || COALESCE(CAST(debet_amount AS VARCHAR), '') AS line
    FROM unmatched""",
        more=_POSTINGS,
    ),
    "replace_distinct": """SELECT DISTINCT * FROM (SELECT * FROM events
      UNION ALL SELECT * FROM events WHERE event_type = 'error')""",
    "append_distinct": I.with_inputs(
        f"""SELECT {_DEAL_COLUMNS} FROM deal WHERE deal_type_cd <> 'O'
      UNION ALL SELECT DISTINCT {_DEAL_COLUMNS} FROM deal_file""",
        "deal",
        "deal_file",
    ),
    "reject_lines": I.with_inputs(
        f"SELECT {_LINE} AS line FROM rejected", more=_reject_ctes("balance", BALANCES)
    ),
    "reject_message": I.with_inputs(
        """SELECT count(*) AS rejected_rows,
      CASE WHEN count(DISTINCT line) > 1 THEN count(*) || ': ' || min(line) || ' .. ' || max(line)
        ELSE count(*) || ': ' || min(line) END AS message FROM lines""",
        more=_reject_ctes("balance", BALANCES)
        | {"lines": f"SELECT {_LINE} AS line FROM rejected"},
    ),
    "reject_message_first": I.with_inputs(
        """SELECT (SELECT count(*) FROM lines) AS rejected_rows,
      COALESCE(string_agg(line, '; ' ORDER BY line), '') AS message
    FROM (SELECT DISTINCT line FROM lines ORDER BY line LIMIT 10)""",
        more=_reject_ctes("balance", BALANCES)
        | {"lines": f"SELECT {_LINE} AS line FROM rejected"},
    ),
    "file_load": _snapshot_sql("balance", BALANCES),
    "bucket_load": _snapshot_sql("account", ACCOUNTS),
    "file_load_audit": I.with_inputs(
        f"""SELECT 'ETL_DS_Load' AS process, 'ft_balance_f' AS table_name,
      'SUCCESS' AS status, {_COUNTERS}""",
        more=_load_ctes("balance", BALANCES),
    ),
    "dropped_files_load": _snapshot_sql("balance", BALANCES),
    "daily_load": _day_sql(),
    "import_audit": """SELECT 'Import_from_CSV' AS process, 'md_currency_d' AS table_name,
      'FAILED' AS status, CAST(0 AS BIGINT) AS inserted_count
    UNION ALL SELECT 'Import_from_CSV', 'md_exchange_rate_d', 'SUCCESS', count(*) FROM orders""",
}
