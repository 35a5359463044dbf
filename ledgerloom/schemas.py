"""Table definitions: columns, business key, partition column, layer.

Spark does not enforce keys or NOT NULL on files, so ``key`` and ``required``
are what the checks in ``operators.checks`` work from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# The declared numeric type of the marts, and a rate type whose
# product with it (36 digits, 16 of them decimals) still fits without rounding.
AMOUNT = T.DecimalType(23, 8)
RATE = T.DecimalType(12, 8)

# Account kinds, Cyrillic capitals A (U+0410) and PE (U+041F).
ACTIVE = "А"
PASSIVE = "П"

# Numeric codes of the home currency.
HOME_CURRENCY_CODES = ("810", "643")

_LONG, _INT, _DATE, _TEXT, _TIME = (
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.StringType(),
    T.TimestampType(),
)


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``partition_by`` names its date column, if it is stored by date; then single
    dates are replaced, unless the table is always rewritten as a ``whole``.
    ``widths`` holds the length limits of text columns.
    """

    layer: str
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    partition_by: str | None = None
    widths: tuple[tuple[str, int], ...] = ()
    whole: bool = False

    @property
    def by_date(self) -> bool:
        return self.partition_by is not None and not self.whole

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    def twin(self, name: str, layer: str | None = None) -> TableSpec:
        """An unpartitioned table of the same form under another name."""
        return TableSpec(
            layer or self.layer, name, self.schema, self.key, None, self.widths
        )


def _table(
    layer: str,
    name: str,
    columns: Sequence[tuple],
    key: Sequence[str] = (),
    partition_by: str | None = None,
    whole: bool = False,
) -> TableSpec:
    """``columns`` are (name, type[, "required"]); an int type means text(n)."""
    fields, widths = [], []
    for column, kind, *flags in columns:
        if isinstance(kind, int):
            widths.append((column, kind))
            kind = _TEXT
        fields.append(T.StructField(column, kind, "required" not in flags))
    return TableSpec(
        layer,
        name,
        T.StructType(fields),
        tuple(key),
        partition_by,
        tuple(widths),
        whole,
    )


# --- detail layer ----------------------------------------------------------

BALANCE = _table(
    "ds",
    "ft_balance_f",
    [
        ("on_date", _DATE, "required"),
        ("account_rk", _LONG, "required"),
        ("currency_rk", _LONG),
        ("balance_out", AMOUNT),
    ],
    key=["on_date", "account_rk"],
    partition_by="on_date",
)

POSTING = _table(
    "ds",
    "ft_posting_f",
    [
        ("oper_date", _DATE, "required"),
        ("credit_account_rk", _LONG, "required"),
        ("debet_account_rk", _LONG, "required"),
        ("credit_amount", AMOUNT),
        ("debet_amount", AMOUNT),
    ],
    partition_by="oper_date",
    whole=True,
)

ACCOUNT = _table(
    "ds",
    "md_account_d",
    [
        ("data_actual_date", _DATE, "required"),
        ("data_actual_end_date", _DATE, "required"),
        ("account_rk", _LONG, "required"),
        ("account_number", 20, "required"),
        ("char_type", 1, "required"),
        ("currency_rk", _LONG, "required"),
        ("currency_code", 3, "required"),
    ],
    key=["data_actual_date", "account_rk"],
)

CURRENCY = _table(
    "ds",
    "md_currency_d",
    [
        ("currency_rk", _LONG, "required"),
        ("data_actual_date", _DATE, "required"),
        ("data_actual_end_date", _DATE),
        ("currency_code", 3),
        ("code_iso_char", 3),
    ],
    key=["currency_rk", "data_actual_date"],
)

EXCHANGE_RATE = _table(
    "ds",
    "md_exchange_rate_d",
    [
        ("data_actual_date", _DATE, "required"),
        ("data_actual_end_date", _DATE),
        ("currency_rk", _LONG, "required"),
        ("reduced_cource", RATE),
        ("code_iso_num", 3),
    ],
    key=["data_actual_date", "currency_rk"],
)

# The file fills twelve of these columns; the others stay NULL.
LEDGER_ACCOUNT = _table(
    "ds",
    "md_ledger_account_s",
    [
        ("chapter", 1),
        ("chapter_name", 16),
        ("section_number", _INT),
        ("section_name", 22),
        ("subsection_name", 21),
        ("ledger1_account", _INT),
        ("ledger1_account_name", 47),
        ("ledger_account", _INT, "required"),
        ("ledger_account_name", 153),
        ("characteristic", 1),
        ("is_resident", _INT),
        ("is_reserve", _INT),
        ("is_reserved", _INT),
        ("is_loan", _INT),
        ("is_reserved_assets", _INT),
        ("is_overdue", _INT),
        ("is_interest", _INT),
        ("pair_account", 5),
        ("start_date", _DATE, "required"),
        ("end_date", _DATE),
        ("is_rub_only", _INT),
        ("min_term", 1),
        ("min_term_measure", 1),
        ("max_term", 1),
        ("max_term_measure", 1),
        ("ledger_acc_full_name_translit", 1),
        ("is_revaluation", 1),
        ("is_correct", 1),
    ],
    key=["ledger_account", "start_date"],
)

LEDGER_FILE_COLUMNS = [
    "chapter",
    "chapter_name",
    "section_number",
    "section_name",
    "subsection_name",
    "ledger1_account",
    "ledger1_account_name",
    "ledger_account",
    "ledger_account_name",
    "characteristic",
    "start_date",
    "end_date",
]

# --- marts -----------------------------------------------------------------

TURNOVER = _table(
    "dm",
    "dm_account_turnover_f",
    [
        ("on_date", _DATE),
        ("account_rk", _LONG),
        ("credit_amount", AMOUNT),
        ("credit_amount_rub", AMOUNT),
        ("debet_amount", AMOUNT),
        ("debet_amount_rub", AMOUNT),
    ],
    key=["on_date", "account_rk"],
    partition_by="on_date",
)

DAILY_BALANCE = _table(
    "dm",
    "dm_account_balance_f",
    [
        ("on_date", _DATE),
        ("account_rk", _LONG),
        ("balance_out", AMOUNT),
        ("balance_out_rub", AMOUNT),
    ],
    key=["on_date", "account_rk"],
    partition_by="on_date",
)

REPORT_MEASURES = [
    f"{measure}_{scope}"
    for measure in ("balance_in", "turn_deb", "turn_cre", "balance_out")
    for scope in ("rub", "val", "total")
]

LEDGER_REPORT = _table(
    "dm",
    "dm_f101_round_f",
    [
        ("from_date", _DATE),
        ("to_date", _DATE),
        ("chapter", 1),
        ("ledger_account", 5),
        ("characteristic", 1),
        *[(c, AMOUNT) for m in REPORT_MEASURES for c in (m, f"r_{m}")],
    ],
    key=["from_date", "to_date", "chapter", "ledger_account", "characteristic"],
    partition_by="to_date",
)

# --- source copies and reload marts ----------------------------------------

CLIENT = _table(
    "dm",
    "client",
    [
        ("client_rk", _LONG),
        ("effective_from_date", _DATE),
        ("effective_to_date", _DATE),
        ("client_open_dttm", _TIME),
    ],
    key=["client_rk", "effective_from_date"],
)

DEAL = _table(
    "rd",
    "deal_info",
    [
        ("deal_rk", _LONG),
        ("deal_num", _TEXT),
        ("deal_name", _TEXT),
        ("deal_sum", AMOUNT),
        ("client_rk", _LONG),
        ("account_rk", _LONG),
        ("agreement_rk", _LONG),
        ("deal_start_date", _DATE),
        ("department_rk", _LONG),
        ("product_rk", _LONG),
        ("deal_type_cd", _TEXT),
        ("effective_from_date", _DATE),
        ("effective_to_date", _DATE),
    ],
    key=["deal_rk", "effective_from_date"],
)

PRODUCT = _table(
    "rd",
    "product",
    [
        ("product_rk", _LONG),
        ("product_name", _TEXT),
        ("effective_from_date", _DATE),
        ("effective_to_date", _DATE),
    ],
    key=["product_rk", "effective_from_date"],
)

LOAN_HOLIDAY = _table(
    "rd",
    "loan_holiday",
    [
        ("deal_rk", _LONG),
        ("loan_holiday_type_cd", _TEXT),
        ("loan_holiday_start_date", _DATE),
        ("loan_holiday_finish_date", _DATE),
        ("loan_holiday_fact_finish_date", _DATE),
        ("loan_holiday_finish_flg", _TEXT),
        ("loan_holiday_last_possible_date", _DATE),
        ("effective_from_date", _DATE),
        ("effective_to_date", _DATE),
    ],
    key=["deal_rk", "effective_from_date"],
)

LOAN_HOLIDAY_INFO = _table(
    "dm",
    "loan_holiday_info",
    [
        ("deal_rk", _LONG),
        ("effective_from_date", _DATE),
        ("effective_to_date", _DATE),
        ("agreement_rk", _LONG),
        ("client_rk", _LONG),
        ("department_rk", _LONG),
        ("product_rk", _LONG),
        ("product_name", _TEXT),
        ("deal_type_cd", _TEXT),
        ("deal_start_date", _DATE),
        ("deal_name", _TEXT),
        ("deal_number", _TEXT),
        ("deal_sum", AMOUNT),
        ("loan_holiday_type_cd", _TEXT),
        ("loan_holiday_start_date", _DATE),
        ("loan_holiday_finish_date", _DATE),
        ("loan_holiday_fact_finish_date", _DATE),
        ("loan_holiday_finish_flg", _TEXT),
        ("loan_holiday_last_possible_date", _DATE),
    ],
)

SOURCE_ACCOUNT = _table(
    "rd",
    "account",
    [("account_rk", _LONG), ("department_rk", _LONG), ("currency_cd", _TEXT)],
    key=["account_rk"],
)

SOURCE_BALANCE = _table(
    "rd",
    "account_balance",
    [
        ("account_rk", _LONG),
        ("effective_date", _DATE),
        ("account_in_sum", AMOUNT),
        ("account_out_sum", AMOUNT),
    ],
    key=["account_rk", "effective_date"],
    partition_by="effective_date",
)

CURRENCY_NAME = _table(
    "dm",
    "dict_currency",
    [("currency_cd", _TEXT), ("currency_name", _TEXT)],
    key=["currency_cd"],
)

BALANCE_TURNOVER = _table(
    "dm",
    "account_balance_turnover",
    [
        ("account_rk", _LONG),
        ("currency_name", _TEXT),
        ("department_rk", _LONG),
        ("effective_date", _DATE),
        ("account_in_sum", AMOUNT),
        ("account_out_sum", AMOUNT),
    ],
)

# --- audit -----------------------------------------------------------------

AUDIT_EVENT = _table(
    "logs",
    "etl_log_events",
    [
        ("run_id", _TEXT, "required"),
        ("process", 50, "required"),
        ("table_name", 100, "required"),
        ("event_time", _TIME, "required"),
        ("status", 50, "required"),
        ("message", _TEXT),
        ("input_rows", _LONG),
        ("inserted_rows", _LONG),
        ("updated_rows", _LONG),
        ("skipped_rows", _LONG),
    ],
)
