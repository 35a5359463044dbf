"""Batch jobs: file loads, mart fills, CSV exchange, repair of source copies.

These functions are the only places that trigger actions: each reads tables of
a ``TableStore``, writes its result, and leaves a record in the audit log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions.casts import DOTTED_DATE, ISO_DATE, typed
from ledgerloom.functions.messages import (
    FILLED_FOR,
    mismatch_lines,
    summary_measures,
    summary_text,
)
from ledgerloom.functions.predicates import any_of, valid_currency
from ledgerloom.operators import upsert as U
from ledgerloom.operators.first_values import first_of_all
from ledgerloom.operators.checks import DataCheckError, enforce_key
from ledgerloom.operators.versions import keep_freshest
from ledgerloom.plans.audit import AuditLog
from ledgerloom.plans.balance import balance_for_day, balance_for_period, seed_balance
from ledgerloom.plans.balance_repair import balance_turnover, opening_fixes, with_fixes
from ledgerloom.plans.ledger_report import ledger_report
from ledgerloom.plans.loan_holiday import loan_holiday_info
from ledgerloom.plans.turnover import account_turnover
from ledgerloom.schemas import TableSpec
from ledgerloom.session import at_once
from ledgerloom.sources.csv_files import (
    Delimited,
    EncodingError,
    read_delimited,
    undecodable,
    write_delimited,
)
from ledgerloom.sources.tables import TableStore

# Process names in the audit log.
LOAD, MART, EXPORT, IMPORT = "ETL_DS_Load", "data_mart_load", "Export_to_CSV", "Import_from_CSV"

_BROKEN, _DATES = "_undecodable", "dates"

# So many keys take some 50 MB where they are held whole, on the driver and in each executor.
FEW_KEYS = 500_000


@dataclass(frozen=True)
class IngestSpec:
    """One source file and the table it feeds.

    ``date_pattern`` is required: guessing the order of day and month is how
    dates get silently swapped. A table without a key is replaced as a whole.
    """

    table: TableSpec
    date_pattern: str | Mapping[str, str]
    columns: Sequence[str] | None = None
    valid: Callable[[], Column] | None = None
    style: Delimited = field(default_factory=Delimited)

    @property
    def wanted(self) -> list[str]:
        return list(self.columns or self.table.columns)

    @property
    def must(self) -> list[str]:
        """Columns whose NULL stops a load; a NULL in a key only rejects the row."""
        return [c for c in self.table.required if c not in self.table.key]

    @property
    def file_name(self) -> str:
        return f"{self.table.name}.csv"


def detail_specs(posting_date_pattern: str) -> list[IngestSpec]:
    """The six tables of the detail layer."""
    return [
        IngestSpec(S.BALANCE, DOTTED_DATE),
        IngestSpec(S.POSTING, posting_date_pattern),
        IngestSpec(S.ACCOUNT, ISO_DATE),
        IngestSpec(
            S.CURRENCY,
            ISO_DATE,
            valid=lambda: valid_currency(F.col("currency_code"), F.col("code_iso_char")),
        ),
        IngestSpec(S.EXCHANGE_RATE, ISO_DATE),
        IngestSpec(S.LEDGER_ACCOUNT, ISO_DATE, columns=S.LEDGER_FILE_COLUMNS),
    ]


def stage_table(spec: IngestSpec) -> TableSpec:
    """Typed landing table of a file: no key, nothing required."""
    fields = [S.T.StructField(c, spec.table.schema[c].dataType) for c in spec.wanted]
    return TableSpec("stage", spec.table.name, S.T.StructType(fields))


def reject_table(spec: IngestSpec) -> TableSpec:
    """All rejected rows of all runs, as the log names them."""
    fields = [S.T.StructField(c, S.T.StringType()) for c in ("run_id", "line")]
    return TableSpec("logs", f"rejects_{spec.table.name}", S.T.StructType(fields))


class Warehouse:
    """The jobs over one table store."""

    def __init__(self, store: TableStore, audit: AuditLog | None = None, listed_rejects: int = 0):
        """With ``listed_rejects`` the log names the first so many rejected rows of a
        load, else the first and the last; all of them are in the reject table."""
        self.store = store
        self.listed_rejects = listed_rejects
        self.spark = store.spark
        self.audit = audit or AuditLog(store)

    # --- detail layer ------------------------------------------------------

    def load_file(self, spec: IngestSpec, path: str) -> U.LoadStats:
        """Land a file, load it into its table, keep the rejected rows."""
        with self.audit.run(LOAD, spec.table.name) as run:
            run.stats = self._load_landed(spec, self._land_file(spec, path), run.run_id)
            run.preview = self.store.preview(spec.table)
            return run.stats

    def load_rows(
        self, spec: IngestSpec, text: DataFrame, process: str = LOAD
    ) -> U.LoadStats:
        """The same for all-text rows from elsewhere."""
        with self.audit.run(process, spec.table.name) as run:
            landed = self._land(spec, text)
            if landed["undecodable"]:
                raise EncodingError(f"{spec.table.name}: {landed['undecodable']} undecodable rows")
            run.stats = self._load_landed(spec, landed, run.run_id)
            return run.stats

    def _land_file(self, spec: IngestSpec, path: str) -> dict[str, Any]:
        """Land a file in the first encoding that decodes all of it.

        Undecodable texts are counted while landing, so a file in the expected
        encoding is read once. A file that no candidate decodes is not loaded.
        """
        lacking = None
        for encoding in spec.style.encodings:
            try:
                text = read_delimited(self.spark, path, spec.wanted, spec.style, encoding)
            except LookupError as problem:
                # Header names may be what the encoding does not fit.
                lacking = problem
                continue
            seen = self._land(spec, text)
            if not seen["undecodable"]:
                return seen
            lacking = None
        if lacking is not None:
            raise lacking
        raise EncodingError(f"{path} is in none of {', '.join(spec.style.encodings)}")

    def _land(self, spec: IngestSpec, text: DataFrame) -> dict[str, Any]:
        """Write the typed rows; all that a load asks of them is counted with it."""
        marked = text.withColumn(_BROKEN, undecodable(spec.wanted))
        rows = typed(marked, spec.table, spec.date_pattern, spec.wanted, keep=[_BROKEN])
        holes = [F.col(c).isNull() for c in spec.wanted]
        valid = spec.valid() if spec.valid else F.lit(True)
        measures = [
            F.count_if(_BROKEN).alias("undecodable"),
            F.count_if(any_of(holes)).alias("incomplete"),
            *[
                F.count_if(valid & F.col(c).isNull()).alias(f"null {c}")
                for c in spec.must
            ],
        ]
        if spec.table.by_date:
            # At most one per calendar day.
            measures.append(F.collect_set(spec.table.partition_by).alias(_DATES))
        return self.store.rewrite(stage_table(spec), rows, measures, drop=[_BROKEN])

    def _load_landed(
        self, spec: IngestSpec, landed: dict[str, Any], run_id: str
    ) -> U.LoadStats:
        """Load the landing table; counters are taken while writing.

        A NULL in a required column stops the load, except in the key of a keyed
        table: such a row is rejected instead. Rows that may be rejected are
        looked for only if the counters leave room for any.
        """
        table, received = spec.table, landed["rows"]
        missing = [c for c in spec.must if landed[f"null {c}"]]
        if missing:
            raise DataCheckError(
                f"{table.name}: NULL in required columns: {', '.join(missing)}"
            )
        landing = stage_table(spec)
        stage = self.store.read(landing)
        if table.key:
            named = list(table.key)
            seen, rejects = self._merge(spec, stage, sorted(landed.get(_DATES, ())))
            inserted, updated = seen["inserted"], seen["updated"]
            doubtful = received - inserted - updated - seen["same"]
        else:
            named = table.columns
            inserted = self.store.rewrite(table, U.replace_with_distinct(stage))["rows"]
            updated, doubtful = 0, landed["incomplete"]
            rejects = partial(U.unmatched_after_replace, stage)
        message = self._keep_rejects(spec, rejects(), named, run_id) if doubtful else None
        self.store.truncate(landing)
        return U.LoadStats(received, inserted, updated, message)

    def _keep_rejects(
        self, spec: IngestSpec, rejects: DataFrame, named: Sequence[str], run_id: str
    ) -> str | None:
        """Store a line per rejected row; returns the text for the audit log."""
        held, run = reject_table(spec), F.lit(run_id).alias("run_id")
        lines = mismatch_lines(rejects, named).select(run, "line")
        seen = self.store.append_measured(held, lines, summary_measures())
        if not seen["rows"]:
            return None
        if self.listed_rejects:
            own = self.store.read(held).filter(F.col("run_id") == run_id)
            first = first_of_all(own, "line", self.listed_rejects).first()
            return f"{first['total']}: {'; '.join(first['shown'])}"
        found = summary_text(*[F.lit(seen[c]) for c in ("rejected_rows", "least", "greatest")])
        return self.spark.range(1).select(found.alias("text")).first()["text"]

    def _merge(
        self, spec: IngestSpec, stage: DataFrame, dates: Sequence[dt.date]
    ) -> tuple[dict[str, int], Callable[[], DataFrame]]:
        """Keyed load. A table kept by date is touched on the staged dates only, one
        kept in buckets in those of the staged keys. Returns the counters, and how
        to find the rejected rows."""
        table, store = spec.table, self.store
        attributes = [c for c in spec.wanted if c not in table.key]
        valid = spec.valid() if spec.valid else None
        counts, marks = U.action_counts(), [U.ACTION]

        def merged(stored: DataFrame) -> DataFrame:
            return U.merge_rows(stored, stage, table.key, attributes, valid)

        if buckets := store.bucketed(table):
            load = buckets.merge(stage, attributes, valid)
            seen, loaded = load.counts, buckets.read(load.touched)
        elif table.by_date:
            self._finish_pending(table)
            new = merged(store.read_dates(table, dates))
            seen = store.rewrite(_pending(table), new, counts, marks)
            self._finish_pending(table, dates)
            loaded = store.read_dates(table, dates)
        else:
            seen = store.rewrite(table, merged(store.read(table)), counts, marks)
            loaded = store.read(table)
        return seen, lambda: self._rejects(table, stage, loaded, attributes, valid)

    def _rejects(
        self,
        table: TableSpec,
        stage: DataFrame,
        loaded: DataFrame,
        attributes: Sequence[str],
        valid: Column | None,
    ) -> DataFrame:
        """The staged rows that the loaded table lacks or holds otherwise.

        The keys that can have such rows are stored first. If they are known to be
        few, the stage and the loaded table are only filtered by them where they
        lie; else Spark shuffles both whole before it can tell.
        """
        found = U.repeated_or_invalid(stage, table.key, valid)
        held = TableSpec("work", f"{table.name}_keys", found.schema)
        keys = None
        if self.store.rewrite(held, found)["rows"] <= FEW_KEYS:
            keys = F.broadcast(self.store.read(held))
            loaded = loaded.join(keys, list(table.key), "left_semi")
        doubtful = U.contested_rows(stage, table.key, attributes, valid, keys)
        return U.rejected_rows(loaded, doubtful, table.key, attributes, valid)

    def _finish_pending(self, table: TableSpec, dates: Sequence[dt.date] | None = None) -> None:
        """Move rewritten dates from their pending table into place.

        The pending table is complete before the first date is replaced, so if
        a job dies in between, the next one starts by finishing the move.
        """
        pending = _pending(table)
        rows = self.store.read(pending)
        if dates is None:
            dates = _dates_of(rows, table.partition_by)
        if dates:
            self.store.replace_dates(table, rows, dates)
            self.store.truncate(pending)

    def load_detail(
        self, folder: str, posting_date_pattern: str
    ) -> dict[str, U.LoadStats]:
        """All six files of a folder, at the same time: no table needs another one.

        What one load leaves idle (few files, a last task, a commit) the others
        use. A failure does not stop the others; the first one in table order is
        raised when all have ended.
        """
        specs = detail_specs(posting_date_pattern)
        return at_once(
            self.spark,
            {
                spec.table.name: partial(self.load_file, spec, f"{folder}/{spec.file_name}")
                for spec in specs
            },
        )

    # --- marts -------------------------------------------------------------

    def _fill(
        self,
        table: TableSpec,
        days: Sequence[dt.date],
        plan: Callable[[], DataFrame],
        label: str,
        compact: bool = False,
    ) -> U.LoadStats:
        with self.audit.run(MART, table.name) as run:
            rows = self.store.replace_dates(table, plan(), days, compact)
            run.stats = U.LoadStats(rows, rows, 0, FILLED_FOR + label)
            return run.stats

    def fill_turnover(self, first: dt.date, last: dt.date | None = None) -> U.LoadStats:
        """Turnover of a day or of a period, in one job; safe to repeat."""
        last = last or first
        read = self.store.read
        rates = read(S.EXCHANGE_RATE)
        endless = rates.filter(F.col("data_actual_end_date").isNull()).count()
        note = f"; {endless} rate rows without an end date were not used" if endless else ""
        return self._fill(
            S.TURNOVER,
            _days(first, last),
            lambda: account_turnover(read(S.POSTING), read(S.ACCOUNT), rates, first, last),
            _label(first, last) + note,
            compact=True,
        )

    def seed_balances(self, as_of: dt.date) -> U.LoadStats:
        """Opening balances of ``as_of`` into the balance mart."""
        read = self.store.read

        def plan() -> DataFrame:
            seed = seed_balance(read(S.BALANCE), read(S.EXCHANGE_RATE), as_of)
            return enforce_key(seed, S.DAILY_BALANCE.key, S.DAILY_BALANCE.name)

        return self._fill(S.DAILY_BALANCE, [as_of], plan, _label(as_of, as_of))

    def fill_balances(self, first: dt.date, last: dt.date | None = None) -> U.LoadStats:
        """Balances of a day or of a period, from the day before ``first`` on."""
        read = self.store.read

        def plan() -> DataFrame:
            inputs = read(S.ACCOUNT), read(S.TURNOVER), read(S.DAILY_BALANCE)
            if last is None or last == first:
                day = balance_for_day(*inputs, first)
                return enforce_key(day, S.DAILY_BALANCE.key, S.DAILY_BALANCE.name)
            return balance_for_period(*inputs, first, last)

        return self._fill(
            S.DAILY_BALANCE,
            _days(first, last or first),
            plan,
            _label(first, last or first),
            compact=True,
        )

    def fill_ledger_report(
        self, report_date: dt.date, allow_unmapped: bool = False
    ) -> U.LoadStats:
        """The report of the month before ``report_date``."""
        read = self.store.read
        return self._fill(
            S.LEDGER_REPORT,
            [report_date - dt.timedelta(days=1)],
            lambda: ledger_report(
                read(S.ACCOUNT),
                read(S.LEDGER_ACCOUNT),
                read(S.DAILY_BALANCE),
                read(S.TURNOVER),
                report_date,
                allow_unmapped,
            ),
            report_date.isoformat(),
            compact=True,
        )

    # --- CSV exchange ------------------------------------------------------

    def export_csv(
        self, table: TableSpec, path: str, style: Delimited | None = None
    ) -> U.LoadStats:
        """A folder of part files, which ``import_csv`` reads."""
        with self.audit.run(EXPORT, table.name) as run:
            rows = write_delimited(self.store.read(table), path, style)
            run.stats = U.LoadStats(rows, message=f"{table.name} -> {path}")
            return run.stats

    def import_csv(
        self,
        table: TableSpec,
        path: str,
        style: Delimited | None = None,
        truncate_first: bool = False,
        date_pattern: str = ISO_DATE,
    ) -> U.LoadStats:
        """Append a file to a table, or make it the only content; keys unchecked.

        A file that cannot be read changes nothing. Appending is the one load
        that must not be repeated: it would add the rows again.
        """
        with self.audit.run(IMPORT, table.name) as run:
            text = read_delimited(self.spark, path, table.columns, style)
            rows = typed(text, table, date_pattern)
            added = self._replace_all(table, rows) if truncate_first else self.store.append(table, rows)
            run.stats = U.LoadStats(added, added, 0, f"{path} -> {table.name}")
            return run.stats

    def _replace_all(self, table: TableSpec, rows: DataFrame) -> int:
        """The rows as only content, written completely before any old one goes."""
        if not table.by_date:
            return self.store.rewrite(table, rows)["rows"]
        dates = F.collect_set(table.partition_by).alias(_DATES)
        seen = self.store.rewrite(_pending(table), rows, [dates])
        held = self.store.dates(table)
        self._finish_pending(table, sorted({*seen[_DATES], *held}))
        return seen["rows"]

    def import_many(
        self, files: Mapping[str, TableSpec], style: Delimited | None = None
    ) -> dict[str, U.LoadStats]:
        """Several files into their tables; one failure does not stop the others."""
        done, failed = {}, []
        for path, table in files.items():
            try:
                done[path] = self.import_csv(table, path, style)
            except Exception as problem:
                failed.append(problem)
        if failed:
            raise ExceptionGroup("some files were not imported", failed)
        return done

    # --- source copies and their marts -------------------------------------

    def _reload(self, table: TableSpec, plan: Callable[[], DataFrame]) -> U.LoadStats:
        with self.audit.run(MART, table.name) as run:
            rows = self.store.rewrite(table, plan())["rows"]
            run.stats = U.LoadStats(rows, rows)
            return run.stats

    def append_file_rows(self, table: TableSpec, extra: TableSpec) -> U.LoadStats:
        """Add the distinct rows of a file; not to be repeated."""
        read = self.store.read
        return self._reload(table, lambda: U.append_distinct(read(table), read(extra)))

    def replace_by_file_rows(self, table: TableSpec, extra: TableSpec) -> U.LoadStats:
        return self._reload(
            table, lambda: U.replace_with_distinct(self.store.read(extra))
        )

    def remove_duplicates(
        self, table: TableSpec, newest_first: Sequence[str]
    ) -> U.LoadStats:
        return self._reload(
            table, lambda: keep_freshest(self.store.read(table), table.key, newest_first)
        )

    def reload_loan_holidays(self) -> U.LoadStats:
        read = self.store.read
        return self._reload(
            S.LOAN_HOLIDAY_INFO,
            lambda: loan_holiday_info(
                read(S.DEAL), read(S.LOAN_HOLIDAY), read(S.PRODUCT)
            ),
        )

    def correct_balances(self) -> U.LoadStats:
        """Mend opening sums; only dates with a correction are rewritten."""
        table, store = S.SOURCE_BALANCE, self.store
        with self.audit.run(MART, table.name) as run:
            self._finish_pending(table)
            balances = store.read(table)
            fixes = opening_fixes(balances)
            held = TableSpec("work", f"{table.name}_fixes", fixes.schema)
            fixed = store.rewrite(held, fixes)["rows"]
            dates = _dates_of(store.read(held), table.partition_by)
            if dates:
                touched = store.read_dates(table, dates)
                store.rewrite(_pending(table), with_fixes(touched, store.read(held)))
                self._finish_pending(table)
            run.stats = U.LoadStats(fixed, 0, fixed)
            return run.stats

    def reload_balance_turnover(self) -> U.LoadStats:
        read = self.store.read
        return self._reload(
            S.BALANCE_TURNOVER,
            lambda: balance_turnover(
                read(S.SOURCE_ACCOUNT), read(S.SOURCE_BALANCE), read(S.CURRENCY_NAME)
            ),
        )


def _pending(table: TableSpec) -> TableSpec:
    return table.twin(f"{table.name}_pending", layer="work")


def _dates_of(rows: DataFrame, column: str) -> list[dt.date]:
    """The distinct dates of a stage: at most one per calendar day."""
    found = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    return sorted(r[0] for r in found.collect())


def _days(first: dt.date, last: dt.date) -> list[dt.date]:
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def _label(first: dt.date, last: dt.date) -> str:
    return first.isoformat() if first == last else f"{first.isoformat()}..{last.isoformat()}"
