"""Audit trail: one appended event per phase of a run, and its latest state."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.messages import STARTED_TEXT
from ledgerloom.operators.upsert import LoadStats
from ledgerloom.schemas import AUDIT_EVENT
from ledgerloom.sources.tables import TableStore

# States of a run.
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"

_COUNTERS = ("input_rows", "inserted_rows", "updated_rows", "skipped_rows")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


@dataclass
class Run:
    """Handle of a run in progress; ``stats`` is what its end event reports."""

    run_id: str
    stats: LoadStats = field(default_factory=LoadStats)
    # What a job shows of its table: types and first rows; not stored.
    preview: str | None = None


class AuditLog:
    def __init__(self, store: TableStore, clock: Callable[[], dt.datetime] = utc_now):
        self.store = store
        self.clock = clock
        # Two appends to one folder at a time would clear each other's temporary files.
        self._one_at_a_time = threading.Lock()

    def _event(
        self, run: Run, process: str, table: str, status: str, message: str | None
    ) -> None:
        s = run.stats
        with self._one_at_a_time:
            row = (
                run.run_id,
                process,
                table,
                self.clock(),
                status,
                message,
                s.input,
                s.inserted,
                s.updated,
                s.skipped,
            )
            event = self.store.spark.createDataFrame([row], AUDIT_EVENT.schema)
            self.store.append(AUDIT_EVENT, event.coalesce(1))

    @contextmanager
    def run(
        self, process: str, table: str, run_id: str | None = None
    ) -> Iterator[Run]:
        """Record start and outcome of the block; a failure is recorded and raised."""
        run = Run(run_id or uuid.uuid4().hex)
        self._event(run, process, table, STARTED, STARTED_TEXT)
        try:
            yield run
        except Exception as problem:
            run.stats = LoadStats()
            self._event(run, process, table, FAILED, str(problem))
            raise
        self._event(run, process, table, SUCCESS, run.stats.message)

    def events(self) -> DataFrame:
        return self.store.read(AUDIT_EVENT)

    def latest(self) -> DataFrame:
        return latest_states(self.events())


def latest_states(events: DataFrame) -> DataFrame:
    """One row per run: start, end, and the state and counters of its last event.

    Both ends come from one aggregation that combines on the map side. Of
    events at one instant the outcome wins over the start.
    """
    last = F.max_by(
        F.struct("process", "table_name", "status", "message", *_COUNTERS),
        F.struct("event_time", F.col("status") != STARTED, "status"),
    )
    return (
        events.groupBy("run_id")
        .agg(
            F.min(F.when(F.col("status") == STARTED, F.col("event_time"))).alias(
                "start_time"
            ),
            F.max(F.when(F.col("status") != STARTED, F.col("event_time"))).alias(
                "end_time"
            ),
            last.alias("last"),
        )
        .select(
            "run_id",
            "last.process",
            "last.table_name",
            "start_time",
            "end_time",
            "last.status",
            "last.message",
            *[f"last.{c}" for c in _COUNTERS],
        )
    )
