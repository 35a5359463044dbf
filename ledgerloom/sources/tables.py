"""Stored tables: Parquet folders under ``root/layer/table``.

Most tables are rewritten as a whole new folder ``version=N``; readers take the
highest one that Spark has marked complete, so a failed write changes nothing
and a table can be rewritten from itself. Big dated tables are partitioned by
their date and replaced date by date.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import TableSpec
from ledgerloom.sources.buckets import BucketedTable

_VERSION = "version="
_DONE = "_SUCCESS"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder every executor can reach, for tables that outlive one job.

    It lies where ``spark.checkpoint.dir`` says, and is deleted by the file
    system when the application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    folder = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}_{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


class TableStore:
    """Reads and writes the tables of one warehouse root."""

    def __init__(
        self, spark: SparkSession, root: str, keep_versions: int = 2, buckets: Mapping[str, int] | None = None
    ):
        """``buckets`` names keyed tables that are stored by hash of their key, with
        their number of buckets; the number must not change later."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = max(1, keep_versions)
        self.buckets = dict(buckets or {})

    def bucketed(self, spec: TableSpec) -> BucketedTable | None:
        """The table in its buckets, if it is one that has them."""
        count = self.buckets.get(spec.name) if spec.layer not in ("stage", "logs") else None
        return BucketedTable(self, spec, count) if count else None

    # --- places ------------------------------------------------------------

    def folder(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hadoop.getFileSystem(conf), hadoop

    def _children(self, path: str) -> list[str]:
        fs, where = self._fs_path(path)
        if not fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(where))

    def _remove(self, path: str) -> None:
        fs, where = self._fs_path(path)
        fs.delete(where, True)

    def _versions(self, spec: TableSpec) -> list[int]:
        numbers = [
            int(name[len(_VERSION):])
            for name in self._children(self.folder(spec))
            if name.startswith(_VERSION)
        ]
        return sorted(numbers)

    def _current(self, spec: TableSpec) -> int | None:
        for number in reversed(self._versions(spec)):
            if _DONE in self._children(f"{self.folder(spec)}/{_VERSION}{number}"):
                return number
        return None

    # --- reading -----------------------------------------------------------

    def exists(self, spec: TableSpec) -> bool:
        if table := self.bucketed(spec):
            return table.exists()
        if spec.by_date:
            return any(
                n.startswith(f"{spec.partition_by}=")
                for n in self._children(self.folder(spec))
            )
        return self._current(spec) is not None

    def read(self, spec: TableSpec) -> DataFrame:
        """The table with its declared schema; empty if it was never written."""
        if not self.exists(spec):
            return self.spark.createDataFrame([], spec.schema)
        if table := self.bucketed(spec):
            return table.read()
        folder = self.folder(spec)
        if not spec.by_date:
            folder = f"{folder}/{_VERSION}{self._current(spec)}"
        return (
            self.spark.read.schema(spec.schema).parquet(folder).select(*spec.columns)
        )

    def preview(self, spec: TableSpec, rows: int = 5) -> str:
        """Column types and the first rows, for a job log."""
        df = self.read(spec)
        types = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
        shown = "\n".join(str(tuple(r)) for r in df.limit(rows).collect())
        return f"{spec.name} ({types})\n{shown}"

    def dates(self, spec: TableSpec) -> list[dt.date]:
        """The dates a dated table has partitions of."""
        mark = f"{spec.partition_by}="
        found = [n[len(mark):] for n in self._children(self.folder(spec)) if n.startswith(mark)]
        return sorted(dt.date.fromisoformat(d) for d in found)

    def look_up(self, spec: TableSpec, **values) -> DataFrame:
        """Rows with these column values; a date reads its partition only, and
        row groups without the value are skipped by their statistics."""
        rows = self.read(spec)
        for name, value in values.items():
            rows = rows.filter(F.col(name) == F.lit(value))
        return rows

    def read_dates(self, spec: TableSpec, dates: Sequence[dt.date]) -> DataFrame:
        """Only the partitions of ``dates``."""
        return self.read(spec).filter(F.col(spec.partition_by).isin(list(dates)))

    # --- writing -----------------------------------------------------------

    def rewrite(
        self,
        spec: TableSpec,
        df: DataFrame,
        measures: Sequence[Column] = (),
        drop: Sequence[str] = (),
    ) -> dict[str, int]:
        """Write ``df`` as the new content; measure it during the same pass.

        ``measures`` are aggregates over ``df`` as given, columns in ``drop``
        included; these columns are not stored. Returns the measured values and
        the number of stored rows.
        """
        if spec.by_date:
            raise ValueError(f"{spec.name} is replaced by date")
        if table := self.bucketed(spec):
            return table.rewrite(df, measures, drop)
        watch = Observation()
        df = df.observe(watch, F.count(F.lit(1)).alias("rows"), *measures)
        versions = self._versions(spec)
        number = versions[-1] + 1 if versions else 1
        writer = df.drop(*drop).select(*spec.columns).write
        if spec.partition_by:
            writer = writer.partitionBy(spec.partition_by)
        writer.parquet(f"{self.folder(spec)}/{_VERSION}{number}")
        complete = [
            v
            for v in versions
            if _DONE in self._children(f"{self.folder(spec)}/{_VERSION}{v}")
        ]
        # The new version counts as one of those to keep.
        kept = complete[len(complete) - self.keep_versions + 1:]
        for old in set(versions) - set(kept):
            self._remove(f"{self.folder(spec)}/{_VERSION}{old}")
        return dict(watch.get)

    def truncate(self, spec: TableSpec) -> None:
        """Leave the table empty."""
        if spec.by_date:
            self._remove(self.folder(spec))
        else:
            self.rewrite(spec, self.spark.createDataFrame([], spec.schema))

    def append(self, spec: TableSpec, df: DataFrame) -> int:
        """Add rows without looking at keys; returns how many."""
        return self.append_measured(spec, df)["rows"]

    def append_measured(
        self, spec: TableSpec, df: DataFrame, measures: Sequence[Column] = ()
    ) -> dict[str, int]:
        """``append`` that takes ``measures`` of the added rows in the same pass."""
        if table := self.bucketed(spec):
            return table.append(df, measures)
        current = self._current(spec)
        if current is None and not spec.by_date:
            return self.rewrite(spec, df, measures)
        folder = self.folder(spec)
        watch = Observation()
        writer = (
            df.select(*spec.columns)
            .observe(watch, F.count(F.lit(1)).alias("rows"), *measures)
            .write.mode("append")
        )
        if spec.partition_by:
            writer = writer.partitionBy(spec.partition_by)
        writer.parquet(folder if spec.by_date else f"{folder}/{_VERSION}{current}")
        return dict(watch.get)

    def replace_dates(
        self,
        spec: TableSpec,
        df: DataFrame,
        dates: Sequence[dt.date],
        compact: bool = False,
    ) -> int:
        """Replace the partitions of ``dates`` by the rows of ``df``.

        A date for which ``df`` has no rows ends up empty: dynamic overwrite
        leaves such a partition alone, so it is removed afterwards. A row of any
        other date fails the job, as it would wipe out that date. Every task
        writes one file per date it holds, without another shuffle; ``compact``
        gathers the rows by date first, for a result that is small beside the
        number of tasks (Spark splits a date too large for one task).
        """
        column, folder = spec.partition_by, self.folder(spec)
        day = F.col(column)
        stray = F.format_string("%s is not a date to replace", day.cast("string"))
        expected = F.when(day.isin(list(dates)), day).otherwise(
            F.raise_error(stray).cast("date")
        )
        places = {d: f"{folder}/{column}={d.isoformat()}" for d in dates}
        before = {d: set(self._children(p)) for d, p in places.items()}
        watch = Observation()
        rows = (
            df.select(*spec.columns)
            .withColumn(column, expected)
            .observe(watch, F.count(F.lit(1)).alias("rows"))
        )
        (
            (rows.hint("rebalance", column) if compact else rows)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(folder)
        )
        for day, place in places.items():
            left = before[day]
            if left and left == set(self._children(place)):
                self._remove(place)
        return watch.get["rows"]
