"""Incremental load of newly dropped files into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.jobs import IngestSpec, Warehouse
from ledgerloom.schemas import TableSpec
from ledgerloom.sources.csv_files import (
    MALFORMED,
    UTF8,
    BadFileError,
    clean_text,
    decoded,
    reading,
    strict_options,
    text_schema,
    undecodable,
)

PROCESS = "file_drop"
_FILE = "_file"


def bad_files_table(spec: IngestSpec) -> TableSpec:
    """Files that were set aside, with the reason and their number of rows."""
    fields = [T.StructField(c, T.StringType()) for c in ("file", "reason")]
    return TableSpec("logs", f"bad_files_{spec.table.name}", T.StructType([*fields, T.StructField("rows", T.LongType())]))


def judged_files(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each file of a batch: file, rows, reason (NULL if it is good)."""
    broken, torn = F.count_if(undecodable(columns)), F.count_if(F.col(MALFORMED).isNotNull())
    seen = rows.groupBy(F.col(_FILE).alias("file")).agg(F.count(F.lit(1)).alias("rows"), broken.alias("broken"), torn.alias("torn"))
    reason = (
        F.when(F.col("broken") > 0, F.format_string("%d undecodable rows", "broken"))
        .when(F.col("torn") > 0, F.format_string("%d rows with a wrong number of fields", "torn"))
    )
    return seen.select("file", reason.alias("reason"), "rows")


def load_dropped_files(
    warehouse: Warehouse,
    spec: IngestSpec,
    folder: str,
    checkpoint: str,
    encoding: str = UTF8,
) -> None:
    """Load every file of ``folder`` not loaded before, then stop.

    The checkpoint remembers finished files. A batch repeated after a failure
    does no harm: loading the same rows again changes nothing.

    A file with texts that the encoding does not decode, or with rows of a wrong
    number of fields, is set aside: it is listed in ``bad_files_table`` and as a
    failed run in the audit log, none of its rows is loaded, and the other files
    of its batch are. A header other than the expected columns, in order, still
    ends the stream, as Spark checks it while it opens a file.
    """
    aside, store = bad_files_table(spec), warehouse.store

    def load_batch(rows: DataFrame, batch: int) -> None:
        named = decoded(rows, encoding)
        # A batch has its list of files on the driver already.
        bad = judged_files(named, spec.wanted).filter("reason IS NOT NULL")
        known = store.read(aside).select("file")
        found = bad.join(known, "file", "left_anti").collect()
        for file, reason, _ in found:
            try:
                with warehouse.audit.run(PROCESS, spec.table.name):
                    raise BadFileError(f"{file}: {reason}")
            except BadFileError:
                continue
        if found:
            store.append(aside, warehouse.spark.createDataFrame(found, aside.schema))
        # Repeated after a failure, a batch finds its bad files listed already.
        good = named.join(store.read(aside).select(F.col("file").alias(_FILE)), _FILE, "left_anti")
        warehouse.load_rows(spec, clean_text(good, spec.wanted, spec.style.missing), PROCESS)

    (
        strict_options(warehouse.spark.readStream)
        .schema(text_schema(spec.wanted))
        .option("header", True)
        .option("sep", spec.style.sep)
        .option("escape", '"')
        .option("encoding", reading(encoding))
        .csv(folder)
        .withColumn(_FILE, F.col("_metadata.file_path"))
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
