"""Work tables of an operator: Parquet in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def base_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    A session in one process that has no such setting gets a folder under its
    warehouse; a cluster must have the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/ledgerloom-work"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


@lru_cache
def _ship(application: str) -> str:
    """This package as an archive; the driver's file server hands it out."""
    top = Path(__file__).resolve().parent.parent
    where = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / f"{top.name}.zip"
    with zipfile.ZipFile(where, "w") as archive:
        for path in sorted(top.rglob("*.py")):
            archive.write(path, path.relative_to(top.parent))
    return str(where)


#: Bytes of an Arrow batch. Spark bounds rows only, and 10,000 long texts in one
#: batch, held by the JVM and by a Python worker at once, are most of what an
#: executor needs.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run, and bound what
    they are sent at once, unless the session has a bound of its own."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    where = _ship(context.applicationId)
    if Path(where).name not in {Path(str(p)).name for p in context._python_includes}:
        context.addPyFile(where)


class Work:
    """Writes intermediate tables and forgets those no longer needed.

    What is left is deleted by the file system when the application ends, since
    the returned frame still reads it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{base_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self.kept = 0
        ship_code(spark)
        fs, path = self._place(self.folder)
        fs.deleteOnExit(path)

    def _place(self, where: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.kept += 1
        where = f"{self.folder}/{self.kept}-{name}"
        df.write.parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out.work_path = where
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no frame in use reads any more."""
        for table in tables:
            fs, path = self._place(table.work_path)
            fs.delete(path, True)


def rows_of(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns``, in case the input has others with clashing names."""
    return df.select(*columns)


def row_key(*columns: str) -> list[Column]:
    """Two columns that stand for a row: its id, and a hash that also tells
    apart a missing id and several texts under one id."""
    return [
        F.coalesce(F.col("doc_id"), F.lit(-1)).alias("_id"),
        F.xxhash64(F.col("doc_id").isNull(), F.coalesce(F.col("text"), F.lit(""))).alias("_row"),
    ]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
