"""Joins shaped for very uneven keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rates_by_day(rates: DataFrame, first: Column, last: Column) -> DataFrame:
    """Validity periods of rates as one row per currency and day in first..last.

    Turns the interval join into an equality join on (currency, day). A period
    without an end date matches nothing, exactly as BETWEEN with NULL does, and
    overlapping periods give several rows for a day, as the interval join would.
    """
    first_day, last_day = F.col("data_actual_date"), F.col("data_actual_end_date")
    days = F.sequence(F.greatest(first_day, first), F.least(last_day, last))
    return rates.filter(
        last_day.isNotNull()
        & (first_day <= last)
        & (last_day >= first)
        & (first_day <= last_day)
    ).select(
        "currency_rk",
        F.explode(days).alias("on_date"),
        F.col("reduced_cource").alias("rate"),
    )


_HASH = "_key_hash"


def spread_join(
    left: DataFrame, right: DataFrame, key: Sequence[str], how: str
) -> DataFrame:
    """Key join in which a hot key of ``left`` can be split over tasks.

    At run time Spark splits an oversized partition only if both sides come
    straight from an exchange made for the join. A right side grouped by the
    same key would share the exchange of the grouping, and the hot key would
    stay in one task. Joining on the key and its hash gives each side an
    exchange of its own; for the right side, one row per key, that is cheap.
    """
    key = list(key)
    hashed = F.xxhash64(*key).alias(_HASH)
    return (
        left.select("*", hashed)
        .join(right.select("*", hashed), [*key, _HASH], how)
        .drop(_HASH)
    )


def left_join_many(
    few: DataFrame, many: DataFrame, key: Sequence[str]
) -> DataFrame:
    """``few`` left join ``many`` where one key may own a large part of ``many``.

    A left join can neither split a hot key on its right side nor broadcast its
    left side. The same rows come from an inner join, which can do both, plus
    the rows of ``few`` whose key does not occur in ``many``.
    """
    key = list(key)
    paired = few.join(many, key, "inner")
    present = many.select(*key).distinct()
    extra = [f for f in many.schema if f.name not in key]
    alone = few.join(present, key, "left_anti").select(
        *few.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    )
    return paired.unionByName(alone)


# A repeated row is written out in runs of at most this many copies.
RUN = 10_000


def numbered_copies(df: DataFrame, rows: str, by: Sequence[str]) -> DataFrame:
    """Each row as often as its column ``rows`` says, numbered in ``_copy``.

    The copies are made run by run, and the runs are spread over tasks, so
    neither an array nor a task ever holds a whole hot group. The number of
    tasks is given outright: runs are few bytes each, and Spark would otherwise
    put them together again.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("_start") + RUN - 1, F.col(rows))
    return (
        df.withColumn("_start", F.explode(F.sequence(F.lit(1), F.col(rows), F.lit(RUN))))
        .repartition(tasks, *by, "_start")
        .withColumn("_copy", F.explode(F.sequence(F.col("_start"), last)))
        .drop("_start")
    )


# Tasks for each core where the number is given outright.
WAVES = 8


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """The same rows over several tasks for each core, evenly or by a key.

    For rows that take far more room in a task than in a shuffle file. The
    number of tasks is given outright: Spark counts shuffled bytes and would put
    the rows together again, into one task for each core.
    """
    return df.repartition(WAVES * df.sparkSession.sparkContext.defaultParallelism, *by)
