"""Key, completeness and continuity checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import numbered_copies
from ledgerloom.operators.versions import ROW_COUNT, repeated_keys


# Fixed value: the day an open-ended version is taken to last to.
OPEN_END = dt.date(9999, 12, 31)


class DataCheckError(ValueError):
    """Stored data would break the definition of its table."""


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are not unique, with their row count."""
    return repeated_keys(df, key)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL per column (column_name, null_rows), in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows"))
            for c in columns
        ]
    )
    return counted.select(F.inline(pairs))


def overlapping_versions(
    df: DataFrame,
    key: Sequence[str],
    start: str = "data_actual_date",
    end: str = "data_actual_end_date",
) -> DataFrame:
    """Version starts that fall into another version of the same key.

    One row per (key, start) with the number of versions beginning there and
    ``reaches``, the latest day an earlier version lasts to (an open end counts
    as the last possible day). Versions are combined per start first, so the
    window sees each calendar day of a key at most once.
    """
    last_day = F.max(F.coalesce(F.col(end), F.lit(OPEN_END)))
    earlier = (
        W.partitionBy(*key)
        .orderBy(start)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        df.filter(F.col(start).isNotNull())
        .groupBy(*key, start)
        .agg(F.count(F.lit(1)).alias(ROW_COUNT), last_day.alias("_to"))
        .withColumn("reaches", F.max("_to").over(earlier))
        .filter((F.col(ROW_COUNT) > 1) | (F.col("reaches") >= F.col(start)))
        .select(*key, start, ROW_COUNT, "reaches")
    )


def enforce_key(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """The same rows; the job reading them fails on a repeated or NULL key.

    The check rides along in the plan, so a mart is computed once, not once for
    the check and once for the write. Rows already distributed by (part of) the
    key are not shuffled again.
    """
    others = [c for c in df.columns if c not in key]
    broken = F.col("_rows") > 1
    for k in key:
        broken = broken | F.col(k).isNull()
    shown = F.format_string(
        f"{name}: key is not unique or NULL: " + ", ".join(f"{k}=%s" for k in key),
        *[F.col(k).cast("string") for k in key],
    )
    first = key[0]
    checked = F.when(broken, F.raise_error(shown).cast(df.schema[first].dataType))
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in others])
        .withColumn(first, checked.otherwise(F.col(first)))
        .select(*df.columns)
    )


def date_gaps(
    df: DataFrame, entity: str = "account_rk", day: str = "effective_date"
) -> DataFrame:
    """Rows whose next date of the same entity is not the following day.

    The next row of a repeated date has that same date, so repeats are reported
    with a difference of zero. Counting per (entity, date) comes first: the
    window then sees each calendar day of an entity once, however many rows a
    hot entity has, and the repeats are written out from the counts.
    """
    # The last date has no successor, and rows without a date come after it.
    counted = (
        df.filter(F.col(day).isNotNull())
        .groupBy(entity, day)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    next_day = F.lead(day).over(W.partitionBy(entity).orderBy(day))
    is_gap = F.coalesce(F.col("next_date") != F.date_add(day, 1), F.lit(False))
    found = counted.withColumn("next_date", next_day).filter(
        is_gap | (F.col("_rows") > 1)
    )
    # All copies of a day but the last are followed by the same day.
    follower = F.when(F.col("_copy") < F.col("_rows"), F.col(day)).otherwise(
        F.col("next_date")
    )
    return (
        numbered_copies(found, "_rows", [entity, day])
        .withColumn("next_date", follower)
        .filter(is_gap)
        .select(entity, day, "next_date", F.datediff("next_date", day).alias("date_diff"))
    )
