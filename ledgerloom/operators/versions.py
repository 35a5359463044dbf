"""Duplicate versions of a business key: find them, count them, keep one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import spread_join

ROW_COUNT = "row_count"


def keep_freshest(
    df: DataFrame, key: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """One row per key: the greatest by ``newest_first``, NULL counting as newest.

    The remaining columns break ties, so equal runs give equal tables. The
    ``== 1`` filter lets Spark drop losers in each task before the shuffle.
    """
    others = [c for c in df.columns if c not in key and c not in newest_first]
    order = [F.col(c).desc_nulls_first() for c in [*newest_first, *others]]
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(ROW_COUNT))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many rows they have."""
    return key_counts(df, key).filter(F.col(ROW_COUNT) > 1)


def distinct_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(*key).distinct()


def rows_with_repeated_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows whose key occurs again; rows with a NULL in the key never do.

    Counting first and joining back keeps the exchange of the counts small and
    lets a hot key's rows be split over tasks, which a window would forbid.
    """
    again = repeated_keys(df, key).select(*key)
    return spread_join(df, again, key, "left_semi").select(*df.columns)


def in_key_order(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ascending, NULL last: for showing a result, never inside a plan."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in key])


def names_by_key(df: DataFrame, key: Sequence[str], name: str, between: str = "; ") -> DataFrame:
    """Per key the distinct names of its versions, in order, as one text.

    For keys whose versions are bounded by nature, such as one per calendar day.
    """
    names = F.array_sort(F.collect_set(name))
    return df.groupBy(*key).agg(F.array_join(names, between).alias("names"))


def version_profile(
    df: DataFrame,
    start: str = "effective_from_date",
    end: str = "effective_to_date",
) -> DataFrame:
    """Number of rows per pair of version dates."""
    return key_counts(df, [start, end])
