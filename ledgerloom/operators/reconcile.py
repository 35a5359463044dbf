"""Compare a stored table with a newer file, row by row.

One aggregation answers all three questions (only here, only there, in both):
both inputs are stacked, grouped by every column, and each group remembers
where it was seen. Rows are combined before the shuffle, and grouping treats
NULLs as equal, as the set operations do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lookup import spread_join

_LEFT, _RIGHT = "_in_left", "_in_right"


def compare_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both inputs with two flags telling where they occur."""
    columns = left.columns
    stacked = left.select(
        *columns, F.lit(True).alias(_LEFT), F.lit(False).alias(_RIGHT)
    ).unionByName(
        right.select(*columns, F.lit(False).alias(_LEFT), F.lit(True).alias(_RIGHT))
    )
    return stacked.groupBy(*columns).agg(
        F.max(_LEFT).alias(_LEFT), F.max(_RIGHT).alias(_RIGHT)
    )


def only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    return (
        compare_tables(left, right)
        .filter(F.col(_LEFT) & ~F.col(_RIGHT))
        .select(*left.columns)
    )


def only_right(left: DataFrame, right: DataFrame) -> DataFrame:
    return (
        compare_tables(left, right)
        .filter(~F.col(_LEFT) & F.col(_RIGHT))
        .select(*left.columns)
    )


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    return (
        compare_tables(left, right)
        .filter(F.col(_LEFT) & F.col(_RIGHT))
        .select(*left.columns)
    )


def difference_summary(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with the three counts."""
    here, there = F.col(_LEFT), F.col(_RIGHT)
    return compare_tables(left, right).agg(
        F.count_if(here & ~there).alias("only_left"),
        F.count_if(~here & there).alias("only_right"),
        F.count_if(here & there).alias("common"),
    )


def corrected_rows(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of the newer file whose key occurs in the rows found only here."""
    suspects = only_left(left, right).select(*key).distinct()
    return spread_join(right, suspects, key, "left_semi").select(*right.columns)
