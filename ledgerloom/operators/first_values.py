"""The first few values in order, without holding all of them anywhere.

An ordered list of a key's values needs a task that holds them. A list of the
first N does not: each task keeps the N least of a key before the exchange, and
what meets there is N values a task at most. Repeated values are combined first,
so a hot key arrives as its different values, spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHOWN, TOTAL = "shown", "total"


def first_values(df: DataFrame, key: Sequence[str], value: str, most: int) -> DataFrame:
    """Per key: ``total``, how many different values it has, and ``shown``, the
    first ``most`` of them in order. NULL is no value; a key with nothing else has
    an empty list."""
    key = list(key)
    each = df.select(*key, F.col(value).alias("_value")).distinct()
    totals = each.groupBy(*key).agg(F.count("_value").alias(TOTAL))
    # Spark applies the limit per task ahead of the exchange.
    place = F.row_number().over(Window.partitionBy(*key).orderBy("_value"))
    least = each.filter(F.col("_value").isNotNull()).withColumn("_place", place).filter(F.col("_place") <= most)
    shown = least.groupBy(*key).agg(F.array_sort(F.collect_list("_value")).alias(SHOWN))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key]
    empty = F.array().cast(shown.schema[SHOWN].dataType)
    return totals.alias("t").join(shown.alias("s"), same, "left").select(
        *[f"t.{k}" for k in key], TOTAL, F.coalesce(SHOWN, empty).alias(SHOWN)
    )


def first_of_all(df: DataFrame, value: str, most: int) -> DataFrame:
    """One row: ``total`` rows, and ``shown``, the first ``most`` different values."""
    # The N least of each task are merged, nothing else leaves it.
    least = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("_value")).distinct().orderBy("_value").limit(most)
    shown = least.agg(F.array_sort(F.collect_list("_value")).alias(SHOWN))
    total = df.agg(F.count(F.lit(1)).alias(TOTAL)).scalar()
    return shown.select(total.alias(TOTAL), SHOWN)
