"""Texts written to the audit log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of the log messages.
MISMATCH = "Несоответствие данных - "
FILLED_FOR = "Добавлены данные за "
STARTED_TEXT = "Data load started"
TO = " .. "


def mismatch_line(columns: Sequence[str]) -> Column:
    """One line naming a rejected row by ``columns``; NULL prints as nothing."""
    template = MISMATCH + ", ".join(f"{c}: %s" for c in columns)
    return F.format_string(
        template, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    )


def mismatch_lines(rejects: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every rejected row as one text line; stays distributed."""
    return rejects.select(mismatch_line(columns).alias("line"))


LINE = "line"


def summary_measures(line: str = LINE) -> list[Column]:
    """Aggregates over all reject lines: how many, the least and the greatest."""
    return [
        F.count(F.lit(1)).alias("rejected_rows"),
        F.min(line).alias("least"),
        F.max(line).alias("greatest"),
    ]


def summary_text(total: Column, least: Column, greatest: Column) -> Column:
    """The log text of these aggregates; NULL if there are no rejects."""
    one = F.concat(total.cast("string"), F.lit(": "), least)
    return F.when(total == 0, None).when(least == greatest, one).otherwise(F.concat(one, F.lit(TO), greatest))


def lines_summary(lines: DataFrame) -> DataFrame:
    """One row about all of ``lines``: their number, and a text that names the
    first and the last in text order.

    The list itself stays a table, which a load writes out by run, so neither
    the log text nor a task has to hold it.
    """
    columns = [F.col(c) for c in ("rejected_rows", "least", "greatest")]
    return lines.agg(*summary_measures()).select("rejected_rows", summary_text(*columns).alias("message"))
