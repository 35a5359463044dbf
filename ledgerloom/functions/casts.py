"""Text to typed columns, the way the loads need it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import TableSpec

# Date patterns of the source files. "d.M" also takes two digits.
ISO_DATE = "yyyy-MM-dd"
DOTTED_DATE = "d.M.yyyy"

# Texts a delimited file may use for "no value".
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# Fixed value: ISO dates that a plain cast reads as their pattern does; no year 0 or sign.
_PLAIN_ISO = "^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$"


def parse_date(text: Column, pattern: str, lenient: bool = False) -> Column:
    """Date from text. A bad text fails the job unless ``lenient`` (then NULL).

    A cast takes a third of the time of a pattern; what it does not read, and any
    other text, goes by the pattern.
    """
    by_pattern = (F.try_to_date if lenient else F.to_date)(text, pattern)
    if pattern != ISO_DATE:
        return by_pattern
    return F.coalesce(F.when(text.rlike(_PLAIN_ISO), text.try_cast("date")), by_pattern)


def cut_text(value: Column, width: int) -> Column:
    """Text of at most ``width`` characters; the rest is cut off silently."""
    return F.substring(value.cast("string"), 1, width)


def as_type(value: Column, kind: T.DataType, lenient: bool = False) -> Column:
    return value.try_cast(kind) if lenient else value.cast(kind)


def null_tokens(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Turn the listed texts into NULL in every text column."""
    return df.select(
        *[
            F.when(~F.col(f.name).isin(*tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def typed(
    df: DataFrame,
    spec: TableSpec,
    date_pattern: str | Mapping[str, str] = ISO_DATE,
    columns: Sequence[str] | None = None,
    lenient: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cast all-text columns to the types of ``spec`` (one projection).

    Columns in ``keep`` are passed on as they are.
    """
    widths = dict(spec.widths)
    wanted = spec.columns if columns is None else columns
    out = []
    for name in wanted:
        kind, source = spec.schema[name].dataType, F.col(name)
        if isinstance(kind, T.DateType):
            pattern = (
                date_pattern
                if isinstance(date_pattern, str)
                else date_pattern.get(name, ISO_DATE)
            )
            value = parse_date(source, pattern, lenient)
        elif name in widths:
            value = cut_text(source, widths[name])
        else:
            value = as_type(source, kind, lenient)
        out.append(value.alias(name))
    return df.select(*out, *keep)


def empty_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the columns of ``spec`` that ``df`` lacks, as typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name)
            if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spec.schema
        ]
    )
