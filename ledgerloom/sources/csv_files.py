"""Delimited files: reading with explicit columns, writing, encodings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ledgerloom.functions.casts import (
    MISSING_TOKENS,
    lower_names,
    null_tokens,
)

# Fixed value: what an undecodable byte turns into.
REPLACEMENT_CHARACTER = "\N{REPLACEMENT CHARACTER}"
UTF8 = "UTF-8"
ENCODINGS = (UTF8, "windows-1251")


@dataclass(frozen=True)
class Delimited:
    """How a delimited file is written down."""

    sep: str = ";"
    null_text: str = "NULL"
    missing: Sequence[str] = MISSING_TOKENS
    # Line breaks inside quotes; such a file is read by one task per file.
    multi_line: bool = False
    encodings: Sequence[str] = ENCODINGS


class ColumnError(ValueError, LookupError):
    """A wanted column is not in the header."""


class EncodingError(ValueError):
    """No candidate encoding decodes all of a file."""


class BadFileError(ValueError):
    """A file that is set aside."""


# Bytes read one by one: every byte becomes the character of its number.
_BYTES = "ISO-8859-1"
_BUILT_IN = ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32")


def reading(encoding: str) -> str:
    """The encoding a file is read in; single-byte code pages are read as bytes
    and decoded by ``decoded``, as Spark knows only a few by name."""
    return encoding if encoding.upper() in _BUILT_IN else _BYTES


def _code_page(encoding: str) -> tuple[str, str]:
    """The upper half of a code page: bytes as characters, and what they mean."""
    upper = bytes(range(0x80, 0x100))
    meant = upper.decode(encoding, "replace")
    if len(meant) != len(upper):
        raise EncodingError(f"{encoding} is not a single-byte code page")
    return upper.decode(_BYTES), meant


def decoded(rows: DataFrame, encoding: str) -> DataFrame:
    """Text columns read as bytes, in the characters of their code page; a byte
    without meaning there becomes the replacement character."""
    if reading(encoding) == encoding:
        return rows
    found, meant = _code_page(encoding)
    texts = {f.name for f in rows.schema if isinstance(f.dataType, T.StringType)}
    return rows.select(
        *[
            F.translate(F.col(f"`{c}`"), found, meant).alias(c) if c in texts else F.col(f"`{c}`")
            for c in rows.columns
        ]
    )


def _named(rows: DataFrame, encoding: str) -> DataFrame:
    """Header names in the characters of the code page."""
    if reading(encoding) == encoding:
        return rows
    table = str.maketrans(*_code_page(encoding))
    return rows.toDF(*[c.translate(table) for c in rows.columns])


def _reader(spark: SparkSession, style: Delimited, encoding: str):
    return (
        spark.read.option("header", True)
        .option("sep", style.sep)
        .option("escape", '"')
        .option("encoding", reading(encoding))
        .option("multiLine", style.multi_line)
        .option("inferSchema", False)
    )


def undecodable(columns: Sequence[str]) -> Column:
    """Whether a text in one of the columns was read with a wrong encoding."""
    texts = [F.col(f"`{c}`") for c in columns]
    return F.concat_ws("", *texts).contains(REPLACEMENT_CHARACTER)


def resolve_encoding(spark: SparkSession, path: str, style: Delimited) -> str:
    """The first candidate encoding that decodes the whole file.

    Each try is a distributed scan that stops at the first undecodable text. A
    file that no candidate decodes is an error.
    """
    for encoding in style.encodings:
        rows = _named(_reader(spark, style, encoding).csv(path), encoding)
        names_ok = not any(REPLACEMENT_CHARACTER in c for c in rows.columns)
        if names_ok and decoded(rows, encoding).filter(undecodable(rows.columns)).isEmpty():
            return encoding
    raise EncodingError(f"{path} is in none of {', '.join(style.encodings)}")


# Holds the text of a row whose number of fields is wrong.
MALFORMED = "_malformed"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text, and a place for malformed rows."""
    names = [*columns, MALFORMED]
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def strict_options(reader: DataFrameReader | DataStreamReader):
    """Check the header of every file, and mark rows that do not fit it.

    Fields are only counted when no column is skipped while parsing.
    """
    return (
        reader.option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)
    )


def clean_text(
    rows: DataFrame, columns: Sequence[str], missing: Sequence[str]
) -> DataFrame:
    """The wanted columns with missing values as NULL.

    A malformed row fails the job: its values would be in the wrong columns.
    """
    first, *others = columns
    problem = F.raise_error(F.concat(F.lit("malformed row: "), F.col(MALFORMED)))
    checked = F.when(F.col(MALFORMED).isNull(), F.col(first)).otherwise(
        problem.cast("string")
    )
    return null_tokens(rows.select(checked.alias(first), *others), missing)


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    style: Delimited | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """Named columns of a delimited file, all as text, missing values as NULL.

    Columns are found by header name in any case and order. Types are applied
    afterwards by ``functions.casts.typed``; nothing is inferred, so account
    numbers longer than 64 bits and leading zeros survive.
    """
    style = style or Delimited()
    encoding = encoding or resolve_encoding(spark, path, style)
    header = _reader(spark, style, encoding).csv(path).columns
    rows = strict_options(_reader(spark, style, encoding)).schema(text_schema(header))
    named = lower_names(_named(decoded(rows.csv(path), encoding), encoding))
    lacking = [c for c in columns if c not in named.columns]
    if lacking:
        raise ColumnError(f"{path}: no column {', '.join(lacking)} in the header")
    return clean_text(named, columns, style.missing)


def write_delimited(
    df: DataFrame, path: str, style: Delimited | None = None, encoding: str = UTF8
) -> int:
    """Write a folder of delimited part files with headers; returns the row count."""
    style = style or Delimited()
    watch = Observation()
    if reading(encoding) != encoding:
        found, meant = _code_page(encoding)
        df = df.select(
            *[
                F.translate(F.col(f"`{f.name}`"), meant, found).alias(f.name)
                if isinstance(f.dataType, T.StringType)
                else F.col(f"`{f.name}`")
                for f in df.schema
            ]
        )
    (
        df.observe(watch, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", style.sep)
        .option("nullValue", style.null_text)
        .option("escape", '"')
        .option("encoding", reading(encoding))
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return watch.get["rows"]
