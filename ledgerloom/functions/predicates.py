"""Conditions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def differs(left: Column, right: Column) -> Column:
    """Inequality in which two NULLs are the same value."""
    return ~left.eqNullSafe(right)


def valid_on(day: Column, start: Column, end: Column) -> Column:
    """Whether an open-ended version covers ``day``."""
    return day.between(start, F.coalesce(end, day))


def overlaps(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Whether an open-ended version touches the period first..last."""
    return (start <= last) & (end.isNull() | (end >= first))


# What makes a currency row acceptable.
LOWEST_CURRENCY_CODE = 1
HIGHEST_CURRENCY_CODE = 998
ISO_CODE_PATTERN = "^[A-Z]{3}\\z"
REFUSED_ISO_CODES = ("NON", "~")


def valid_currency(code: Column, iso: Column) -> Column:
    """Numeric code in range and a plausible three-letter code; never NULL."""
    return F.coalesce(
        code.isNotNull()
        & iso.isNotNull()
        & code.try_cast("int").between(LOWEST_CURRENCY_CODE, HIGHEST_CURRENCY_CODE)
        & iso.rlike(ISO_CODE_PATTERN)
        & ~iso.isin(*REFUSED_ISO_CODES),
        F.lit(False),
    )
