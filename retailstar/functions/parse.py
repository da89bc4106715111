"""Parsing and casting (X3, X4, X5, X6): text to numbers never throws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the quarter pattern of the ETL; the digit is group 1.
QUARTER_PATTERN = r"Q([1-4])"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: Column | str, to: str) -> Column:
    """Cast that yields null instead of failing under ANSI mode."""
    return _c(c).try_cast(to)


def parse_quarter(c: Column | str) -> Column:
    """'Q3 2012' -> 3; no match, empty or null -> null."""
    digit = F.regexp_extract(F.trim(_c(c)), QUARTER_PATTERN, 1)
    return F.when(digit != "", try_cast(digit, "int"))


def first_number(c: Column | str) -> Column:
    """First run of digits as int (the pandas ``str.extract('(\\d+)')``)."""
    digit = F.regexp_extract(_c(c), r"(\d+)", 1)
    return F.when(digit != "", try_cast(digit, "int"))


def char_at_as_int(c: Column | str, pos: int) -> Column:
    """``CAST(SUBSTRING(s, pos, 1) AS UNSIGNED)``."""
    return try_cast(F.substring(_c(c), pos, 1), "int")
