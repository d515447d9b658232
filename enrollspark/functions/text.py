"""Scalar rules shared by the record layouts and the state table.

All helpers return ``Column`` expressions over built-in functions, so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File dates are 8-digit strings, state dates ISO strings.
FILE_DATE_FORMAT = "yyyyMMdd"
STATE_DATE_FORMAT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def spaces(n: int) -> Column:
    """``n`` blanks (SQL ``space(n)``)."""
    return F.lit(" " * n)


def pad(c: str | Column, width: int) -> Column:
    """Trim spaces, print null as one blank, then right-pad or cut to ``width`` characters."""
    return F.rpad(F.coalesce(F.trim(_col(c)), F.lit(" ")), width, " ")


def is_blank(c: str | Column) -> Column:
    """True when the value is null or only spaces."""
    t = F.trim(_col(c))
    return t.isNull() | (t == "")


def blank_to_empty(c: str | Column) -> Column:
    """Null or all-space values become ``''``; anything else is kept untrimmed."""
    c = _col(c)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit("")).otherwise(c)


def parse_ymd(c: str | Column) -> Column:
    """``yyyyMMdd`` string to ``date``; blank or impossible dates give null instead of failing.

    Fields are padded with blanks, so blanks behind the digits count for nothing; a
    blank before them makes the date impossible.
    """
    return F.try_to_date(F.rtrim(_col(c)), FILE_DATE_FORMAT)


def ymd_to_iso(c: str | Column) -> Column:
    """``yyyyMMdd`` string to ``yyyy-MM-dd`` string (null when unparseable)."""
    return F.date_format(parse_ymd(c), STATE_DATE_FORMAT)


def row_key(member: str | Column, eff_ymd: str | Column) -> Column:
    """State row key ``<member>_<yyyy-MM-dd>``; a null part is skipped as in ``concat_ws``."""
    return F.concat_ws("", _col(member), F.lit("_"), ymd_to_iso(eff_ymd))
