"""Dates: zero-date clean-up, month range, days overdue."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_date(col: Column) -> Column:
    """Text, date or timestamp to date; the all-zero sentinel and other bad text give NULL."""
    return col.try_cast("date")


def month_bounds(as_of: date) -> tuple[date, date]:
    first = as_of.replace(day=1)
    following = date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first, following


def in_month(col: Column, as_of: date, dtype: T.DataType | None = None) -> Column:
    """True in the as-of month, NULL for a NULL date.

    A half-open range of literals, so that it reaches the scan as a pushed filter. Of a text column (by
    ``dtype``) ``clean_date`` decides; what reaches the scan is a range of the year, from which only
    text can be missing that is no date of the year: a date's text starts with its year unless blanks,
    a sign or leading zeros precede it, and those sort below 1 or are the delete character.
    """
    first, following = month_bounds(as_of)
    if isinstance(dtype, T.StringType):
        day, year = clean_date(col), f"{first.year:04d}"
        of_year = (col >= F.lit(year)) & (col < F.lit(year[:-1] + chr(ord(year[-1]) + 1)))
        odd = (col < F.lit("1")) | (col >= F.lit("\x7f"))
        return (of_year | odd) & (day >= F.lit(first)) & (day < F.lit(following))
    return (col >= F.lit(first)) & (col < F.lit(following))


def column_in_month(df: DataFrame, name: str, as_of: date) -> Column:
    return in_month(df[name], as_of, df.schema[name].dataType)


def days_overdue(first_overdue: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), first_overdue)


# ISO text needs no format; these are accepted as well.
DATE_FORMATS = ("dd/MM/yyyy", "dd-MM-yyyy")

_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss")


def _to_iso(text: Column, fmt: str) -> Column:
    """Text of exactly this format rewritten as ISO text; other text stays as it is.

    Rewriting leaves one cast to do, where a parser per format would fail row by row.
    """
    order = sorted((f for f in _FIELDS if f in fmt), key=fmt.index)
    group = {f: f"${i + 1}" for i, f in enumerate(order)}
    pattern = re.escape(fmt)
    for f in order:
        pattern = pattern.replace(f, rf"(\d{{{len(f)}}})", 1)
    iso = "-".join(group[f] for f in _FIELDS[:3])
    if "HH" in group:
        iso += " " + ":".join(group.get(f, "00") for f in _FIELDS[3:])
    return F.regexp_replace(text, f"^{pattern}$", iso)


def norm_date(col: Column, dtype: T.DataType, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Date or time to a wall-clock timestamp without zone; what does not parse is NULL."""
    if not isinstance(dtype, T.StringType):
        return col.try_cast("timestamp_ntz")
    # A trailing zone is cut off, not applied: the wall-clock time is what counts.
    text = F.regexp_replace(
        F.trim(col), r"(\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*(?:Z|[+-]\d{2}:?\d{2})$", "$1"
    )
    for fmt in formats:
        text = _to_iso(text, fmt)
    return text.try_cast("timestamp_ntz")
