"""Typing of report columns by their names, as one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions.dates import norm_date
from duebook.functions.money import is_rejected, norm_int, norm_money
from duebook.functions.text import trim_text

Keywords = Mapping[str, Sequence[str]]

CATEGORIES = ("date", "money", "integer", "text")

# Keywords for this package's own report columns. A caller with other names brings other words.
REPORT_KEYWORDS: Keywords = {
    "date": ("_on", "_date", "_at"),
    "money": ("amount", "balance", "price", "total", "collected", "receivable", "surcharge", "funds"),
    "integer": ("_id", "days_", "_day", "_number", "_months"),
    "text": ("client", "name", "phone", "email", "reference", "unit", "status", "bank", "concept", "folio"),
}


def category(name: str, keywords: Keywords, overrides: Mapping[str, str] | None = None) -> str | None:
    """First category, in fixed order, with a keyword inside the name (case matters)."""
    if overrides and name in overrides:
        return overrides[name]
    stripped = name.strip()
    for group in CATEGORIES:
        if any(word in stripped for word in keywords.get(group, ())):
            return group
    return None


def norm_text(col: Column) -> Column:
    return F.coalesce(trim_text(col.cast("string")), F.lit(""))


def typed(col: Column, dtype: T.DataType, group: str | None) -> Column:
    if group == "date":
        return norm_date(col, dtype)
    if group == "money":
        return norm_money(col, dtype)
    if group == "integer":
        return norm_int(col, dtype)
    if group == "text":
        return norm_text(col)
    return col


def normalise(
    df: DataFrame, keywords: Keywords = REPORT_KEYWORDS, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Every column typed by its name in one ``select``; the category is kept as field metadata.

    ``overrides`` names the category of a column outright, e.g. account numbers as text.
    """
    columns = []
    for f in df.schema.fields:
        group = category(f.name, keywords, overrides)
        typed_col = typed(df[f"`{f.name}`"], f.dataType, group)
        columns.append(typed_col.alias(f.name, metadata={"category": group} if group else {}))
    return df.select(*columns)


def partial_matches(names: Sequence[str], keywords: Keywords) -> dict[str, str]:
    """Columns caught by a keyword that is only part of a word of the name, for a warning."""
    caught = {}
    for name in names:
        group = category(name, keywords)
        if group is None:
            continue
        word = next(w for w in keywords[group] if w in name.strip())
        if word.strip("_") not in name.split("_"):
            caught[name] = word
    return caught


def integer_rejects(
    df: DataFrame, keywords: Keywords = REPORT_KEYWORDS, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """Count of numbers per integer column that :func:`normalise` has to turn into 0."""
    names = [c for c in df.columns if category(c, keywords, overrides) == "integer"]
    counts = [F.count_if(is_rejected(df[f"`{c}`"])).alias(c) for c in names]
    return df.agg(*counts)
