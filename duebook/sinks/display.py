"""Typed columns as display text, by the category the typing stage has put on each field."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_text(col: Column, symbol: str = "$") -> Column:
    """Currency symbol, thousands separators, two decimals; the minus sign comes first."""
    digits = F.format_number(F.abs(col), 2)
    return F.concat(F.when(col < 0, "-").otherwise(""), F.lit(symbol), digits)


def display(col: Column, group: str | None, symbol: str = "$") -> Column:
    if group == "date":
        return F.date_format(col, "dd/MM/yyyy")
    if group == "money":
        return money_text(col, symbol)
    return col.cast("string")


def render(df: DataFrame, categories: Mapping[str, str] | None = None, symbol: str = "$") -> DataFrame:
    columns = []
    for f in df.schema.fields:
        group = (categories or {}).get(f.name) or f.metadata.get("category")
        columns.append(display(df[f"`{f.name}`"], group, symbol).alias(f.name))
    return df.select(*columns)
