"""Amounts. Exact decimals inside, one cast to double at the output."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions.dates import in_month


def to_double(col: Column) -> Column:
    return col.cast("double")


def coalesce_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def cap(amount: Column, limit: Column) -> Column:
    """``amount``, or ``limit`` when it is known to be smaller. A NULL on either side keeps ``amount``."""
    return F.when(amount > limit, limit).otherwise(amount)


def pick_measure(group: Column, measures: Mapping[str, Column]) -> Column:
    """The measure that counts as size for this group, else NULL."""
    picked = F.lit(None)
    for value, measure in measures.items():
        picked = F.when(group == value, measure).otherwise(picked)
    return picked


def safe_unit_price(price: Column, size: Column) -> Column:
    """Price per size; 0 when the size is NULL, zero or negative, or the price is NULL."""
    return F.coalesce(F.try_divide(price, F.when(size > 0, size)), F.lit(0))


def fund_split(*funds: Column) -> list[Column]:
    return [coalesce_zero(f).cast("double") for f in funds]


def future_funds(amount: Column, *funds: Column) -> Column:
    """The whole amount while no fund is known (the payment is not applied yet), else 0."""
    unapplied = funds[0].isNull()
    for fund in funds[1:]:
        unapplied = unapplied & fund.isNull()
    return F.when(unapplied, amount).otherwise(F.lit(0)).cast("double")


def amount_if_month(amount: Column, day: Column, as_of: date) -> Column:
    return F.when(in_month(day, as_of), amount).otherwise(F.lit(0))


def norm_money(col: Column, dtype: T.DataType) -> Column:
    """Number rounded half-even to cents; text is first reduced to digits, dots and minus signs."""
    if isinstance(dtype, T.StringType):
        digits = F.regexp_replace(col, r"[^0-9.\-]", "")
        col = F.regexp_replace(digits, r"\.+", ".")
    # rint is half-even on the scaled double, as array libraries round.
    return F.rint(col.try_cast("double") * F.lit(100.0)) / F.lit(100.0)


def norm_int(col: Column, dtype: T.DataType | None = None) -> Column:
    """Whole number; text that is none, a fraction, a number beyond 64 bits or NULL gives 0."""
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(col.cast("bigint"), F.lit(0).cast("bigint"))
    number = col.try_cast("decimal(38,9)")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def is_rejected(col: Column) -> Column:
    """Numbers that :func:`norm_int` turns into 0: not whole, or beyond 64 bits."""
    number = col.try_cast("decimal(38,9)")
    kept = (number == F.floor(number)) & number.try_cast("bigint").isNotNull()
    return number.isNotNull() & ~kept
