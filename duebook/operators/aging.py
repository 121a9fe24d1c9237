"""Overdue and next-due figures of instalments: one grouped pass per sale."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.operators.grouping import pick_by


def _open(balance: str) -> Column:
    return F.col(balance) != 0


def late(as_of: date, due: str = "due_on", balance: str = "balance") -> Column:
    return _open(balance) & (F.col(due) < F.lit(as_of))


def ahead(as_of: date, due: str = "due_on", balance: str = "balance") -> Column:
    return _open(balance) & (F.col(due) >= F.lit(as_of))


def next_due_balance(as_of: date, schema: T.StructType | None = None) -> Column:
    """Balance of the earliest unpaid instalment due on or after ``as_of``; ties by number, then balance.

    With the ``schema`` of the instalments the three are one packed number, which needs no sort.
    """
    return pick_by("balance", ["due_on", "number", "balance"], ahead(as_of), schema)


def overdue_balance(as_of: date) -> Column:
    return F.sum(F.when(late(as_of), F.col("balance")).otherwise(F.lit(0)))


def first_overdue_on(as_of: date) -> Column:
    return F.min(F.when(late(as_of), F.col("due_on")))


def required_total(as_of: date, schema: T.StructType | None = None) -> Column:
    return overdue_balance(as_of) + F.coalesce(next_due_balance(as_of, schema), F.lit(0))


def overdue_billed(as_of: date) -> Column:
    return F.sum(F.when(late(as_of), F.col("billed")).otherwise(F.lit(0)))


def next_due_on(as_of: date) -> Column:
    return F.min(F.when(ahead(as_of), F.col("due_on")))


def next_due_number(as_of: date) -> Column:
    return F.min(F.when(ahead(as_of), F.col("number")))


def due_day(kind: str | None = None) -> Column:
    """Largest day of the month, among the instalments of one kind if given."""
    day = F.dayofmonth("due_on")
    return F.max(day if kind is None else F.when(F.col("kind") == kind, day))


def instalment_amount(kind: str, schema: T.StructType | None = None) -> Column:
    """Billed amount of the first instalment of the kind (any of them would do)."""
    return pick_by("billed", ["due_on", "number", "billed"], F.col("kind") == kind, schema)


def aging(instalments: DataFrame, as_of: date, keys: Sequence[str], kind: str) -> DataFrame:
    """All instalment figures of a statement in one grouping: one scan, one shuffle."""
    schema = instalments.schema
    return instalments.groupBy(*keys).agg(
        first_overdue_on(as_of).alias("first_overdue_on"),
        overdue_balance(as_of).alias("overdue_balance"),
        required_total(as_of, schema).alias("required_total"),
        overdue_billed(as_of).alias("overdue_billed"),
        next_due_on(as_of).alias("next_due_on"),
        next_due_number(as_of).alias("next_due_number"),
        due_day(kind).alias("due_day"),
        instalment_amount(kind, schema).alias("instalment_amount"),
    )
