"""Row filters. NULL follows SQL: a filter keeps a row only when the predicate is true."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def exclude_contains(col: Column, fragments: Sequence[str]) -> Column:
    """Text holding none of the fragments; NULL text is not kept either."""
    if not fragments:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [~col.contains(f) for f in fragments])


def exclude_values(col: Column, values: Sequence[str]) -> Column:
    return ~col.isin(*values) if values else F.lit(True)


def exclude_value(col: Column, value: str | None) -> Column:
    """All but one value. NULL is not kept, unless there is nothing to exclude."""
    return F.lit(True) if value is None else col != value


def exclude_pair(a: Column, x: str, b: Column, y: str) -> Column:
    return ~((a == x) & (b == y))


def starts_ci(col: Column, prefix: str) -> Column:
    """Starts with ``prefix``, whatever the case."""
    if not prefix:
        raise ValueError("an empty prefix would match every text")
    return F.lower(col).startswith(prefix.lower())
