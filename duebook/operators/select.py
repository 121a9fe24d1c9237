"""Projections and the final order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Explicit column list, new name -> column."""
    return df.select(*[F.col(column).alias(name) for name, column in mapping.items()])


def doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def sort_created(df: DataFrame, created: str = "created_on", ties: Sequence[str] = ()) -> DataFrame:
    """Oldest first, unknown dates before all; ids break ties, which also lets a range
    partitioner split a day that holds a large share of the rows."""
    return df.orderBy(F.col(created).asc_nulls_first(), *ties)
