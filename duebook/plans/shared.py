"""Lookups that several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.context import Context
from duebook.functions.text import person_name
from duebook.operators.joins import Lookup, conform

NAME_PARTS = ("first_name", "last_name_1", "last_name_2")


def name_parts() -> list[Column]:
    return [F.col(p) for p in NAME_PARTS]


def by_id(ctx: Context, df: DataFrame, key: str, take: dict[str, str], fact_key: str | None = None) -> Lookup:
    """A lookup by an id (and by the source where ids are per system)."""
    on = {(fact_key if k == key and fact_key else k): k for k in ctx.registry.keys(key)}
    return Lookup(df, on, take)


def named(ctx: Context, entity: str, key: str, nulls: str = "empty", *cols: str) -> DataFrame:
    """An entity of people with the three name parts turned into ``name``."""
    rows = ctx.registry.read(entity, key, *NAME_PARTS, *cols)
    return rows.select(
        *ctx.registry.keys(key), person_name(*name_parts(), nulls=nulls).alias("name"), *cols
    )


def branded(ctx: Context, places: DataFrame, *attributes: str) -> DataFrame:
    """Developments or condominiums (with a ``name``) with their brand attributes.

    The text key is joined here, lookup to lookup. Joining it on the fact side would
    shuffle every fact row by a text with few values.
    """
    joined = conform(
        places,
        ctx.registry.read_dim("brand", "raw_name", *attributes),
        ("name", "raw_name"),
        {a: a for a in attributes},
        fail_on_dup=ctx.rules.fail_on_duplicate_dimension,
    )
    return ctx.registry.small(joined)
