"""Joins. Only left and inner equi-joins occur."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a row and a value take at least, for the size check of a broadcast.
ROW_BYTES = 16
VALUE_BYTES = 8


def broadcast_if_small(df: DataFrame, max_bytes: int) -> DataFrame:
    """The frame with a broadcast hint if its rows are found to fit ``max_bytes``, else as it is.

    Spark's own estimate is missing for remote tables and far too high for joined lookups,
    so such a side would have the whole fact shuffled by a key of few values. The check is one
    pruned aggregate: each task adds up its own bytes and one row per task travels.
    """
    if max_bytes <= 0:
        return df
    size = F.lit(ROW_BYTES + VALUE_BYTES * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0))
    found = df.agg(F.sum(size.cast("bigint"))).first()[0]
    return F.broadcast(df) if (found or 0) <= max_bytes else df


@dataclass(frozen=True)
class Lookup:
    """A lookup table, the key pairs fact -> lookup, and the columns to take as new name -> column."""

    df: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str]


def lookup_chain(fact: DataFrame, steps: Sequence[Lookup]) -> DataFrame:
    """The fact left-joined to a chain of lookups; a later step may use a column an earlier one took.

    Each lookup is cut down to its key and the columns taken. Keys of the fact may be as
    skewed as they like: small lookups are broadcast by size, larger ones are
    sort-merged, where AQE splits an oversized partition on the fact side.
    """
    helpers = []
    for number, step in enumerate(steps):
        keys = {fact_key: f"__key_{number}_{i}" for i, fact_key in enumerate(step.on)}
        side = step.df.select(
            *[F.col(step.on[k]).alias(alias) for k, alias in keys.items()],
            *[F.col(column).alias(name) for name, column in step.take.items()],
        )
        fact = fact.join(side, [fact[k] == side[alias] for k, alias in keys.items()], "left")
        helpers += keys.values()
    return fact.drop(*helpers)


def lookup(fact: DataFrame, step: Lookup) -> DataFrame:
    """Left join of one lookup."""
    return lookup_chain(fact, [step])


def unique_by(dim: DataFrame, *keys: str) -> DataFrame:
    """The dimension, failing at run time where a key occurs twice."""
    rest = [c for c in dim.columns if c not in keys]
    grouped = dim.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__copies"), *[F.first(c).alias(c) for c in rest]
    )
    # A NULL key never joins, so NULL copies do no harm.
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    message = F.concat(
        F.lit("duplicate dimension key: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    )
    failing = F.when(known & (F.col("__copies") > 1), F.raise_error(message).cast("string"))
    # coalesce() ties the check to a key column, so that it cannot be pruned away.
    checked = [F.coalesce(failing.cast(dim.schema[k].dataType), F.col(k)).alias(k) for k in keys]
    return grouped.select(*checked, *rest).select(*dim.columns)


def conform(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    take: Mapping[str, str],
    *,
    fail_on_dup: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Attributes by a text key; NULL where unmatched, repeated rows where the key is not unique.

    ``distinct``: rows of the dimension that are equal in the key and the attributes taken join as one, for a
    report that is deduped anyway: n of them would repeat each of its rows n times until then.
    """
    if fail_on_dup:
        dim = unique_by(dim, on[1])
    elif distinct:
        dim = dim.select(*dict.fromkeys([on[1], *take.values()])).distinct()
    return lookup(df, Lookup(dim, {on[0]: on[1]}, take))


# A task takes this much without trouble, and a key cannot hold more than its table.
TASK_BYTES = 64 << 20
HEAVY_ROWS = 1_000_000

_SIZE = re.compile(r"sizeInBytes=([0-9.]+)(?:E\+?([0-9]+))? ([KMGTPE]?)i?B")


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of the frame, from file sizes and statistics; no job runs. None where it says
    nothing (Spark's default for a source it cannot measure)."""
    text = df.sparkSession.sql("explain cost select * from {frame}", frame=df).first()[0]
    found = _SIZE.search(text)
    if found is None:
        return None
    value = float(found[1]) * 10 ** int(found[2] or 0) * 1024 ** " KMGTPE".index(found[3] or " ")
    return None if value >= 7 * 1024**6 else int(value)


def heavy_keys(df: DataFrame, on: Sequence[str], over: int = HEAVY_ROWS) -> DataFrame:
    """(keys, __salts): keys with more than ``over`` rows, and over how many parts to deal them.

    Counted map-side, on the key columns alone; a table of n rows has at most n / over such keys.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > over)
    return counts.select(*on, F.ceil(F.col("__rows") / over).cast("int").alias("__salts"))


def left_join_many(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    over: int = HEAVY_ROWS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Left join whose right side may hold very many rows of one key; no dedupe. Each side is read once.

    In a left outer join only the left side of a hot partition can be split by AQE. Keys with more than
    ``over`` rows on the right, and only those, are therefore dealt over parts: their right rows to one
    part each, their left rows to every part, and a left row stays unmatched in a part only where its
    key is not heavy, as a heavy key has matches. Whatever its keys, a right side of at most
    ``task_bytes`` by the optimizer needs none of this.
    """
    on = list(on)
    size = estimated_bytes(right)
    if size is not None and size <= task_bytes:
        return left.join(right, on, "left")
    heavy = F.broadcast(heavy_keys(right, on, over))
    salts = F.coalesce("__salts", F.lit(1))
    # By a hash of the row, which a task that runs again after a lost executor repeats; a number in the
    # order of arrival would lose rows then. Rows equal in every column stay together.
    dealt = right.join(heavy, on, "left").withColumn("__part", F.pmod(F.xxhash64(*right.columns), salts))
    dealt = dealt.drop("__salts").withColumn("__met", F.lit(True))
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), salts.cast("bigint") - 1))
    spread = left.join(heavy, on, "left").withColumn("__part", parts)
    joined = spread.join(dealt, [*on, "__part"], "left")
    kept = joined.where(F.col("__met").isNotNull() | F.col("__salts").isNull())
    more = [c for c in right.columns if c not in on]
    return kept.select(*on, *[c for c in left.columns if c not in on], *more)
