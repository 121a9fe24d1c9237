"""Grouped operators. All of them aggregate map-side first, so a hot key costs no hot task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions.dates import clean_date
from duebook.functions.packing import can_unpack, pack, unpack_last, widths
from duebook.functions.predicates import starts_ci
from duebook.functions.text import full_name
from duebook.sinks.writer import written_once

CELL_CHARS = 1_000_000


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Equal keys, NULL equal to NULL; the right side's have the prefix."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    take: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """The row with the largest ``order`` per key, in one pass instead of a self-join by the maximum.

    The maximum runs over all of (order, columns), so the choice is fixed even where a replica holds an id
    twice: over one packed number where the columns fit it, which needs no sort, else over a struct.
    """
    if where is not None:
        df = df.where(where)
    names = [order, *take]
    room = widths(names, df.schema, exact=True)
    if room is not None:
        packed = pack(names, df.schema, room)
        return df.groupBy(*keys).agg(*[F.max_by(c, packed).alias(c) for c in names])
    latest = F.max(F.struct(order, *take)).alias("__latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "__latest.*")


def pick_by(
    column: str,
    order: Sequence[str],
    where: Column | None = None,
    schema: T.StructType | None = None,
    digits: Mapping[str, int] | None = None,
) -> Column:
    """A column of the first row by ``order``: a fixed choice where any row would do.

    With the rows' ``schema`` the order is packed into one number (``functions.packing``), which is
    aggregated without a sort; ``digits`` may state a narrower range for a column, and a value beyond its
    range raises. Without it, or where the columns cannot be packed, the minimum runs over a struct.
    """
    names = list(dict.fromkeys([*order, column]))
    # What comes after the column cannot change its value.
    names = names[: names.index(column) + 1]
    room = None if schema is None or not can_unpack(schema[column].dataType) else widths(names, schema, digits)
    if room is not None:
        packed = pack(names, schema, room)
        first = F.min(packed if where is None else F.when(where, packed))
        return unpack_last(first, schema[column].dataType, room)
    row = F.struct(*[F.col(c) for c in names])
    return F.min(row if where is None else F.when(where, row))[column]


def list_distinct(col: Column, sep: str = ", ") -> Column:
    """Distinct values, sorted and joined; NULLs skipped, NULL when nothing is left.

    A set is built per task before the shuffle, so only distinct values travel.
    """
    values = F.collect_set(col)
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


def _name_counts(df: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """(keys, __name, __times): equal names are counted map-side, so a key with very many equal rows sends
    one row per task and name."""
    people = df.select(*keys, full_name(*[F.col(p) for p in parts]).alias("__name"))
    return people.groupBy(*keys, "__name").agg(F.count(F.lit(1)).alias("__times"))


def list_names(
    df: DataFrame, keys: Sequence[str], parts: Sequence[str], name: str, cell_chars: int = CELL_CHARS
) -> DataFrame:
    """Full names per key, sorted and joined by comma; blank people are skipped.

    Equal names are counted first and written out again in the list. The lengths are added up before any
    list is made: a key whose list would be longer than ``cell_chars`` raises, it is never cut
    (``name_chunks`` gives such lists in parts).
    """
    counted = _name_counts(df, keys, parts)
    length = F.sum((F.length("__name") + 2) * F.col("__times")) - 2
    large = counted.groupBy(*keys).agg(length.alias("__length")).where(F.col("__length") > cell_chars)
    large = large.select(*[F.col(k).alias(f"__large_{k}") for k in keys], "__length")
    checked = counted.join(large, _same(keys, "__large_"), "left")
    told = F.concat(F.lit(f"a list of {name} has more than {cell_chars} characters: "), F.to_json(F.struct(*keys)))
    # The test stands below the lists: a key beyond the size fails before its names meet.
    checked = checked.where(F.col("__length").isNull() | F.raise_error(told).cast("boolean"))
    listed = checked.select(
        *keys,
        "__name",
        F.array_join(F.array_repeat("__name", F.col("__times").cast("int")), ", ").alias("__copies"),
    )
    entries = F.array_sort(F.collect_list(F.when(F.col("__name").isNotNull(), F.struct("__name", "__copies"))))
    text = F.array_join(entries["__copies"], ", ")
    return listed.groupBy(*keys).agg(F.when(F.size(entries) > 0, text).alias(name))


def name_chunks(df: DataFrame, keys: Sequence[str], parts: Sequence[str], size: int = 10_000) -> DataFrame:
    """(keys, chunk, names, counts): the distinct full names per key in order, ``size`` to a chunk, chunks
    numbered from 0; blank people are skipped, and a key without names has no chunk.

    One key may have any number of names. The counted names are split into ranges of (keys, name) and written,
    which fixes the ranges; each range is numbered by itself, and a running sum over one row for each key and
    range gives the number of the range's first name. No task and no cell holds all names of a key.
    """
    counted = _name_counts(df, keys, parts).where("__name is not null")
    ranges = counted.repartitionByRange(*keys, "__name")
    ranged = written_once(ranges.withColumn("__range", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        ranged.groupBy(*keys, "__range")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .select(*[F.col(c).alias(f"__at_{c}") for c in [*keys, "__range"]], "__first")
    )
    own = Window.partitionBy(*keys, "__range").orderBy("__name")
    numbered = ranged.withColumn("__place", F.row_number().over(own) - 1).join(
        firsts, _same([*keys, "__range"], "__at_")
    )
    chunk = F.floor((F.col("__first") + F.col("__place")) / size).alias("chunk")
    entries = F.array_sort(F.collect_list(F.struct("__name", "__times")))
    chunks = numbered.groupBy(*keys, chunk).agg(entries.alias("__entries"))
    return chunks.select(
        *keys, "chunk", F.col("__entries.__name").alias("names"), F.col("__entries.__times").alias("counts")
    )


def milestone(
    history: DataFrame, keys: Sequence[str], status: str, moved_at: str, prefix: str, name: str
) -> DataFrame:
    """First date a status with the prefix was reached; NULL when it never was."""
    reached = F.when(starts_ci(F.col(status), prefix), clean_date(F.col(moved_at)))
    return history.groupBy(*keys).agg(F.min(reached).alias(name))


def latest_date(df: DataFrame, keys: Sequence[str], day: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(clean_date(F.col(day))).alias(name))


def dedupe(df: DataFrame) -> DataFrame:
    return df.distinct()


def max_per_key(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """The distinct (key, maximum over the key) rows: a grouping rather than a window and a distinct."""
    return df.groupBy(*keys).agg(F.max(column).alias(name))


def having(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], test: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()]).where(test)
