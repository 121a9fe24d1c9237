"""Source registry: several systems of the same shape behind one set of entity names."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.operators.joins import broadcast_if_small
from duebook.sources.stores import Store

SOURCE = "source"

# A column whose name holds one of these is never exposed, whatever a registry says.
CREDENTIAL_MARKS = ("password", "passwd", "secret", "token", "signature")


@dataclass(frozen=True)
class Entity:
    """A table as an entity.

    ``columns`` maps each exposed name to a SQL expression over the physical table and is
    the allow-list: what is not in it cannot be read. A consolidated table that already
    holds several systems exposes its own ``source`` column.
    """

    table: str
    columns: Mapping[str, str]
    where: str | None = None

    def __post_init__(self) -> None:
        for name, expression in self.columns.items():
            lowered = f"{name} {expression}".lower()
            if any(mark in lowered for mark in CREDENTIAL_MARKS):
                raise ValueError(f"credential column {name!r} may not be exposed")


Where = str | Column | Callable[[DataFrame], Column] | None


@dataclass(frozen=True)
class System:
    name: str
    store: Store
    entities: Mapping[str, Entity]


def tag_source(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(SOURCE, F.lit(label))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of same-shaped branches, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_table(spark: SparkSession, store: Store, table: str, cols: Iterable[str]) -> DataFrame:
    return store.scan(spark, table).select(*cols)


def read_source(
    spark: SparkSession,
    system: System,
    entity: str,
    cols: Iterable[str],
    where: Where = None,
) -> DataFrame:
    """Selected columns of one system's entity; filters go below the projection, to the scan.

    A filter that depends on a column's type is a function of the system's rows.
    """
    spec = system.entities[entity]
    cols = list(cols)
    unknown = [c for c in cols if c not in spec.columns]
    if unknown:
        raise ValueError(f"{entity}: columns {unknown} are not on the allow-list")
    df = system.store.scan(spark, spec.table)
    if spec.where:
        df = df.where(spec.where)
    df = df.select(*[F.expr(spec.columns[c]).alias(c) for c in cols])
    if where is None:
        return df
    return df.where(where if isinstance(where, str | Column) else where(df))


@dataclass(frozen=True)
class Registry:
    """All systems and the dimensions they share.

    ``id_scope="system"``: ids are unique within a system, so every row carries its
    ``source`` and every key includes it. ``"global"``: ids are unique over all systems, as
    in a consolidated store, and keys stay as narrow as the id.
    """

    spark: SparkSession
    systems: Sequence[System]
    dimensions: Mapping[str, tuple[Store, Entity]]
    id_scope: str = "system"
    broadcast_bytes: int = 10 << 20
    _checked: dict[tuple[str, ...], DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.id_scope not in ("system", "global"):
            raise ValueError(f"id_scope must be 'system' or 'global', not {self.id_scope!r}")

    def keys(self, *ids: str) -> list[str]:
        return list(ids) if self.id_scope == "global" else [SOURCE, *ids]

    def read(self, entity: str, *cols: str, where: Where = None) -> DataFrame:
        """The entity over all systems that have it, tagged with the source where keys need it."""
        branches = []
        for system in self.systems:
            spec = system.entities.get(entity)
            if spec is None:
                continue
            if SOURCE in spec.columns and (SOURCE in cols or self.id_scope == "system"):
                wanted = dict.fromkeys([SOURCE, *cols])
                branches.append(read_source(self.spark, system, entity, wanted, where))
            elif SOURCE in cols or self.id_scope == "system":
                plain = [c for c in cols if c != SOURCE]
                df = tag_source(read_source(self.spark, system, entity, plain, where), system.name)
                branches.append(df.select(SOURCE, *plain))
            else:
                branches.append(read_source(self.spark, system, entity, cols, where))
        if not branches:
            raise KeyError(f"no system has the entity {entity!r}")
        return union_sources(branches)

    def read_lookup(self, entity: str, *cols: str) -> DataFrame:
        """A lookup of the systems, broadcast where its size has been checked; checked once."""
        wanted = (entity, *cols)
        if wanted not in self._checked:
            self._checked[wanted] = self.small(self.read(entity, *cols))
        return self._checked[wanted]

    def small(self, df: DataFrame) -> DataFrame:
        return broadcast_if_small(df, self.broadcast_bytes)

    def read_dim(self, name: str, *cols: str) -> DataFrame:
        """A lookup shared by all systems."""
        store, spec = self.dimensions[name]
        return read_source(self.spark, System(name, store, {name: spec}), name, cols)
