"""Entities of all systems written once, bucketed and sorted by (source, id).

Every grouping and join by that key then starts from rows that lie together already: the shuffle is paid
once, when the tables are written, and not by each report. All entities take the same number of buckets, so
they fit each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.operators.joins import HEAVY_ROWS, heavy_keys
from duebook.session import shuffling_in
from duebook.sinks.writer import shared_folder
from duebook.sources.registry import Entity, Registry, System


@dataclass(frozen=True)
class WrittenStore:
    """Tables written by :func:`bucketed`: through the catalog, which knows the buckets, or as plain files."""

    names: Mapping[str, str]
    files: Mapping[str, tuple[str, StructType]]

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        if table in self.names:
            return spark.table(self.names[table])
        path, schema = self.files[table]
        return spark.read.schema(schema).parquet(path)


def bucketed(
    registry: Registry,
    keys: Mapping[str, str],
    buckets: int,
    *,
    database: str = "default",
    over: int = HEAVY_ROWS,
) -> Registry:
    """The registry with the entities of ``keys`` (entity -> its id column) read from bucketed tables.

    A bucket is read by one task, so an entity with a key of more than ``over`` rows is read as plain files,
    whose groupings combine before they shuffle as ever. The keys are counted on the written table, where
    that needs no shuffle. While writing, oversized buckets are split between tasks, and the joins that
    make an entity shuffle in as many parts as there are buckets, whatever the session has. Reads through the new
    registry give the rows of the old one; take as many buckets as a report has shuffle partitions, and more as
    the entities grow (``duebook.session.shuffle_partitions``), or the share of one task grows with them.
    The tables are external, named by a run of their own and stay until their owner drops them.
    """
    spark, run = registry.spark, uuid.uuid4().hex
    root = shared_folder(spark)
    names, files, entities = {}, {}, {}
    for entity, id_column in keys.items():
        specs = [s.entities[entity] for s in registry.systems if entity in s.entities]
        shared = [c for c in specs[0].columns if all(c in s.columns for s in specs)]
        rows = registry.read(entity, *shared)
        by = registry.keys(id_column)
        name, path = f"{database}.{entity}_{run}", f"{root}/{entity}"
        writer = rows.hint("rebalance", buckets, *[F.col(k) for k in by]).write.format("parquet")
        with shuffling_in(spark, buckets):
            writer.bucketBy(buckets, *by).sortBy(*by).option("path", path).saveAsTable(name)
        if heavy_keys(spark.table(name), by, over).isEmpty():
            names[entity] = name
        else:
            files[entity] = (path, rows.schema)
        entities[entity] = Entity(entity, {c: f"`{c}`" for c in rows.columns})
    rest = [replace(s, entities={n: e for n, e in s.entities.items() if n not in keys}) for s in registry.systems]
    written = System("written", WrittenStore(names, files), entities)
    return replace(registry, systems=[*rest, written], _checked={})
