"""Physical stores. Each one only turns a table name into a lazy ``DataFrame``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Store(Protocol):
    def scan(self, spark: SparkSession, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class FileStore:
    """One folder or file per table, Parquet unless told otherwise.

    ``schemas`` pins a table's columns, which saves reading a footer for each scan. A table
    is opened once per store: its files are listed once, however many entities use it.
    """

    root: str
    suffix: str = ".parquet"
    format: str = "parquet"
    schemas: Mapping[str, str] = field(default_factory=dict)
    _opened: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        if table not in self._opened:
            reader = spark.read.format(self.format)
            if table in self.schemas:
                reader = reader.schema(self.schemas[table])
            self._opened[table] = reader.load(f"{self.root}/{table}{self.suffix}")
        return self._opened[table]


@dataclass(frozen=True)
class CatalogStore:
    """Tables of a catalog database."""

    database: str

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{self.database}.{table}")


@dataclass(frozen=True)
class Split:
    """How a large table is read in parallel. The bounds shape the ranges; rows outside are still read."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class JdbcStore:
    """Tables of an operational database.

    A table is scanned as such, so that Spark pushes the selected columns and the filters
    into the query it sends. Without a ``Split`` a table is read by one task: give one for
    every table that grows.
    """

    url: str
    driver: str
    properties: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str) -> dict[str, str]:
        options = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": table,
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
            **self.properties,
        }
        split = self.splits.get(table)
        if split is not None:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return options

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(table)).load()
