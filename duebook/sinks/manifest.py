"""Reports published by a manifest: a reader always finds the old or the new report whole.

Each run writes a folder of its own and, when that is finished, appends one row to the report's manifest. The
row is one small file that appears complete or not at all, and nothing is moved, replaced or deleted. A run
that dies at any step before has changed nothing for readers. Earlier runs stay readable by their version.
"""

from __future__ import annotations

import json
import logging
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook.sinks.writer import report_path

log = logging.getLogger(__name__)

ENTRY = "version long, run string, format string, columns string, row_count long"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a report, a row for each published run; empty where none was."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def current(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The manifest row of the newest run, or of the newest run of a version; None before the first.

    Two runs that finish at the same time may both take a version; the larger run name counts, for every reader.
    """
    rows = entries(spark, path)
    if version is not None:
        rows = rows.where(F.col("version") == version)
    return rows.orderBy(F.desc("version"), F.desc("run")).first()


def publish(
    df: DataFrame,
    root: str,
    name: str,
    as_of: date,
    *,
    prefix: str = "reports",
    format: str = "parquet",
    skip_empty: bool = True,
) -> str | None:
    """Write a report to a folder of its own and name it in the manifest; the folder, or None for an empty one."""
    spark, path = df.sparkSession, report_path(root, name, as_of, prefix)
    run, seen = f"run-{uuid.uuid4().hex}", Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(f"{path}/{run}")
    rows = seen.get["row_count"]
    if rows == 0 and skip_empty:
        log.warning("report %s is empty and was not published", name)
        return None
    newest = current(spark, path)
    entry = (newest.version + 1 if newest else 1, run, format, df.schema.json(), rows)
    spark.createDataFrame([entry], ENTRY).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    log.info("report %s: version %d, %d rows, %d columns", name, entry[0], rows, len(df.columns))
    return f"{path}/{run}"


def read_report(
    spark: SparkSession, root: str, name: str, as_of: date, *, prefix: str = "reports", version: int | None = None
) -> DataFrame:
    """The report as its manifest names it, with the columns it was written with."""
    path = report_path(root, name, as_of, prefix)
    found = current(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no published report at {path}")
    reader = spark.read.format(found.format).schema(StructType.fromJson(json.loads(found.columns)))
    return (reader.option("header", True) if found.format == "csv" else reader).load(f"{path}/{found.run}")
