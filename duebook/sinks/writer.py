"""Dated output folders."""

from __future__ import annotations

import logging
import tempfile
import uuid
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def report_path(root: str, name: str, as_of: date, prefix: str = "reports") -> str:
    return f"{root}/{prefix}-{as_of.isoformat()}/{name}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder for written tables, below the one the cluster shares.

    Only a local session without ``spark.checkpoint.dir`` may use a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="duebook-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def written_once(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: several uses cost one run of its plan, and what
    was decided while writing stays as it is."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Folder:
    """A path on whatever file system holds the output."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def drop(self) -> None:
        self._fs.delete(self._path, True)

    def move_to(self, other: _Folder) -> None:
        if not self._fs.rename(self._path, other._path):
            raise OSError(f"{self._path.toString()} could not be moved to {other._path.toString()}")


def _put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Move a finished folder to its place; an earlier one gives way only then, and comes back if the
    move fails."""
    new, place, earlier = _Folder(spark, staged), _Folder(spark, path), _Folder(spark, f"{staged}-earlier")
    had_one = place.exists()
    if had_one:
        place.move_to(earlier)
    try:
        new.move_to(place)
    except Exception:
        if had_one:
            earlier.move_to(place)
        raise
    if had_one:
        earlier.drop()


def write_report(
    df: DataFrame,
    root: str,
    name: str,
    as_of: date,
    *,
    prefix: str = "reports",
    format: str = "parquet",
    skip_empty: bool = True,
) -> str | None:
    """Write one report under the dated folder and log its shape; None for an empty one.

    The rows go to a folder beside the report's and are counted on the way: asking ``isEmpty``
    first would run the shuffles of the report a second time. Only a finished report with rows
    takes the place of an earlier one, so an empty or failing run leaves that as it was.
    """
    spark, path = df.sparkSession, report_path(root, name, as_of, prefix)
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("row_count"))
    writer = counted.write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    try:
        writer.save(staged)
        rows = seen.get["row_count"]
        if rows == 0 and skip_empty:
            log.warning("report %s is empty and was skipped", name)
            return None
        _put_in_place(spark, staged, path)
    finally:
        _Folder(spark, staged).drop()  # the folder of this call alone; gone already where it was moved
    log.info("report %s: %d rows, %d columns", name, rows, len(df.columns))
    return path
