"""Session settings the plans rely on, all of them ordinary Spark SQL options."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Hot keys are split at run time by AQE. forceOptimizeSkewedJoin keeps that split even
# where a grouping on the same key follows the join (it then costs one more exchange,
# and only when a partition really is skewed).
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

SHUFFLE_PARTS = "spark.sql.shuffle.partitions"


def shuffle_partitions(shuffled_bytes: int, target_bytes: int = 128 << 20, floor: int = 8) -> int:
    """Partitions for an expected shuffle volume; AQE merges the ones that turn out small."""
    return max(floor, -(-shuffled_bytes // target_bytes))


@contextmanager
def shuffling_in(spark: SparkSession, parts: int) -> Iterator[None]:
    """Jobs started inside shuffle in ``parts`` parts, or in the session's number where that is larger."""
    before = spark.conf.get(SHUFFLE_PARTS)
    spark.conf.set(SHUFFLE_PARTS, str(max(parts, int(before))))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTS, before)


def apply_runtime_options(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DUEBOOK_DRIVER_MEMORY", "8g"))
        .config(SHUFFLE_PARTS, str(partitions))
        # Call sites are recorded for every expression otherwise, which slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
