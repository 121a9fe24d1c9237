"""Written tables between the steps of an operator, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a local session gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="duebook-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage is cut, and a lost executor costs no recomputation."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_few(written: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A written table of narrow rows (under 100 bytes), with a broadcast hint if it is counted to have at most
    ``rows``: below that one plan at every size, beyond it a join that shuffles both sides."""
    return F.broadcast(written) if written.count() <= rows else written


def crc_fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as the empty string."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def class_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): one label for each id; of contradicting rows the larger counts, missing ones are dropped."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("y"))
    )


def split_blocks(rows: DataFrame, key: str, n_blocks: str, identity: str) -> DataFrame:
    """Deal the rows of each ``key`` to pairs of hashed blocks, so that every pair of rows meets in one task.

    ``n_blocks`` is the number of blocks of the row's key. Added columns: ``left_block``,
    ``right_block`` (the task, left <= right) and ``own_block`` (the row's). A row is repeated once
    for each block of its key; keys of one block are not repeated.
    """
    own = F.pmod(F.xxhash64(F.lit(7), F.col(identity)), F.col(n_blocks)).cast("int")
    dealt = rows.withColumn("own_block", own).withColumn(
        "other_block", F.explode(F.sequence(F.lit(0), F.col(n_blocks).cast("int") - 1))
    )
    return dealt.select(
        *[c for c in dealt.columns if c != "other_block"],
        F.least("own_block", "other_block").alias("left_block"),
        F.greatest("own_block", "other_block").alias("right_block"),
    )
