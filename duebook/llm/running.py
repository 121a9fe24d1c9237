"""Running sums over the ordered rows of a key, without a window that holds one key in one task.

Rows are range-partitioned by key and order, so a hot key spreads over many partitions. Each
partition sums its own rows; what earlier partitions hold of the same key is added afterwards. At
most two totals of a partition (of its first and last key) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import stage


def _sums_by_partition(schema: pa.Schema, key: str, sums: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first_key = last_key = first_total = None
        carry = np.zeros(len(sums), np.uint64)
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            opens = np.concatenate([[True], keys[1:] != keys[:-1]])
            starts, run_of = np.flatnonzero(opens), np.cumsum(opens) - 1
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in sums])
            total = np.concatenate([np.zeros((len(sums), 1), np.uint64), np.cumsum(values, axis=1, dtype=np.uint64)], axis=1)
            base = total[:, starts]
            if last_key is None:
                first_key = int(keys[0])
            elif keys[0] == last_key:
                base[:, 0] -= carry
            if first_total is None and last_key is not None and keys[0] != last_key:
                first_total = carry
            if first_total is None and len(starts) > 1:
                first_total = total[:, starts[1]] - base[:, 0]
            carry, last_key = total[:, -1] - base[:, -1], int(keys[-1])
            before, upto = total[:, :-1] - base[:, run_of], total[:, 1:] - base[:, run_of]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *[pa.array(x.view(np.int64)) for x in before],
                    *[pa.array(x.view(np.int64)) for x in upto],
                    pa.array(np.full(len(batch), part, np.int32)),
                    pa.array(np.zeros(len(batch), bool)),
                ],
                names=[*batch.schema.names, *_added(sums)],
            )
        if last_key is None:
            return
        edges = [(first_key, carry)] if first_total is None else [(first_key, first_total), (last_key, carry)]
        for edge_key, edge_total in edges:
            blank = [pa.array([edge_key], f.type) if f.name == key else pa.nulls(1, f.type) for f in schema]
            sums_of = [pa.array([int(x)], pa.int64()) for x in edge_total.view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*blank, *sums_of, *sums_of, pa.array([part], pa.int32()), pa.array([True])],
                names=[*schema.names, *_added(sums)],
            )

    return run


def _added(sums: Sequence[str]) -> list[str]:
    return [*[f"{c}_before" for c in sums], *[f"{c}_upto" for c in sums], "_part", "_edge"]


def _with_offsets(offsets: dict[tuple[int, int], np.ndarray], key: str, sums: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = batch.column(key).to_numpy(zero_copy_only=False), batch.column("_part").to_numpy(zero_copy_only=False)
            more = np.zeros((len(sums), len(batch)), np.uint64)
            for part in np.unique(parts).tolist():
                for (k, p), offset in offsets.items():
                    if p == part:
                        more[:, (keys == k) & (parts == p)] = offset[:, None]
            for i, c in enumerate(sums):
                for name in (f"{c}_before", f"{c}_upto"):
                    moved = batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64) + more[i]
                    batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(moved.view(np.int64)))
            yield batch

    return run


def running_sums(rows: DataFrame, key: str, order: Sequence[str], sums: Sequence[str], name: str) -> DataFrame:
    """``rows`` (without nulls in ``key``, a long, and in ``sums``, longs) with ``<c>_before`` and
    ``<c>_upto`` for each of ``sums``: the sum modulo 2^64 over the earlier rows of the key, without and
    with the row itself. Rows equal in ``order`` come in any order."""
    spark = rows.sparkSession
    # The row number splits even a key whose rows are all equal.
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(key, *order, "_tie").sortWithinPartitions(key, *order, "_tie").drop("_tie")
    # Edge rows hold nothing but their key and sums.
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in dealt.schema])
    schema = T.StructType(loose.fields + [T.StructField(c, T.LongType()) for c in _added(sums)[:-2]])
    schema = schema.add("_part", T.IntegerType()).add("_edge", T.BooleanType())
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in loose])
    placed = stage(dealt.mapInArrow(_sums_by_partition(arrow, key, sums), schema), name)
    edges = placed.where("_edge").select(key, "_part", *[f"{c}_upto" for c in sums]).collect()
    totals: dict[int, list[tuple[int, np.ndarray]]] = {}
    for row in edges:
        totals.setdefault(row[0], []).append((row[1], np.array(row[2:], np.int64).view(np.uint64)))
    offsets = {}
    for k, parts in totals.items():
        so_far = np.zeros(len(sums), np.uint64)
        for part, total in sorted(parts, key=lambda x: x[0]):
            if so_far.any():
                offsets[k, part] = so_far
            so_far = so_far + total
    body = placed.where("not _edge")
    if offsets:
        body = body.mapInArrow(_with_offsets(offsets, key, sums), schema)
    return body.drop("_part", "_edge")


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}[kind.simpleString()]
