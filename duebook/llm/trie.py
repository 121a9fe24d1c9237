"""Prefix trie of conversations: sizes, leaves and saved text of every shared beginning.

A node is a distinct sequence of first turns, named by 128 bits of running sums of its turns'
place-dependent hashes. Depth-band rollup: depths are cut into bands of ``band`` levels, a node adds
its own figures to itself and its ancestors within its band alone, and the totals of band roots
then go on to the band above. Band roots form a tree of 1/band the depth, so they are rolled up in
the same way: a node is never exploded to more than ``band`` rows at a time, and the rounds grow
with the logarithm of the longest conversation.

Defined results: rows without conv_id belong to no conversation and are left out; a missing role or
text is empty; a missing turn comes first; rows of one turn number come in the order of a digest of
role and text, so equal rows are turns one after the other; texts are hashed whole; an empty table
has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import running_sums
from .staging import stage

KEY = ("k1", "k2")
#: Ids that one row of the digest's input holds at most.
CHUNK = 4096


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, t1, t2, chars) of each row: the only pass over the texts."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(77), text, role).alias("t2"),
        F.length(text).cast("long").alias("chars"),
    )


def turn_places(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, t1, t2, chars): turns numbered from 1 in the order of a conversation."""
    rows = turn_digests(conversations).withColumn("one", F.lit(1).cast("long"))
    placed = running_sums(rows, "conv_id", ["turn", "t1", "t2"], ["one"], "trie-places")
    return placed.select("conv_id", F.col("one_upto").alias("place"), "t1", "t2", "chars")


def spliced(places: DataFrame, base, heads) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns are those of conversation ``base`` (all if that has
    fewer, none if there is none). Both are columns over conv_id; ``base`` must be at most a few
    hundred to one. Returns the turns and the ids, those without a turn included."""
    lengths = places.groupBy("conv_id").agg(F.max("place").alias("n")).withColumns({"base": base, "heads": heads})
    lengths = stage(lengths, "trie-lengths")
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("heads", F.coalesce("base_n", F.lit(0).cast("long")))
    # Few rows of a base are needed, and each meets the conversations that start with them.
    plans = stage(lengths.join(bases, "base", "left").withColumn("taken", taken).select("conv_id", "base", "heads", "taken"), "trie-plans")
    most = plans.agg(F.max("taken")).first()[0] or 0
    lent = plans.where("taken > 0").select("conv_id", "base", "taken")
    first = places.where(F.col("place") <= most).withColumnRenamed("conv_id", "base")
    shared = first.join(lent, "base").where("place <= taken").select("conv_id", "place", "t1", "t2", "chars")
    own = places.join(plans.select("conv_id", "heads", "taken"), "conv_id").where("place > heads")
    own = own.select("conv_id", (F.col("place") - F.col("heads") + F.col("taken")).alias("place"), "t1", "t2", "chars")
    return shared.unionByName(own), plans.select("conv_id")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decimal ids of one node, comma-joined, at most ``CHUNK`` a row; rows come in order."""
    for batch in batches:
        if not len(batch):
            continue
        one, two, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in (*KEY, "conv_id"))
        change = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1
        bounds = sorted({0, len(ids), *change.tolist(), *[int(a) + s for a, b in zip([0, *change], [*change, len(ids)], strict=True) for s in range(0, int(b - a), CHUNK)]})
        starts = bounds[:-1]
        texts = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(starts, bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(one[starts]), pa.array(two[starts]), pa.array(ids[starts]), pa.array(texts, pa.binary())],
            names=[*KEY, "first_id", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the chunks of each node, streamed: one chunk is in memory at a time."""
    at, digest = None, None
    for batch in batches:
        keys, values = [], []
        for one, two, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
            if (one, two) != at:
                if at is not None:
                    keys.append(at)
                    values.append(digest.hexdigest())
                at, digest = (one, two), hashlib.sha256(ids)
            else:
                digest.update(b",")
                digest.update(ids)
        if keys:
            yield _digest_rows(keys, values)
    if at is not None:
        yield _digest_rows([at], [digest.hexdigest()])


def _digest_rows(keys: list[tuple[int, int]], values: list[str]) -> pa.RecordBatch:
    one, two = zip(*keys, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(values)], names=[*KEY, "ends_sha256"]
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    chunks = (
        ends.repartitionByRange(*KEY, "conv_id")
        .sortWithinPartitions(*KEY, "conv_id")
        .mapInArrow(_chunks, "k1 long, k2 long, first_id long, ids binary")
    )
    return (
        chunks.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first_id")
        .mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string")
    )


def _segments(rows: DataFrame, step: int, band: int) -> DataFrame:
    """(conv_id, segment, path): of every ``step``-th depth the keys of ``band`` in a row, as (place, k1, k2)."""
    place = F.expr(f"depth div {step}")
    stations = rows.where(F.col("depth") % step == 0).select("conv_id", place.alias("place"), *KEY)
    path = F.sort_array(F.collect_list(F.struct("place", *KEY)))
    return stations.groupBy("conv_id", F.expr(f"place div {band}").alias("segment")).agg(path.alias("path"))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEY).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _spread(items: DataFrame, segments: DataFrame) -> DataFrame:
    """Each item's figures at the nodes of its segment up to ``upto``."""
    met = items.join(segments, ["conv_id", "segment"])
    ancestors = F.explode(F.filter("path", lambda x: x["place"] <= F.col("upto")))
    return met.select(ancestors.alias("a"), "saved", "leaves").select("a.k1", "a.k2", "saved", "leaves")


def subtree_sums(nodes: DataFrame, rows: DataFrame, deepest: int, band: int = 8) -> DataFrame:
    """(k1, k2, saved, leaves) summed over each node's subtree.

    ``nodes``: (k1, k2, conv_id, depth, saved, leaves), own figures, conv_id any member.
    ``rows``: (conv_id, depth, k1, k2), the whole path of each member.
    """
    own, step, levels = nodes, 1, []
    while True:  # up: each level keeps every band-th depth of the level below
        segments = stage(_segments(rows, step, band), "trie-segments")
        place = F.expr(f"depth div {step}")
        items = own.select("conv_id", F.expr(f"depth div {step * band}").alias("segment"), place.alias("upto"), "saved", "leaves")
        within = stage(_summed(_spread(items, segments)), "trie-bands")
        levels.append((step, segments, within))
        step *= band
        if deepest < step:
            break
        heads = nodes.where(F.col("depth") % step == 0).select(*KEY, "conv_id", "depth")
        own = heads.join(within, [*KEY])
    done = levels[-1][2]
    for step, segments, within in reversed(levels[:-1]):  # down: completed band roots add to the band above
        above = F.expr(f"depth div {step * band} - 1")
        roots = nodes.where((F.col("depth") % (step * band) == 0) & (F.col("depth") > 0)).select(*KEY, "conv_id", "depth")
        items = roots.join(done, [*KEY]).select(
            "conv_id", above.alias("segment"), F.expr(f"depth div {step}").alias("upto"), "saved", "leaves"
        )
        done = stage(_summed(within.unionByName(_spread(items, segments))), "trie-totals")
    return done


def prefix_nodes(places: DataFrame, ids: DataFrame, band: int = 8) -> DataFrame:
    """One row for each node of the trie over ``places`` (conv_id, place from 1, t1, t2, chars), of the
    conversations ``ids`` (those without a turn are members of the root alone): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    hashed = places.select(
        "conv_id",
        "place",
        F.xxhash64(F.lit(1), "place", "t1", "t2").alias("p1"),
        F.xxhash64(F.lit(2), "t2", "t1", "place").alias("p2"),
        "chars",
    )
    summed = running_sums(hashed, "conv_id", ["place"], ["p1", "p2"], "trie-paths")
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    below = summed.select(
        "conv_id", F.col("place").alias("depth"), F.col("p1_upto").alias("k1"), F.col("p2_upto").alias("k2"),
        F.col("p1_before").alias("q1"), F.col("p2_before").alias("q2"), "chars",
    )
    tops = ids.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("q1"), none.alias("q2"), zero.alias("chars"))
    rows = below.unionByName(tops)

    grouped = stage(
        rows.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("chars").alias("chars"),
            F.max("q1").alias("q1"),
            F.max("q2").alias("q2"),
        ),
        "trie-nodes",
    )
    deepest = grouped.agg(F.max("depth")).first()[0] or 0
    children = grouped.where("q1 is not null").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    n_children = F.coalesce("n_children", zero)
    nodes = stage(
        grouped.join(children, [*KEY], "left").withColumns(
            {
                "n_children": n_children,
                "saved": (F.col("n_convs") - 1) * F.col("chars"),
                "leaves": (n_children == 0).cast("long"),
            }
        ),
        "trie-figures",
    )
    totals = subtree_sums(nodes, rows, deepest, band)

    # A conversation ends at its deepest row; a row is that if the conversation has no more turns.
    lengths = ids.join(places.groupBy("conv_id").agg(F.max("place").alias("n")), "conv_id", "left")
    lengths = lengths.select("conv_id", F.coalesce("n", zero).alias("depth"))
    ends = rows.select("conv_id", "depth", *KEY).join(lengths, ["conv_id", "depth"]).select(*KEY, "conv_id")
    digests = _end_digests(stage(ends, "trie-ends"))

    parents = grouped.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    with_parent = stage(nodes.join(parents, ["q1", "q2"], "left"), "trie-parents")
    return (
        with_parent.drop("saved", "leaves")
        .join(totals, [*KEY])
        .join(digests, [*KEY], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, band: int = 8) -> DataFrame:
    """The trie of conversations as they are."""
    places = turn_places(conversations)
    return prefix_nodes(places, places.select("conv_id").distinct(), band)
