"""Jaccard join of documents on word n-grams by grouped prefixes.

The n-grams of a set are put into one global order, rare ones first. Two sets with the similarity
asked for share one of the first n - ceil(t n) + 1 n-grams of either, its prefix. Documents with
equal prefixes and sizes are collapsed into one group. An inverted list of prefix n-grams brings
groups together. Pairs of groups that meet in short lists are counted and filtered by their sizes and by
what that number leaves possible; a long list is chained in the order of sizes, where these allow a
link, so that it gives as many edges as it has members. Within the connected groups, all group pairs
are filtered by their sizes and their whole prefixes, and the pairs that remain are expanded to their
members and verified on whole sets, unless these are already connected.

The order is by counts over the whole corpus: those of more rows than a short list has enter a table that
grows with their number, up to a bound; where two meet in a place the larger count holds, and the rest count
as rare. Any order finds every link; rare first keeps common passages out of prefixes.

Defined results: a null or empty text has an empty set and is linked with nothing; documents with equal
sets are one class from the start; rows of one id with different texts are judged by their own
sets, and a class is never named by an id; rows without an id take part in linking and get the
smallest id of their component or null; texts of any length are used whole; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .near_dedup import Forest, _complete_groups, _edges, _group_runs, _linked, _stars, set_digests
from .staging import split_blocks, stage
from .words import SPACE, mix, shingle_sets, slices, text_bytes, word_hashes


@dataclass(frozen=True)
class PrefixJoin:
    """``percent``: sets are linked if 100 * intersection >= percent * union.

    A task verifies at most two blocks of ``block_grams`` n-grams and ``block_members`` sets (a
    longer set stands alone) of a connected part. The table of common n-grams has 2^``counter_bits``
    places, or more, up to 2^``most_counter_bits``; they are counted in 2^``chunk_bits`` chunks, from
    sorted runs of ``run_grams``.
    """

    percent: int = 85
    size: int = 4
    counter_bits: int = 22
    most_counter_bits: int = 26
    chunk_bits: int = 10
    run_grams: int = 4_000_000
    short_list: int = 8
    held_pairs: int = 250_000
    block_grams: int = 1_000_000
    block_members: int = 2048

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (self.percent * n + 99) // 100 + 1

    def least_common(self, a: int, b: np.ndarray) -> np.ndarray:
        """The smallest intersection of linked sets of ``a`` and ``b`` n-grams."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def _sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column("text"))
    hashes, pointers, _, _ = word_hashes(data, offsets, SPACE)
    return shingle_sets(hashes, pointers, size)


def _counter(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def _packed(numbers: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as steps: their low bytes plainly, the high ones, mostly zeros, compressed."""
    steps = np.diff(numbers, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return steps[:2].tobytes() + zlib.compress(steps[2:].tobytes(), 1)


def _unpacked(packed: bytes, length: int) -> np.ndarray:
    low, high = np.frombuffer(packed, np.uint8, 2 * length), zlib.decompress(memoryview(packed)[2 * length :])
    steps = np.concatenate([low, np.frombuffer(high, np.uint8)]).reshape(4, length)
    return np.cumsum(np.ascontiguousarray(steps.T).view("<u4")[:, 0], dtype=np.uint32)


def _places(p: PrefixJoin):
    """A task's n-grams, once for each row that has them, as runs of sorted places in packed chunks."""
    cuts = np.arange(1, 1 << p.chunk_bits, dtype=np.uint64) << np.uint64(64 - p.chunk_bits)

    def chunks(held: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.sort(np.concatenate(held))
        at = [0, *np.searchsorted(grams, cuts).tolist(), len(grams)]
        places = (grams >> np.uint64(32 - p.chunk_bits)).astype(np.uint32)  # 32 bits beyond those of the chunk
        filled = [k for k in range(len(at) - 1) if at[k + 1] > at[k]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(filled, pa.int64()),
                pa.array([at[k + 1] - at[k] for k in filled], pa.int64()),
                pa.array([_packed(places[at[k] : at[k + 1]]) for k in filled], pa.binary()),
            ],
            ["chunk", "length", "places"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in slices(batches, "text"):
            grams = _sets(batch, p.size)[0]
            held.append(grams)
            total += len(grams)
            if total >= p.run_grams:
                yield chunks(held)
                held, total = [], 0
        if total:
            yield chunks(held)

    return run


def _common(p: PrefixJoin):
    """The places of each chunk with more rows than a short list has, with one byte for the number: four steps
    for each doubling."""

    def found(chunk: int, runs: list[np.ndarray]) -> pa.RecordBatch:
        places = np.sort(np.concatenate(runs))
        starts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        counts = np.diff(np.r_[starts, len(places)])
        often = counts > p.short_list
        level = np.minimum(255, np.rint(4 * np.log2(counts[often]))).astype(np.uint8)
        rows = [pa.array([chunk]), pa.array([len(level)])]
        packed = [places[starts[often]].astype("<u4").tobytes(), level.tobytes()]
        return pa.RecordBatch.from_arrays([*rows, *[pa.array([x], pa.binary()) for x in packed]], ["chunk", "length", "places", "levels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, runs = None, []
        for batch in batches:
            for chunk, length, packed in zip(*[batch.column(c).to_pylist() for c in ("chunk", "length", "places")], strict=True):
                if chunk != at and runs:
                    yield found(at, runs)
                    runs = []
                at = chunk
                runs.append(_unpacked(packed, length))
        if runs:
            yield found(at, runs)

    return run


def _level_parts(p: PrefixJoin, bits: int):
    """From the common places, each chunk's part of the table of ``bits``: the largest level of a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, places, levels in zip(*[batch.column(c).to_pylist() for c in ("chunk", "places", "levels")], strict=True):
                inner = max(0, bits - p.chunk_bits)
                part = np.zeros(1 << inner, np.uint8)
                at = np.frombuffer(places, "<u4").astype(np.uint64) >> np.uint64(32 - inner)
                np.maximum.at(part, at.astype(np.int64), np.frombuffer(levels, np.uint8))
                start = (chunk << inner) >> max(0, p.chunk_bits - bits)
                packed = zlib.compress(part.tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([start]), pa.array([packed], pa.binary())], ["start", "levels"])

    return run


def gram_levels(texts: DataFrame, p: PrefixJoin) -> np.ndarray:
    """How common the n-grams of each hashed place are, one byte a place, over all texts.

    All n-grams are counted, in 2^(32 + chunk_bits) places that never meet in one task. Only those with more rows
    than a short list enter the table, which grows with their number, so that most rare ones keep 0.
    """
    runs = texts.mapInArrow(_places(p), "chunk long, length long, places binary")
    dealt = runs.repartition("chunk").sortWithinPartitions("chunk")
    common = stage(dealt.mapInArrow(_common(p), "chunk long, length long, places binary, levels binary"), "prefix-common")
    common = common.where("length > 0")
    total = common.agg(F.sum("length")).first()[0] or 0
    bits = min(max(p.counter_bits, int(4 * total).bit_length()), max(p.counter_bits, p.most_counter_bits))
    levels = np.zeros(1 << bits, np.uint8)
    for row in common.mapInArrow(_level_parts(p, bits), "start long, levels binary").collect():
        part = np.frombuffer(zlib.decompress(row["levels"]), np.uint8)
        own = levels[row["start"] : row["start"] + len(part)]
        np.maximum(own, part, out=own)
    return levels


def ordered(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """N-grams as numbers in the global order: the level of the place first, then a hash."""
    bits = len(levels).bit_length() - 1
    return (levels[_counter(grams, bits)].astype(np.uint64) << np.uint64(56)) | (mix(grams, 5) >> np.uint64(8))


def _prefixes(p: PrefixJoin, levels: np.ndarray):
    """Size, digest, group and prefix of each set; of a group's rows in a task only the first has the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            sets, pointers = _sets(batch, p.size)
            d1, d2 = set_digests(sets, pointers)
            n = np.diff(pointers)
            order = ordered(sets, levels)
            lengths = p.prefix(n) * (n > 0)
            parts = [
                np.sort(order[a:b])[:m] for a, b, m in zip(pointers[:-1].tolist(), pointers[1:].tolist(), lengths.tolist(), strict=True)
            ]
            cuts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = (np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64)
            # A group is named by its prefix and size.
            group, _ = set_digests(flat.view(np.uint64), cuts.astype(np.int64))
            group = mix(group.view(np.uint64) + n.astype(np.uint64), 6).view(np.int64)
            prefixes = pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))
            shown = []
            for row, (key, filled) in enumerate(zip(group.tolist(), (n > 0).tolist(), strict=True)):
                shown.append(row if filled and key not in seen else None)
                seen.add(key)
            columns = [batch.column("doc_id"), pa.array(n), pa.array(d1), pa.array(d2), pa.array(group)]
            yield pa.RecordBatch.from_arrays(
                [*columns, prefixes.take(pa.array(shown, pa.int64()))], ["doc_id", "n", "d1", "d2", "group", "prefix"]
            )

    return run


LIST_SCHEMA = "a long, b long, na long, nb long, common long, gram long, part long"
LIST_COLUMNS = ["a", "b", "na", "nb", "common", "gram", "part"]


def _list_rows(rows: list[np.ndarray | None], length: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(length, pa.int64()) if r is None else pa.array(r) for r in rows], LIST_COLUMNS)


def _merged_pairs(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (a, b, na, nb, common) with the last one summed over equal pairs."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    opens = np.ones(len(rows), bool)
    opens[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    starts = np.flatnonzero(opens)
    merged = rows[starts]
    if len(starts):
        merged[:, 4] = np.add.reduceat(rows[:, 4], starts)
    return merged


def _list_pairs(p: PrefixJoin):
    """What the inverted lists, sorted by size, connect.

    Of a short list all pairs of groups, counted over the task's lists. Of a long list, and of a task's
    first and last, which may go on elsewhere, the neighbours, without a count, where sizes allow a link
    (if two neighbours are too far apart in size, so is everything before from everything after).
    Besides, the task's first and last entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, pending, first, last = TaskContext.get().partitionId(), [], None, None, None

        def work(table: pa.Table, opening: bool, closing: bool) -> np.ndarray:
            gram, n, group = (table.column(c).to_numpy() for c in ("gram", "n", "group"))
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (group[1:] != group[:-1])
            gram, n, group = gram[new], n[new], group[new]
            _, list_of, length = np.unique(gram, return_inverse=True, return_counts=True)
            chained = length[list_of] > p.short_list
            chained |= (opening & (gram == gram[0])) | (closing & (gram == gram[-1]))
            near = (gram[1:] == gram[:-1]) & chained[1:] & (100 * n[:-1] >= p.percent * n[1:])
            edges = np.unique(np.stack([group[1:][near], group[:-1][near]], axis=1), axis=0)
            pairs = []
            for away in range(1, p.short_list):
                x, y = slice(None, -away), slice(away, None)
                met = (gram[y] == gram[x]) & ~chained[y] & (100 * n[x] >= p.percent * n[y])
                if met.any():
                    found = np.stack([group[x][met], group[y][met], n[x][met], n[y][met], np.ones(met.sum(), np.int64)], axis=1)
                    turn = found[:, 0] > found[:, 1]
                    found[turn] = found[turn][:, [1, 0, 3, 2, 4]]
                    pairs.append(found)
            if pairs:
                held.append(_merged_pairs(pairs))
            return edges

        for table in _complete_groups(batches, ["gram"]):
            if pending is not None:
                edges = work(pending[0], pending[1], False)
                if len(edges):
                    yield _list_rows([edges[:, 0], edges[:, 1], *[None] * 5], len(edges))
                if sum(map(len, held)) > p.held_pairs:
                    merged = _merged_pairs(held)
                    held.clear()
                    if len(merged) > p.held_pairs // 2:
                        yield _list_rows([*merged.T, None, None], len(merged))
                    else:
                        held.append(merged)
            ends = [tuple(int(table.column(c)[at].as_py()) for c in ("group", "n", "gram")) for at in (0, len(table) - 1)]
            first, last = first or ends[0], ends[1]
            pending = (table, pending is None)
        if pending is None:
            return
        edges = work(pending[0], pending[1], True)
        if len(edges):
            yield _list_rows([edges[:, 0], edges[:, 1], *[None] * 5], len(edges))
        if held:
            merged = _merged_pairs(held)
            yield _list_rows([*merged.T, None, None], len(merged))
        (b1, n1, g1), (b2, n2, g2) = first, last
        yield _list_rows([None, np.array([b1, b2]), None, np.array([n1, n2]), None, np.array([g1, g2]), np.array([part, part])], 2)

    return run


def _proposed(groups: DataFrame, p: PrefixJoin) -> DataFrame:
    """(a, b): edges that connect all groups between whose members a link is possible.

    Groups that meet in short lists alone share exactly the n-grams counted there, so that sizes and
    this number decide. Groups that meet in a long list are connected without a test.
    """
    lists = groups.select("group", "n", F.explode("prefix").alias("gram"))
    # By range, so that the list of a common n-gram may fill many partitions.
    dealt = lists.repartitionByRange("gram", "n", "group").sortWithinPartitions("gram", "n", "group")
    found = stage(dealt.mapInArrow(_list_pairs(p), LIST_SCHEMA), "prefix-lists")
    pairs = found.where("common is not null").groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    # beyond its prefix a set has ceil(t n) - 1 n-grams
    rest = [F.expr(f"({p.percent} * {n} + 99) div 100 - 1") for n in ("na", "nb")]
    least = F.expr(f"({p.percent} * (na + nb) + {99 + p.percent}) div {100 + p.percent}")
    edges = pairs.where(F.col("common") + F.greatest(*rest) >= least).select("a", "b")
    edges = edges.unionByName(found.where("common is null and a is not null").select("a", "b"))
    # Two rows for each task: its neighbours in the tasks before and after it.
    ends = sorted(found.where("a is null").collect(), key=lambda r: (r["part"], r["gram"], r["nb"], r["b"]))
    across = [
        (x["b"], y["b"])
        for x, y in zip(ends, ends[1:], strict=False)
        if x["part"] != y["part"] and x["gram"] == y["gram"] and x["b"] != y["b"] and 100 * x["nb"] >= p.percent * y["nb"]
    ]
    if across:
        edges = edges.unionByName(groups.sparkSession.createDataFrame(across, "a long, b long"))
    return edges


def _full_sets(p: PrefixJoin):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            sets, pointers = _sets(batch, p.size)
            d1, d2 = set_digests(sets, pointers)
            new = []
            for row, key in enumerate(d1.tolist()):
                if key not in seen:
                    seen.add(key)
                    new.append(row)
            payload = [sets[pointers[r] : pointers[r + 1]].tobytes() for r in new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1[new]), pa.array(d2[new]), pa.array(payload, pa.binary())], ["d1", "d2", "grams"]
            )

    return run


PART_KEYS = ["root", "left_block", "right_block"]


def _verify(p: PrefixJoin, levels: np.ndarray, sets: list, group: np.ndarray, left: np.ndarray, right: np.ndarray) -> Forest:
    """The forest of true links between the members of two blocks (row numbers; equal arrays: one block)."""
    forest = Forest(len(sets))
    sizes = np.array([len(s) for s in sets], np.int64)
    lengths = p.prefix(sizes)
    _, first, local = np.unique(group, return_index=True, return_inverse=True)
    prefixes = [np.sort(ordered(sets[r], levels))[: lengths[r]] for r in first.tolist()]
    n, width = sizes[first], lengths[first]
    last = np.array([x[-1] for x in prefixes], np.uint64)
    sides = [np.zeros(len(first), bool) for _ in range(2)]
    members: list[dict[int, list[int]]] = [{}, {}]
    for side, rows in enumerate((left, right)):
        for row in rows.tolist():
            members[side].setdefault(int(local[row]), []).append(row)
        sides[side][list(members[side])] = True
    # the inverted lists of the right side's groups
    indexed = np.flatnonzero(sides[1])
    grams = np.concatenate([prefixes[g] for g in indexed.tolist()])
    owners = np.repeat(indexed, width[indexed])
    order = np.argsort(grams, kind="stable")
    grams, owners = grams[order], owners[order]
    one_block = left is right

    def compare(a: int, others: list[int]) -> None:
        for at in range(0, len(others), 64):
            strip = [b for b in others[at : at + 64] if forest.root(b) != forest.root(a)]
            if strip:
                for b, hit in zip(strip, _linked(sets[a], [sets[b] for b in strip], p.percent), strict=True):
                    if hit:
                        forest.join(a, b)

    for g in np.flatnonzero(sides[0]).tolist():
        low, high = np.searchsorted(grams, prefixes[g], "left"), np.searchsorted(grams, prefixes[g], "right")
        met = np.concatenate([owners[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)])
        common = np.bincount(met, minlength=len(first))
        h = np.flatnonzero(common)
        if one_block:
            h = h[h >= g]
        # N-grams of the side whose prefix ends first that the other prefix lacks are not in that set at all.
        short_g = last[g] <= last[h]
        most = common[h] + np.where(short_g, n[g] - width[g], n[h] - width[h])
        possible = (100 * np.minimum(n[g], n[h]) >= p.percent * np.maximum(n[g], n[h])) & (most >= p.least_common(int(n[g]), n[h]))
        for other in h[possible].tolist():
            for a in members[0][g]:
                rest = [b for b in members[1].get(other, ()) if (b > a or not one_block or other != g) and forest.root(b) != forest.root(a)]
                compare(a, rest)
    return forest


def _links(p: PrefixJoin, levels: np.ndarray):
    """From each connected part (pair of blocks), a spanning forest of the pairs linked on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete_groups(batches, PART_KEYS):
            nodes, own, group = (table.column(c).to_numpy() for c in ("node", "own_block", "group"))
            lefts, rights = table.column("left_block").to_numpy(), table.column("right_block").to_numpy()
            data, offsets = text_bytes(table.column("grams").combine_chunks().cast(pa.large_binary()))
            out_a, out_b = [], []
            for low, high in _group_runs(table, PART_KEYS):
                left = np.flatnonzero(own[low:high] == lefts[low])
                right = left if lefts[low] == rights[low] else np.flatnonzero(own[low:high] == rights[low])
                if high - low < 2 or not len(left) or not len(right):
                    continue
                sets = [np.frombuffer(data[offsets[r] : offsets[r + 1]].tobytes(), np.uint64) for r in range(low, high)]
                forest = _verify(p, levels, sets, group[low:high], left, right)
                for out, part in zip((out_a, out_b), _stars(forest, nodes[low:high]), strict=True):
                    out.extend(part)
            if out_a:
                yield _edges(out_a, out_b)

    return run


def prefix_join(documents: DataFrame, p: PrefixJoin = PrefixJoin()) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, class (a digest of the set), group_size
    (distinct sets of the row's prefix group, 0 for an empty set)."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels = gram_levels(texts.select("text"), p)
    rows = stage(
        texts.mapInArrow(_prefixes(p, levels), "doc_id long, n long, d1 long, d2 long, group long, prefix array<long>"),
        "prefix-rows",
    )
    # Equal sets are one class; the number is fixed by writing it. Equal prefixes and sizes are one group.
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least_id"), F.max("n").alias("n"), F.max("group").alias("group")
    )
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "prefix-classes")
    groups = stage(classes.groupBy("group").agg(F.count(F.lit(1)).alias("classes")), "prefix-groups")
    parts = components(_proposed(rows.where("prefix is not null").select("group", "n", "prefix"), p), "prefix-parts")
    parts = parts.withColumnRenamed("node", "group")
    alone = groups.where("classes > 1").select("group").join(parts, "group", "left_anti")
    parts = stage(parts.unionByName(alone.withColumn("root", F.col("group"))), "prefix-roots")

    wanted = stage(classes.join(parts, "group").select("root", "group", "class", "least_id", "d1", "d2", "n"), "prefix-wanted")
    totals = wanted.groupBy("root").agg(F.sum("n").alias("grams_in"), F.count(F.lit(1)).alias("members_in"))
    blocks = F.greatest(F.ceil(F.col("grams_in") / p.block_grams), F.ceil(F.col("members_in") / p.block_members)).cast("int")
    # The blocks are dealt by name; whole sets join at the end, so they are shuffled twice and no more.
    named = wanted.join(totals.where("members_in > 1"), "root").withColumn("blocks", blocks)
    dealt = split_blocks(named, "root", "blocks", "class").select(*PART_KEYS, "own_block", "class", "group", "d1", "d2")
    # The texts are read a second time, for the members of connected groups only; one plan at every size.
    ids = named.select(F.col("least_id").alias("wanted_id")).distinct().hint("merge")
    sets = texts.join(ids, texts.doc_id.eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    sets = sets.mapInArrow(_full_sets(p), "d1 long, d2 long, grams binary").dropDuplicates(["d1", "d2"])
    dealt = dealt.join(sets, ["d1", "d2"]).select(*PART_KEYS, "own_block", F.col("class").alias("node"), "group", "grams")
    links = (
        dealt.repartition(*PART_KEYS)
        .sortWithinPartitions(*PART_KEYS)
        .mapInArrow(_links(p, levels), "a long, b long")
    )
    linked = components(links, "prefix-links").select(F.col("node").alias("class"), "root")

    named = classes.join(linked, "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = named.join(groups, "group")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = named.join(least, "root").select("d1", "d2", "component_id", "classes")
    found = rows.select("doc_id", "n", "d1", "d2").join(labels, ["d1", "d2"], "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("d1")).alias("class"),
        F.coalesce("classes", F.lit(0).cast("long")).alias("group_size"),
    )
