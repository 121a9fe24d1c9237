"""Near-duplicate documents: MinHash bands propose pairs, a sequential Bayesian test prunes them
batch by batch of the signature, and the full shingle sets decide about the survivors.

Documents with equal sets are one class from the start. A task tests the pairs of one bucket (or
of two blocks of a large bucket) with matrices and returns a spanning forest of the survivors, so
what a bucket gives grows with its members and not with its pairs. The forests join into groups
that hold every true link; within a group, again by blocks, pairs that pass the Bayesian test are
compared on their whole sets unless they are already connected.

Defined results: a null or empty text has an empty set and is linked with nothing; equal rows share
one result; rows of one id with different texts are judged by their own sets; rows without an id
take part in linking, get the smallest id of their component or null, and are kept only in a
component without any id. Ties go to the smaller id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .staging import broadcast_if_few, split_blocks, stage
from .words import SPACE, mix, reduce_by, shingle_sets, slices, text_bytes, word_hashes


@dataclass(frozen=True)
class NearDedup:
    """``percent``: two sets are linked if 100 * intersection >= percent * union.

    A true pair shares none of the ``bands`` with probability (1 - s^rows)^bands: 6e-11 at 0.85,
    5e-8 at 0.8. ``miss`` bounds the posterior probability of a link at which a pair is dropped.
    """

    percent: int = 85
    shingle: int = 5
    bands: int = 32
    rows: int = 4
    batch: int = 16
    miss: float = 1e-9
    bucket_block: int = 2048
    group_block: int = 1_000_000

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def least_matches(p: NearDedup) -> list[tuple[int, int]]:
    """(compared, least): after so many hashes a pair with fewer equal ones is dropped.

    The posterior of the similarity under a uniform prior, given m equal of n one-byte hashes;
    a byte of unequal hashes agrees in one of 256 cases.
    """
    grid = (np.arange(4000) + 0.5) / 4000
    chance = grid + (1 - grid) / 256
    linked = grid >= p.percent / 100
    bounds = []
    for n in range(p.batch, p.hashes + 1, p.batch):
        for m in range(n + 1):
            log = m * np.log(chance) + (n - m) * np.log1p(-chance) + lgamma(n + 1) - lgamma(m + 1) - lgamma(n - m + 1)
            weight = np.exp(log - log.max())
            if weight[linked].sum() / weight.sum() >= p.miss:
                bounds.append((n, m))
                break
    return bounds


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the signature pairs that no batch rules out; all pairs are looked at in
    strips of bounded size."""
    found_i, found_j = [], []
    strip = max(1, (1 << 22) // max(1, len(right) * bounds[0][0]))
    for at in range(0, len(left), strip):
        rows = left[at : at + strip]
        first = bounds[0][0]
        equal = (rows[:, None, :first] == right[None, :, :first]).sum(axis=2, dtype=np.int32)
        i, j = np.nonzero(equal >= bounds[0][1])
        count = equal[i, j]
        done = first
        for n, least in bounds[1:]:
            if not len(i):
                break
            count = count + (rows[i, done:n] == right[j, done:n]).sum(axis=1, dtype=np.int32)
            keep = count >= least
            i, j, count, done = i[keep], j[keep], count[keep], n
        found_i.append(i + at)
        found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


class Forest:
    """Union-find over local row numbers, smaller root first."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.touched: set[int] = set()

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        self.touched.update((x, y))
        return True


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(911).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: np.ndarray, pointers: np.ndarray, n: int) -> np.ndarray:
    """MinHash values (texts x n, 32 bits) by multiply-shift hashes of the mixed shingles."""
    texts = len(pointers) - 1
    out = np.full((texts, n), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(pointers[1:] > pointers[:-1])
    multipliers = _multipliers(n)
    at = 0
    while at < len(filled):  # runs of texts whose shingles fit the processor's cache
        end = at + 1
        while end < len(filled) and pointers[filled[end] + 1] - pointers[filled[at]] <= 65_536:
            end += 1
        low, high = pointers[filled[at]], pointers[filled[end - 1] + 1]
        starts = pointers[filled[at:end]] - low
        part = sets[low:high]
        buffer = np.empty_like(part)
        for k in range(n):
            np.multiply(part, multipliers[k], out=buffer)
            out[filled[at:end], k] = np.minimum.reduceat(buffer, starts) >> np.uint64(32)
        at = end
    return out


def set_digests(sets: np.ndarray, pointers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = reduce_by(np.add, mix(sets, 11), pointers, 0)
    second = reduce_by(np.add, mix(sets, 12), pointers, 0)
    size = (pointers[1:] - pointers[:-1]).astype(np.uint64)
    return mix(first + size, 1).view(np.int64), mix(second + size, 2).view(np.int64)


def _sets_of(batch: pa.RecordBatch, shingle: int):
    data, offsets = text_bytes(batch.column("text"))
    hashes, pointers, _, _ = word_hashes(data, offsets, SPACE)
    return shingle_sets(hashes, pointers, shingle)


def _profile(p: NearDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, pointers = _sets_of(batch, p.shingle)
            d1, d2 = set_digests(sets, pointers)
            values = signatures(sets, pointers, p.hashes)
            bands = np.zeros((len(values), p.bands), np.uint64)
            for k in range(p.rows):
                bands = bands * np.uint64(0x100000001B3) + values[:, k :: p.rows].astype(np.uint64) + np.uint64(1)
            bands = mix(bands + np.arange(p.bands, dtype=np.uint64) * np.uint64(0x51ED270B)).view(np.int64)
            # one-byte signature; column order: hash k of every band lies in batch order
            small = (values & np.uint32(0xFF)).astype(np.uint8)
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "t1", "t2")],
                    pa.array(pointers[1:] - pointers[:-1]),
                    pa.array(d1),
                    pa.array(d2),
                    pa.array([row.tobytes() for row in small], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * p.bands), pa.array(bands.reshape(-1))
                    ),
                ],
                ["doc_id", "t1", "t2", "n_shingles", "d1", "d2", "sig", "buckets"],
            )

    return run


def _complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows, from batches sorted by the integer ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        change = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        if held:
            last = [held[-1].column(k)[len(held[-1]) - 1].as_py() for k in keys]
            if last != marks[:, 0].tolist():
                yield pa.Table.from_batches(held)
                held = []
        if len(change):
            cut = int(change[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _group_runs(table: pa.Table, keys: list[str]) -> list[tuple[int, int]]:
    marks = np.stack([table.column(k).to_numpy() for k in keys])
    change = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
    edges = [0, *change.tolist(), table.num_rows]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _sides(own: np.ndarray, left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(own == left), np.flatnonzero(own == right)


def _stars(forest: Forest, nodes: np.ndarray) -> tuple[list[int], list[int]]:
    """The forest's parts as stars around their smallest node: flat, so few rounds join them later."""
    parts: dict[int, list[int]] = {}
    for row in forest.touched:
        parts.setdefault(forest.root(row), []).append(int(nodes[row]))
    out_a, out_b = [], []
    for members in parts.values():
        least = min(members)
        others = [m for m in members if m != least]
        out_a.extend(others)
        out_b.extend([least] * len(others))
    return out_a, out_b


def _edges(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _fixed_width(column: pa.ChunkedArray, width: int) -> np.ndarray:
    data, _ = text_bytes(column.combine_chunks().cast(pa.binary()))
    return data.reshape(-1, width)


BUCKET_KEYS = ["bucket", "left_block", "right_block"]


def _bucket_forests(p: NearDedup, bounds: list[tuple[int, int]]):
    """From each bucket (pair of blocks), a spanning forest of the pairs the Bayesian test keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete_groups(batches, BUCKET_KEYS):
            sigs = _fixed_width(table.column("sig"), p.hashes)
            nodes = table.column("node").to_numpy()
            own = table.column("own_block").to_numpy()
            lefts, rights = table.column("left_block").to_numpy(), table.column("right_block").to_numpy()
            out_a, out_b = [], []
            for low, high in _group_runs(table, BUCKET_KEYS):
                if high - low < 2:
                    continue
                x, y = _sides(own[low:high], lefts[low], rights[low])
                if not len(x) or not len(y):
                    continue
                i, j = survivors(sigs[low:high][x], sigs[low:high][y], bounds)
                i, j = x[i], y[j]
                if lefts[low] == rights[low]:
                    keep = i < j
                    i, j = i[keep], j[keep]
                forest = Forest(high - low)
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    forest.join(a, b)
                for out, part in zip((out_a, out_b), _stars(forest, nodes[low:high]), strict=True):
                    out.extend(part)
            if out_a:
                yield _edges(out_a, out_b)

    return run


def _with_sets(p: NearDedup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, pointers = _sets_of(batch, p.shingle)
            d1, d2 = set_digests(sets, pointers)
            payload = [sets[a:b].tobytes() for a, b in zip(pointers[:-1], pointers[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1), pa.array(d2), pa.array(payload, pa.binary())], ["d1", "d2", "shingles"]
            )

    return run


GROUP_KEYS = ["root", "left_block", "right_block"]


def _linked(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``others`` are linked with ``one``, all sorted sets."""
    flat = np.concatenate(others)
    place = np.searchsorted(one, flat)
    place[place == len(one)] = 0
    sizes = np.array([len(o) for o in others], np.int64)
    common = np.add.reduceat((one[place] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return 100 * common >= percent * (len(one) + sizes - common)


def _exact_forests(p: NearDedup, bounds: list[tuple[int, int]]):
    """From each group (pair of blocks), a spanning forest of the pairs linked on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete_groups(batches, GROUP_KEYS):
            sigs = _fixed_width(table.column("sig"), p.hashes)
            nodes, own = table.column("node").to_numpy(), table.column("own_block").to_numpy()
            lefts, rights = table.column("left_block").to_numpy(), table.column("right_block").to_numpy()
            data, offsets = text_bytes(table.column("shingles").combine_chunks().cast(pa.large_binary()))
            out_a, out_b = [], []
            for low, high in _group_runs(table, GROUP_KEYS):
                x, y = _sides(own[low:high], lefts[low], rights[low])
                if high - low < 2 or not len(x) or not len(y):
                    continue
                sets = [
                    np.frombuffer(data[offsets[r] : offsets[r + 1]].tobytes(), np.uint64) for r in range(low, high)
                ]
                i, j = survivors(sigs[low:high][x], sigs[low:high][y], bounds)
                i, j = x[i], y[j]
                if lefts[low] == rights[low]:
                    keep = i < j
                    i, j = i[keep], j[keep]
                forest = Forest(high - low)
                cuts = np.searchsorted(i, np.unique(i))
                for first, last in zip(cuts.tolist(), [*cuts[1:].tolist(), len(i)], strict=True):
                    a = int(i[first])
                    rest = [b for b in j[first:last].tolist() if forest.root(b) != forest.root(a)]
                    # in strips: a success connects a whole part of the group, whose pairs then need no test
                    for at in range(0, len(rest), 64):
                        strip = [b for b in rest[at : at + 64] if forest.root(b) != forest.root(a)]
                        if strip:
                            for b, hit in zip(strip, _linked(sets[a], [sets[b] for b in strip], p.percent), strict=True):
                                if hit:
                                    forest.join(a, b)
                for out, part in zip((out_a, out_b), _stars(forest, nodes[low:high]), strict=True):
                    out.extend(part)
            if out_a:
                yield _edges(out_a, out_b)

    return run


def text_digest(text: str = "text") -> list:
    """Two hashes that name a text; a missing one is the empty text."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(31), whole).alias("t2")]


def near_duplicates(documents: DataFrame, p: NearDedup = NearDedup()) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, kept."""
    found = _components_of(documents, p)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(documents: DataFrame, p: NearDedup = NearDedup()) -> DataFrame:
    """``documents`` with one row of each component: that with the smallest id, rows without id last, then
    by a digest of the text. Rows are told apart by id and text, so another text of an id that goes
    stays; of rows equal in both one stays. Empty sets are no copies of anything and all stay."""
    key = ["doc_id", "t1", "t2"]
    found = _components_of(documents, p).where("n_shingles > 0").groupBy("root", *key).agg(F.count(F.lit(1)).alias("rows"))
    found = stage(found, "near-keys")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), *key)).alias("first"))
    met = found.join(first, "root")
    stays = F.struct(F.col("doc_id").isNull(), *key) == F.col("first")
    gone = stage(met.where(~stays).select(*[F.col(c).alias(f"_{c}") for c in key]), "near-gone")
    gone = broadcast_if_few(gone)
    again = stage(met.where(stays & (F.col("rows") > 1)).select(*[F.col(c).alias(f"_{c}") for c in key]), "near-repeated")
    named = documents.withColumns(dict(zip(["_own1", "_own2"], text_digest(), strict=True)))

    def same(other: DataFrame) -> list:
        id_of = named["doc_id"].cast("long")
        return [id_of.eqNullSafe(other["_doc_id"]), named["_own1"] == other["_t1"], named["_own2"] == other["_t2"]]

    kept = named.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return kept.drop("_own1", "_own2")
    again = broadcast_if_few(again)
    once = kept.join(again, same(again), "left_anti")
    # Only rows that are equal in id and text are grouped.
    twice = kept.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "_own1", "_own2"])
    return once.unionByName(twice).drop("_own1", "_own2")


def _components_of(documents: DataFrame, p: NearDedup) -> DataFrame:
    """Per row: doc_id, t1, t2 (of the text), n_shingles, component_id, root (of its component, any number)."""
    bounds = least_matches(p)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *text_digest()
    )
    rows = stage(
        texts.mapInArrow(
            _profile(p), "doc_id long, t1 long, t2 long, n_shingles long, d1 long, d2 long, sig binary, buckets array<long>"
        ),
        "near-rows",
    )
    filled = rows.where("n_shingles > 0")

    # Equal sets are one class; its number is fixed by writing it.
    classes = stage(
        filled.groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
            F.first("buckets").alias("buckets"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "near-classes",
    )
    shared = classes.select("node", F.explode("buckets").alias("bucket"))
    sizes = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = (
        shared.join(sizes, "bucket")
        .join(classes.select("node", "sig"), "node")
        .withColumn("blocks", F.ceil(F.col("members") / p.bucket_block).cast("int"))
    )
    dealt = split_blocks(members, "bucket", "blocks", "node").select(*BUCKET_KEYS, "own_block", "node", "sig")
    proposed = (
        dealt.repartition(*BUCKET_KEYS)
        .sortWithinPartitions(*BUCKET_KEYS)
        .mapInArrow(_bucket_forests(p, bounds), "a long, b long")
    )
    groups = stage(components(proposed, "near-proposed"), "near-groups")

    # Whole sets for the members of groups only: their texts are read a second time.
    wanted = stage(
        classes.join(groups, "node").select("node", "root", "least_id", "d1", "d2", "n_shingles", "sig"), "near-wanted"
    )
    # The merge hint keeps one plan at every size: the texts are shuffled once, whatever the number of ids.
    ids = wanted.select(F.col("least_id").alias("wanted_id")).distinct().hint("merge")
    sets = texts.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    sets = sets.mapInArrow(_with_sets(p), "d1 long, d2 long, shingles binary").dropDuplicates(["d1", "d2"])
    totals = wanted.groupBy("root").agg(F.sum("n_shingles").alias("total"))
    ready = (
        wanted.join(sets, ["d1", "d2"])
        .join(totals, "root")
        .withColumn("blocks", F.ceil(F.col("total") / p.group_block).cast("int"))
    )
    split = split_blocks(ready, "root", "blocks", "node").select(*GROUP_KEYS, "own_block", "node", "sig", "shingles")
    links = (
        split.repartition(*GROUP_KEYS)
        .sortWithinPartitions(*GROUP_KEYS)
        .mapInArrow(_exact_forests(p, bounds), "a long, b long")
    )
    linked = components(links, "near-links")

    named = classes.select("d1", "d2", "node", "least_id").join(linked, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = named.join(least, "root").select("d1", "d2", "root", "component_id")
    found = rows.select("doc_id", "t1", "t2", "n_shingles", "d1", "d2").join(labels, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "t1", "t2", "n_shingles", component.alias("component_id"), "root")
