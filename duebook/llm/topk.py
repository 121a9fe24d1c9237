"""Exact top-k by inner product: dual-tree search over cover trees of queries and data.

Every vector goes to its nearest pivot (a greedy net of a bounded sample); the vectors of a pivot,
cut by hash into blocks of bounded size, make one cover tree each. Query blocks are made alike.
A first search of each query block in one data block near to it bounds its worst k-th score; block
pairs whose covering radii cannot reach that bound are dropped, and the rest are searched pair by
pair, pruning node pairs by the same bound. What is pruned cannot hold a result, so results are exact.

For two balls with centers a, b and radii r, s no inner product exceeds a.b + r|b| + s|a| + rs.

Defined results: vectors that are null or hold null or non-finite components, and rows without an
id, take no part; shorter vectors count as padded with zeros; an own row is any row with the
query's id; repeated rows are candidates each, and a query repeated with another vector is answered
for each of them with common ranks by id; ties go to the smaller id; fewer candidates than k are all
returned; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .near_dedup import _complete_groups, _group_runs
from .staging import stage

EXACT = 2.0**53


@dataclass(frozen=True)
class SearchParameters:
    k: int = 20
    scale: int = 64
    sample: int = 2048  # most vectors among which pivots are chosen
    pivots: int = 256
    data_block: int = 4096
    query_block: int = 256
    bucket: int = 32  # a node of so few points is not split


# --- cover tree -----------------------------------------------------------------------------


@dataclass
class Node:
    center: np.ndarray
    radius: float
    points: np.ndarray  # rows held here directly
    children: list["Node"]
    centers: np.ndarray | None = None  # of the children
    radii: np.ndarray | None = None
    norms: np.ndarray | None = None


def greedy_net(points: np.ndarray, least_gap: float, most: int | None = None) -> np.ndarray:
    """Rows that are at least ``least_gap`` apart and cover all points within it: farthest first."""
    chosen = [0]
    gap = _distances(points, points[0])
    while most is None or len(chosen) < most:
        far = int(gap.argmax())
        if gap[far] <= least_gap:
            break
        chosen.append(far)
        gap = np.minimum(gap, _distances(points, points[far]))
    return np.array(chosen)


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - center) ** 2).sum(axis=1))


def cover_tree(points: np.ndarray, rows: np.ndarray, bucket: int, children: int = 64) -> Node:
    """Nodes cover their rows within ``radius`` of a center row; the centers of siblings form a net.

    Siblings are at most ``children``: where a net at half the radius would need more, it is coarser.
    """
    own = points[rows]
    center = own[int(_distances(own, own.mean(axis=0)).argmin())]
    radius = float(_distances(own, center).max())
    if len(rows) <= bucket or radius == 0:
        return Node(center, radius, rows, [])
    net = greedy_net(own, radius / 2, children)
    gaps = np.stack([_distances(own, own[i]) for i in net])
    nearest = gaps.argmin(axis=0)
    parts = [rows[nearest == i] for i in range(len(net))]
    alone = np.concatenate([p for p in parts if len(p) <= bucket // 4] or [rows[:0]])
    nodes = [cover_tree(points, p, bucket, children) for p in parts if len(p) > bucket // 4]
    if len(nodes) == 1 and len(nodes[0].points) + len(alone) == len(rows) and not nodes[0].children:
        return Node(center, radius, rows, [])
    node = Node(center, radius, alone, nodes)
    if nodes:
        node.centers = np.stack([n.center for n in nodes])
        node.radii = np.array([n.radius for n in nodes])
        node.norms = np.sqrt((node.centers**2).sum(axis=1))
    return node


@dataclass
class Block:
    """A cover tree with its integer vectors and ids: what a task works on."""

    ids: np.ndarray
    vectors: np.ndarray
    tree: Node

    @property
    def largest(self) -> float:
        return float(np.abs(self.vectors).max(initial=0))


def make_block(ids: np.ndarray, vectors: np.ndarray, bucket: int) -> Block:
    points = vectors.astype(float)
    small = next(
        (t for t in (np.int8, np.int16, np.int32) if np.abs(points).max(initial=0) <= np.iinfo(t).max), np.int64
    )
    return Block(ids, vectors.astype(small), cover_tree(points, np.arange(len(ids)), bucket))


# --- dual-tree search -----------------------------------------------------------------------


class Best:
    """The k best (score, id) of each query; unused places hold the lowest score."""

    NONE = -(1 << 63)

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), self.NONE, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return self.scores[rows, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        scores = np.where(allowed, scores, self.NONE)
        better = (scores >= self.worst(rows)[:, None]).any(axis=1)
        if not better.any():
            return
        rows, scores = rows[better], scores[better]
        allowed = allowed[better]
        k = self.scores.shape[1]
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        wide_ids = np.where(allowed, np.broadcast_to(ids, scores.shape), np.iinfo(np.int64).max)
        all_ids = np.concatenate([self.ids[rows], wide_ids], axis=1)
        order = np.lexsort((all_ids, ~all_scores), axis=-1)[:, :k]  # ~x orders like -x, without overflow
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(all_ids, order, axis=1)


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T  # beyond 53 bits: Python integers, held to 64 bits
    return np.clip(whole, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


def _all_rows(node: Node) -> np.ndarray:
    return np.concatenate([node.points, *[_all_rows(c) for c in node.children]])


def search(queries: Block, data: Block, best: Best) -> None:
    exact = queries.largest * data.largest * max(1, data.vectors.shape[1]) < EXACT
    slack = 1.0 if exact else np.inf  # rounding of the bounds; without exact floats nothing is pruned

    def reach(q: Node, d: Node) -> np.ndarray:
        """Upper bounds for q against each child of d."""
        q_norm = np.sqrt(q.center @ q.center)
        return d.centers @ q.center + q.radius * d.norms + d.radii * q_norm + q.radius * d.radii + slack

    def visit(q: Node, q_rows: np.ndarray, d: Node) -> None:
        if len(d.points):
            for at in range(0, len(d.points), 2048):
                rows = d.points[at : at + 2048]
                scores = _products(queries.vectors[q_rows], data.vectors[rows], exact)
                best.add(q_rows, scores, data.ids[rows], queries.ids[q_rows][:, None] != data.ids[rows][None, :])
        if not d.children:
            return
        if q.children and q.radius > d.radius:
            for part in (*q.children, *([Node(q.center, q.radius, q.points, [])] if len(q.points) else [])):
                descend(part, _all_rows(part), d)
        else:
            descend(q, q_rows, d)

    def descend(q: Node, q_rows: np.ndarray, d: Node) -> None:
        bounds = reach(q, d)
        for i in np.argsort(-bounds):
            if bounds[i] >= best.worst(q_rows).min():
                visit(q, q_rows, d.children[i])

    if len(queries.ids) and len(data.ids):
        visit(queries.tree, _all_rows(queries.tree), data.tree)


# --- Spark ----------------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _to_pivots(pivots: np.ndarray, width: int):
    squares = (pivots**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                points = _matrix(batch.column("v"), width).astype(float)
                leaf = (squares - 2 * points @ pivots.T).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), pa.array(leaf.astype(np.int32))], ["vec_id", "v", "leaf"]
                )

    return run


def _blocks(keys: list[str], width: int, bucket: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _complete_groups(batches, keys):
            for low, high in _group_runs(table, keys):
                part = table.slice(low, high - low)
                block = make_block(part.column("vec_id").to_numpy(), _matrix(part.column("v"), width), bucket)
                tree = block.tree
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([table.column(k)[low].as_py()], pa.int32()) for k in keys],
                        pa.array([tree.center.tolist()], pa.list_(pa.float64())),
                        pa.array([tree.radius]),
                        pa.array([block.largest]),
                        pa.array([pickle.dumps(block, 5)], pa.binary()),
                    ],
                    [*keys, "center", "radius", "largest", "block"],
                )

    return run


def _own_worst(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                queries, data = (pickle.loads(batch.column(c)[i].as_py()) for c in ("q_block", "d_block"))
                best = Best(len(queries.ids), k)
                search(queries, data, best)
                worst = pickle.dumps(best.scores[:, -1], 5)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("q").slice(i, 1),
                        pa.array([float(best.scores[:, -1].min())]),
                        pa.array([worst], pa.binary()),
                    ],
                    ["q", "worst", "worsts"],
                )

    return run


def _pair_results(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                queries, data = (pickle.loads(batch.column(c)[i].as_py()) for c in ("q_block", "d_block"))
                best = Best(len(queries.ids), k)
                # a score below the k-th of the first search is no result: places start one below it
                start = batch.column("worsts")[i].as_py()
                if start is not None:
                    start = pickle.loads(start)
                    best.scores[:] = np.where(start > Best.NONE, start - 1, start)[:, None]
                search(queries, data, best)
                found = best.ids < np.iinfo(np.int64).max
                rows = np.repeat(np.arange(len(queries.ids)), found.sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.ids[rows]), pa.array(best.ids[found]), pa.array(best.scores[found])],
                    ["query_id", "vec_id", "score"],
                )

    return run


def _salted(rows: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """``leaf`` and ``part``: the vectors of a pivot dealt by hash to parts of about ``size`` rows. ``row`` is a
    written number of the row, as very many may be equal otherwise."""
    parts = counts.withColumn("parts", F.ceil(F.col("n") / size).cast("int")).drop("n")
    return rows.join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64("vec_id", "v", "row"), "parts").cast("int"))


def top_k(vectors: DataFrame, every: int = 20, p: SearchParameters = SearchParameters()) -> DataFrame:
    """(query_id, rank, vec_id, score) of the queries, the rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(usable)
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * p.scale)).alias("v"),
    )
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    if not shape["n"]:
        return spark.createDataFrame([], schema)
    width = max(1, shape["width"])
    pick = F.pmod(F.xxhash64(F.lit("pivot"), "vec_id", "v"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.where(pick < 1.5 * p.sample / shape["n"]).orderBy(pick, "vec_id", "v").limit(p.sample).collect()
    points = np.zeros((max(1, len(sample)), width))
    for i, r in enumerate(sample):
        points[i, : len(r["v"])] = r["v"]
    wanted = max(1, min(p.pivots, shape["n"] // p.data_block))
    pivots = points[greedy_net(points, 0.0, wanted)]

    placed = rows.mapInArrow(_to_pivots(pivots, width), "vec_id long, v array<long>, leaf int")
    assigned = stage(placed.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    is_query = F.col("vec_id") % every == 0
    counts = assigned.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("long")).alias("queries"))
    per_leaf = sorted(counts.collect(), key=lambda r: r["leaf"])  # a row per pivot at most
    data = _salted(assigned, spark.createDataFrame([(r["leaf"], r["n"]) for r in per_leaf], "leaf int, n long"), p.data_block)
    block_fields = "center array<double>, radius double, largest double, block binary"
    data_blocks = stage(
        data.select("leaf", "part", "vec_id", "v")
        .repartition("leaf", "part")
        .sortWithinPartitions("leaf", "part", "vec_id")
        .mapInArrow(_blocks(["leaf", "part"], width, p.bucket), f"leaf int, part int, {block_fields}"),
        "topk-data",
    )
    # Neighbouring pivots with few queries share a query block, one with many is cut.
    groups, group, held = [], 0, 0
    for r in per_leaf:
        if held and held + r["queries"] > p.query_block:
            group, held = group + 1, 0
        groups.append((r["leaf"], group))
        held += r["queries"]
    group_of = spark.createDataFrame(groups, "leaf int, q_group int")
    asked = assigned.where(is_query).join(group_of, "leaf").select(F.col("q_group").alias("leaf"), "vec_id", "v")
    asked = asked.distinct().withColumn("row", F.lit(0))
    query_blocks = stage(
        _salted(asked, asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")), p.query_block)
        .select("leaf", "part", "vec_id", "v")
        .repartition("leaf", "part")
        .sortWithinPartitions("leaf", "part", "vec_id")
        .mapInArrow(_blocks(["leaf", "part"], width, p.bucket), f"leaf int, part int, {block_fields}"),
        "topk-queries",
    )
    key = F.concat_ws("-", "leaf", "part")
    q = query_blocks.select(key.alias("q"), "leaf", *[F.col(c).alias(f"q_{c}") for c in ("center", "radius", "largest", "block")])
    d = data_blocks.select(key.alias("d"), "leaf", "part", *[F.col(c).alias(f"d_{c}") for c in ("center", "radius", "largest", "block")])

    # First search: in one data block of a pivot of the query block's group.
    home = spark.createDataFrame(groups, "home int, leaf int").groupBy("leaf").agg(F.min("home").alias("home"))
    near = q.join(home, "leaf").select("q", "q_block", "home")
    least_part = d.groupBy("leaf").agg(F.min("part").alias("part"))
    homes = d.join(least_part, ["leaf", "part"]).select(F.col("leaf").alias("home"), "d_block")
    near = near.join(homes, "home")
    first = near.select("q", "q_block", "d_block").repartition("q").mapInArrow(_own_worst(p.k), "q string, worst double, worsts binary")
    first = stage(first, "topk-first")

    # Block pairs by their numbers and balls alone; those that cannot reach the worst k-th score go.
    n_blocks = data_blocks.count()
    numbered = stage(
        d.select("d", "d_center", "d_radius", "d_largest").withColumn(
            "number", F.row_number().over(W.orderBy("d")) - 1
        ),
        "topk-numbers",
    )
    pairs = (
        q.select("q", "q_center", "q_radius", "q_largest")
        .join(first, "q", "left")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        .join(numbered, "number")
    )
    dot = F.aggregate(F.zip_with("q_center", "d_center", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    def norm(c: str):
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, b: a + b * b))

    reach = dot + F.col("q_radius") * norm("d_center") + F.col("d_radius") * norm("q_center")
    reach = reach + F.col("q_radius") * F.col("d_radius") + 1.0
    exact = F.col("q_largest") * F.col("d_largest") * width < EXACT
    kept = pairs.where(~exact | F.col("worst").isNull() | (reach >= F.col("worst"))).select("q", "d", "worsts")
    none = F.col("worsts")
    found = (
        kept.join(q.select("q", "q_block"), "q")
        .join(d.select("d", "d_block"), "d")
        .select("q_block", "d_block", none)
        .mapInArrow(_pair_results(p.k), "query_id long, vec_id long, score long")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
