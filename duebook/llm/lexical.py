"""Ranked lexical search with hashed max-sketches.

The index has one sketch for each text: its terms are hashed to ``coordinates`` places and each place
keeps the largest term frequency. A term's impact grows with its frequency, so at search time the
place's impact is the coordinatewise maximum of the impacts folded into it, and the sum over an
item's terms bounds the item's exact score from above. Items are looked up in batches: a block of
sketches times the weights of all items of a block is one matrix product. The best bounds are scored
exactly first; their k-th score is the threshold below which no bound needs a look, and the texts
above it are scored in descending order of their bounds, in growing batches, until none is left.

Equal texts are scored once. Terms are compared by 64-bit hashes.

Defined results: null and empty texts and texts without a term are no documents of the statistics and
never found; items without a term have no rows; each row of the items is a query of its own, also
where ids repeat; repeated documents each take a rank; equal scores go to the smaller doc_id, null
ids last; whole texts of any length are used; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage
from .words import NOT_ALNUM, slices, text_bytes, word_hashes

DIGEST = ("d1", "d2")
#: The largest frequency a sketch can state; it stands for any frequency from there on.
TOP_TF = 65_535
#: The impact of a term stays below this, whatever its frequency.
MOST_IMPACT = 1_000_000


@dataclass(frozen=True)
class Lexical:
    """``k`` documents for each item. ``block_terms`` bounds the items that are searched together by
    their distinct terms, ``first_batch`` is how many texts of an item are scored after the first k.
    ``broadcast_rows``: up to so many wanted texts their digests are broadcast (48 bytes each)."""

    k: int = 20
    bits: int = 14
    block_rows: int = 512
    block_terms: int = 40_000
    first_batch: int = 320
    df_rows: int = 1 << 21
    broadcast_rows: int = 500_000

    def __post_init__(self) -> None:
        if not 1 <= self.bits <= 16:
            raise ValueError("a sketch has 2 to 65,536 coordinates")


def _term_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, frequency) of the distinct terms of each text, terms ascending, and all terms' number."""
    data, offsets = text_bytes(column)
    hashes, pointers, _, _ = word_hashes(data, offsets, NOT_ALNUM)
    n = np.diff(pointers)
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    opens = np.ones(len(hashes), bool)
    opens[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(opens)
    return text[starts], hashes[starts], np.diff(np.append(starts, len(hashes))), n


def _frequencies(terms: np.ndarray, counts: np.ndarray, batch: pa.Schema) -> pa.RecordBatch:
    lists = {
        "terms": pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), pa.array(terms.view(np.int64))),
        "counts": pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts)),
    }
    return pa.RecordBatch.from_arrays([lists.get(f.name, pa.nulls(1, f.type)) for f in batch], schema=batch)


INDEX_SCHEMA = "doc_id long, d1 long, d2 long, n long, sketch binary, terms array<long>, counts array<long>"
INDEX_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()),
        ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ]
)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    terms = np.concatenate([t for t, _ in parts])
    unique, place = np.unique(terms, return_inverse=True)
    counts = np.zeros(len(unique), np.int64)
    np.add.at(counts, place, np.concatenate([c for _, c in parts]))
    return unique, counts


def _sketches(p: Lexical):
    """A row with a sketch for each text, and rows with the number of texts of each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, "text"):
            text, terms, tf, n = _term_counts(batch.column("text"))
            held.append(np.unique(terms, return_counts=True))
            if sum(len(t) for t, _ in held) > p.df_rows:
                held = [_merged(held)]
                if len(held[0][0]) > p.df_rows // 2:
                    yield _frequencies(*held.pop(), INDEX_ARROW)
            # Terms ascend within a text, and so do their leading bits, the coordinates.
            coordinate = (terms >> np.uint64(64 - p.bits)).astype(np.uint16)
            opens = np.ones(len(terms), bool)
            opens[1:] = (coordinate[1:] != coordinate[:-1]) | (text[1:] != text[:-1])
            starts = np.flatnonzero(opens)
            most = np.maximum.reduceat(tf, starts) if len(starts) else tf
            pairs = np.stack([coordinate[starts], np.minimum(most, TOP_TF).astype(np.uint16)], axis=1)
            bounds = np.searchsorted(text[starts], np.arange(len(n) + 1))
            sketches = [pairs[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            none = pa.nulls(len(n), INDEX_ARROW.field("terms").type)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", *DIGEST)], pa.array(n), pa.array(sketches, pa.binary()), none, none],
                schema=INDEX_ARROW,
            )
        if held:
            yield _frequencies(*_merged(held), INDEX_ARROW)

    return run


def with_digest(texts: DataFrame) -> DataFrame:
    return texts.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(29), "text")})


def lexical_index(documents: DataFrame, p: Lexical = Lexical()) -> DataFrame:
    """The written index: sketches (rows with ``sketch``) and document frequencies (rows with ``terms``)."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return stage(with_digest(texts).mapInArrow(_sketches(p), INDEX_SCHEMA), "lexical-index")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, terms, tf, n = _term_counts(batch.column("text"))
        cuts = pa.array(np.searchsorted(text, np.arange(len(n) + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item"),
                batch.column("item_id"),
                pa.ListArray.from_arrays(cuts, pa.array(terms.view(np.int64))),
                pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int64))),
            ],
            ["item", "item_id", "terms", "tfs"],
        )


class Block:
    """A block of items: their vocabulary, its weights, and each item's terms as places of it."""

    def __init__(self, items: list, frequencies: dict[int, int], documents: int, words: int, bits: int):
        self.items = np.array([r["item"] for r in items], np.int64)
        self.vocabulary = np.unique(np.array([t for r in items for t in r["terms"]], np.int64).view(np.uint64))
        found = [frequencies.get(t, 0) for t in self.vocabulary.view(np.int64).tolist()]
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in found], np.int64)
        self.terms = [np.searchsorted(self.vocabulary, np.array(r["terms"], np.int64).view(np.uint64)) for r in items]
        self.tfs = [np.array(r["tfs"], np.int64) for r in items]
        self.documents, self.words, self.bits = documents, words, bits

    def length_factor(self, n: np.ndarray) -> np.ndarray:
        """m of texts with ``n`` terms; Python integers, as the product may pass 64 bits."""
        return np.array([75 + (25 * int(x) * self.documents) // self.words for x in n.tolist()], np.int64)

    def bound_weights(self) -> tuple[np.ndarray, np.ndarray, np.float32]:
        """(place of each coordinate or -1, weights place x item, the allowance for rounding)."""
        coordinate = (self.vocabulary >> np.uint64(64 - self.bits)).astype(np.int64)
        used, place = np.unique(coordinate, return_inverse=True)
        at = np.full(1 << self.bits, -1, np.int32)
        at[used] = np.arange(len(used))
        weights = np.zeros((len(used), len(self.terms)), np.float32)
        for item, (terms, tfs) in enumerate(zip(self.terms, self.tfs, strict=True)):
            weights[:, item] = np.bincount(place[terms], self.weight[terms] * tfs, len(used))
        most = max((len(t) for t in self.terms), default=0)
        return at, weights, np.float32(1 + (most + 8) * 1.2e-7)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _blocks_of_new(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, without texts this task has had."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        new = []
        for row, key in enumerate(zip(*[batch.column(c).to_pylist() for c in DIGEST], strict=True)):
            if key not in seen:
                seen.add(key)
                new.append(row)
        batch = batch.take(pa.array(new, pa.int64()))
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _bounds(batch: pa.RecordBatch, block: Block, at: np.ndarray, weights: np.ndarray, allowance: np.float32) -> np.ndarray:
    """Upper bounds of the scores (texts x items) of a batch of sketches."""
    m = block.length_factor(batch.column("n").to_numpy(zero_copy_only=False))
    data, offsets = text_bytes(batch.column("sketch"))
    pairs = np.frombuffer(data.tobytes(), np.uint16).reshape(-1, 2)
    text = np.repeat(np.arange(len(batch)), np.diff(offsets) // 4)
    place = at[pairs[:, 0]]
    hit = place >= 0
    tf, text, place = pairs[hit, 1].astype(np.int64), text[hit], place[hit]
    dense = np.zeros((len(batch), len(weights)), np.float32)
    dense[text, place] = np.where(tf == TOP_TF, MOST_IMPACT, impacts(tf, m[text]))
    return (dense @ weights) * allowance


def _bound_rows(rows: np.ndarray, items: np.ndarray, bounds: np.ndarray, batch: pa.RecordBatch, block: Block) -> pa.RecordBatch:
    keys = [batch.column(c).to_numpy(zero_copy_only=False)[rows] for c in DIGEST]
    return pa.RecordBatch.from_arrays(
        [pa.array(block.items[items]), *map(pa.array, keys), pa.array(bounds.astype(np.float64))], ["item", *DIGEST, "bound"]
    )


BOUND_SCHEMA = "item long, d1 long, d2 long, bound double"


def _best_bounds(p: Lexical, block: Block):
    """The k best bounds of each item in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = block.bound_weights()
        kept, keys = np.zeros((0, len(block.items)), np.float32), np.zeros((0, len(block.items), 2), np.int64)
        for batch in _blocks_of_new(batches, p.block_rows):
            bounds = _bounds(batch, block, *model)
            own = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in DIGEST], axis=1)
            bounds = np.concatenate([kept, bounds])
            keys = np.concatenate([keys, np.broadcast_to(own[:, None, :], (len(own), len(block.items), 2))])
            if len(bounds) > p.k:
                best = np.argpartition(-bounds, p.k - 1, axis=0)[: p.k]
                bounds, keys = np.take_along_axis(bounds, best, 0), np.take_along_axis(keys, best[:, :, None], 0)
            kept = bounds
        row, item = np.nonzero(kept > 0)
        if len(row):
            found = [pa.array(block.items[item]), pa.array(keys[row, item, 0]), pa.array(keys[row, item, 1])]
            yield pa.RecordBatch.from_arrays([*found, pa.array(kept[row, item].astype(np.float64))], ["item", *DIGEST, "bound"])

    return run


def _bounds_from(p: Lexical, block: Block, least: np.ndarray):
    """All bounds from an item's threshold on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = block.bound_weights()
        for batch in _blocks_of_new(batches, p.block_rows):
            bounds = _bounds(batch, block, *model)
            row, item = np.nonzero(bounds >= least)
            if len(row):
                yield _bound_rows(row, item, bounds[row, item], batch, block)

    return run


def _exact_scores(block: Block):
    """Scores of texts for the items each is wanted for; a text is scored once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {item: i for i, item in enumerate(block.items.tolist())}
        value = np.zeros(len(block.vocabulary), np.int64)
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches, "text"):
            text, terms, tf, n = _term_counts(batch.column("text"))
            m = block.length_factor(n)
            at = np.searchsorted(block.vocabulary, terms)
            at[at == len(block.vocabulary)] = 0
            hit = block.vocabulary[at] == terms
            text, tf, at = text[hit], tf[hit].astype(np.int64), at[hit]
            cuts = np.searchsorted(text, np.arange(len(n) + 1))
            out: list[tuple[int, int, int, int]] = []
            for row, (d1, d2, items) in enumerate(zip(*[batch.column(c).to_pylist() for c in (*DIGEST, "items")], strict=True)):
                if (d1, d2) in seen:
                    continue
                seen.add((d1, d2))
                used = at[cuts[row] : cuts[row + 1]]
                value[used] = block.weight[used] * impacts(tf[cuts[row] : cuts[row + 1]], m[row])
                for item in items:
                    i = place[item]
                    out.append((item, d1, d2, int((value[block.terms[i]] * block.tfs[i]).sum())))
                value[used] = 0
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["item", *DIGEST, "score"]
                )

    return run


def _scored(texts: DataFrame, wanted: DataFrame, block: Block, p: Lexical) -> DataFrame:
    """(item, d1, d2, score) of the ``wanted`` (item, d1, d2), from the texts themselves."""
    per_text = stage(wanted.groupBy(*DIGEST).agg(F.collect_set("item").alias("items")), "lexical-wanted")
    if per_text.count() <= p.broadcast_rows // 8:
        per_text = F.broadcast(per_text)
    found = texts.join(per_text, [*DIGEST]).select("text", *DIGEST, "items")
    scores = found.mapInArrow(_exact_scores(block), "item long, d1 long, d2 long, score long")
    return stage(scores.dropDuplicates(["item", *DIGEST]), "lexical-scores")


def _ranked(rows: DataFrame, by: str, order: list, most: int, rank=F.row_number) -> DataFrame:
    """The first ``most`` rows of each group; tasks cut their own rows before the shuffle."""
    window = Window.partitionBy(*by.split()).orderBy(*order)
    return rows.withColumn("rank", rank().over(window)).where(F.col("rank") <= most)


def _thresholds(scored: DataFrame, block: Block, k: int) -> np.ndarray:
    """Each item's k-th best score so far (1 where it has fewer): only bounds from there on matter."""
    kth = _ranked(scored.where("score > 0"), "item", [F.desc("score")], k).where(F.col("rank") == k)
    found = {r["item"]: r["score"] for r in kth.select("item", "score").collect()}
    return np.array([found.get(i, 1) for i in block.items.tolist()], np.int64)


def _search_block(sketches: DataFrame, texts: DataFrame, block: Block, p: Lexical) -> DataFrame:
    """(item, d1, d2, score): every text that is among an item's k best, ties included, and some more."""
    spark = sketches.sparkSession
    best = sketches.mapInArrow(_best_bounds(p, block), BOUND_SCHEMA).dropDuplicates(["item", *DIGEST])
    seeds = _ranked(best, "item", [F.desc("bound")], p.k)
    scored = _scored(texts, seeds.select("item", *DIGEST), block, p)
    least = _thresholds(scored, block, p.k)
    candidates = stage(
        sketches.mapInArrow(_bounds_from(p, block, least.astype(np.float32)), BOUND_SCHEMA).dropDuplicates(["item", *DIGEST]),
        "lexical-candidates",
    )
    batch = p.first_batch
    while True:
        limits = spark.createDataFrame(list(zip(block.items.tolist(), least.tolist(), strict=True)), "item long, least long")
        left = candidates.join(F.broadcast(limits), "item").where("bound >= least")
        left = left.join(scored, ["item", *DIGEST], "left_anti")
        following = stage(_ranked(left, "item", [F.desc("bound")], batch).select("item", *DIGEST), "lexical-batch")
        if following.isEmpty():
            return scored
        scored = stage(scored.unionByName(_scored(texts, following, block, p)), "lexical-scores")
        least = _thresholds(scored, block, p.k)
        batch *= 8


def search(documents: DataFrame, items: DataFrame, p: Lexical = Lexical(), index: DataFrame | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0.

    ``index`` is the result of ``lexical_index`` over the same documents; without it one is made.
    """
    index = lexical_index(documents, p) if index is None else index
    sketches = index.where("sketch is not null and n > 0").select("doc_id", *DIGEST, "n", "sketch")
    n, words = sketches.agg(F.count(F.lit(1)), F.sum("n")).first()
    texts = with_digest(documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    queries = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(_item_terms, "item long, item_id long, terms array<long>, tfs array<long>")
    queries = stage(queries.where("size(terms) > 0"), "lexical-items")
    n_terms = queries.agg(F.sum(F.size("terms"))).first()[0]
    result = None
    if n and n_terms:
        blocks = math.ceil(n_terms / p.block_terms)
        counts = index.where("terms is not null").select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        counts = counts.select(F.col("x.terms").alias("term"), F.col("x.counts").alias("count"))
        used = queries.select(F.explode("terms").alias("term")).distinct()
        known = counts.join(used, "term", "left_semi").groupBy("term").agg(F.sum("count").alias("count"))
        known = stage(known, "lexical-frequencies")
        parts = []
        for number in range(blocks):
            own = queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
            rows = own.collect()
            if not rows:
                continue
            terms = own.select(F.explode("terms").alias("term")).distinct()
            frequencies = {r["term"]: r["count"] for r in known.join(terms, "term").collect()}
            block = Block(rows, frequencies, n, words, p.bits)
            parts.append(_search_block(sketches.drop("doc_id"), texts, block, p))
        result = reduce(DataFrame.unionByName, parts)
    if result is None:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    top = stage(_ranked(result.where("score > 0"), "item", [F.desc("score")], p.k, F.rank).drop("rank"), "lexical-top")
    # Of a text's copies only the k smallest ids can be among an item's k.
    ids = sketches.select("doc_id", *DIGEST).join(top.select(*DIGEST).distinct(), [*DIGEST], "left_semi")
    smallest = F.asc_nulls_last("doc_id")
    met = top.join(_ranked(ids, "d1 d2", [smallest], p.k).drop("rank"), [*DIGEST])
    final = _ranked(met, "item", [F.desc("score"), smallest], p.k)
    return final.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
