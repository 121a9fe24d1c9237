"""Benchmark decontamination by greedy string tiling.

Runs of ``seed`` words of documents and benchmark items meet in a join. For each document and item
that share seeds, the longest common run of words not yet marked is found by running Karp-Rabin
over ever shorter lengths, marked on both sides, and so on: the tiles. The part of the item under
tiles decides, so passages whose parts were moved around are caught too.

Before the join a fixed-size bitmap of the benchmark's seeds drops most document seeds; what it
lets through by chance finds no partner. Its size does not grow with either side.

Words are runs of letters and digits; each character of a script written without spaces is one. An item
of fewer words than a seed is its own seed: the whole of it in a row is looked for, and found or not.

Defined results: a null or empty text shares nothing; an item of fewer than ``shortest`` words is met by
chance anywhere and is never reported; equal documents are reported each; repeated item ids are told apart
by their text; a document without an id is reported with a null id; of several longest common runs the
first in the document, then in the item, is marked; a text of any length is read whole, in pieces; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage
from .words import NOT_ALNUM, mix, slices, text_bytes, window_hashes, word_hashes

BITMAP_BITS = 24


@dataclass(frozen=True)
class Tiling:
    """``seed``: the shortest tile, in words. ``coverage``: the part of an item's words under tiles
    from which on a document counts as contaminated. ``shortest``: the shortest item that is looked for."""

    seed: int = 5
    shortest: int = 3
    coverage: float = 0.5


def _whole_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words, apart from those of seeds: items shorter than a seed."""
    return mix(window_hashes(words, size), size)


def _keep_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _runs_of(words: np.ndarray, pointers: np.ndarray, hashes: np.ndarray, size: int):
    """(text, hash, place) of the runs of ``size`` words that lie within one text."""
    place = np.arange(len(hashes))
    text_of = np.repeat(np.arange(len(pointers) - 1), np.diff(pointers))[: len(hashes)]
    valid = place + size <= pointers[1:][text_of]
    return text_of[valid], hashes[valid], place[valid]


def _seed_lists(p: Tiling, bitmap: np.ndarray | None, short: tuple[int, ...] = ()):
    """Rows (key, n_words, seed hash, positions) of each text. Documents come with the bitmap, give only set
    bits, and also give their runs of the ``short`` sizes; an item shorter than a seed gives the whole of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            words, pointers, _, _ = word_hashes(data, offsets, NOT_ALNUM, split_unspaced=True)
            lengths = np.diff(pointers)
            parts = [_runs_of(words, pointers, window_hashes(words, p.seed), p.seed)]
            for size in range(p.shortest, p.seed) if bitmap is None else short:
                text, value, at = _runs_of(words, pointers, _whole_hashes(words, size), size)
                own = lengths[text] == size if bitmap is None else slice(None)
                parts.append((text[own], value[own], at[own]))
            text_of, hashes, place = (np.concatenate([part[i] for part in parts]) for i in range(3))
            if bitmap is not None:
                kept = _keep_set(bitmap, hashes)
                text_of, hashes, place = text_of[kept], hashes[kept], place[kept]
            if not len(place):
                continue
            order = np.lexsort((place, hashes, text_of))
            text_of, hashes, place = text_of[order], hashes[order], place[order]
            new = np.r_[True, (text_of[1:] != text_of[:-1]) | (hashes[1:] != hashes[:-1])]
            first = np.flatnonzero(new)
            own = text_of[first]
            digest = mix(np.add.reduceat(np.r_[mix(words, 5), np.uint64(0)], np.minimum(pointers[:-1], len(words))), 6)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(own)),
                    pa.array(digest[own].view(np.int64)),
                    pa.array(lengths[own]),
                    pa.array(hashes[first].view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.r_[first, len(place)].astype(np.int32)), pa.array(place - pointers[text_of])
                    ),
                ],
                ["id", "digest", "n_words", "seed", "places"],
            )

    return run


SEED_ROWS = "id {}, digest long, n_words long, seed long, places array<long>"


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for batch in batches:
        bit = batch.column("seed").to_numpy().view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
        np.bitwise_or.at(bitmap, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
    yield pa.RecordBatch.from_arrays([pa.array([bitmap.tobytes()], pa.binary())], ["bitmap"])


def seed_bitmap(seeds: DataFrame, tasks: int = 8) -> np.ndarray:
    """2 MB with a bit for each seed, joined from the bitmaps of ``tasks`` tasks."""
    rows = seeds.select("seed").distinct().repartition(tasks).mapInArrow(_bitmaps, "bitmap binary").collect()
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in rows:
        bitmap |= np.frombuffer(bytes(row.bitmap), np.uint8)
    return bitmap


def _runs(seeds: np.ndarray, free: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of all unmarked runs of ``length`` words: (hash, place).

    A run of words is a run of length - seed + 1 seeds, each of them known and each word free.
    """
    n = length - seed + 1
    hashes = window_hashes(seeds, n)
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    known = np.r_[0, np.cumsum(seeds == 0)]
    taken = np.r_[0, np.cumsum(~free)]
    place = np.arange(len(hashes))
    good = (known[place + n] == known[place]) & (taken[place + length] == taken[place])
    return hashes[good], place[good]


def _laid_out(hashes: np.ndarray, places: list[np.ndarray], n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    for value, at in zip(hashes, places, strict=True):
        out[at] = value
    return out


def tiles(doc: np.ndarray, item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """(document place, item place, words) of the greedy tiles, longest first, ties by place.

    ``doc`` and ``item`` hold the seed hash at each place where a shared seed starts, else 0; the
    document's places may leave out stretches without seeds.
    """
    doc_free, item_free = np.ones(len(doc) + seed - 1, bool), np.ones(len(item) + seed - 1, bool)
    found: list[tuple[int, int, int]] = []
    longest = min(len(doc), len(item)) + seed - 1
    while longest >= seed:
        low, high, hit = seed, longest, None  # a common run of some length holds shorter ones
        while low <= high:
            middle = (low + high + 1) // 2
            h_item, p_item = _runs(item, item_free, middle, seed)
            h_doc, p_doc = _runs(doc, doc_free, middle, seed)
            common = np.isin(h_doc, h_item)
            if common.any():
                hit, low = (middle, h_doc[common], p_doc[common], h_item, p_item), middle + 1
            else:
                high = middle - 1
        if hit is None:
            break
        longest, h_doc, p_doc, h_item, p_item = hit
        by_hash: dict[int, list[int]] = {}
        for value, place in zip(h_item.tolist(), p_item.tolist(), strict=True):
            by_hash.setdefault(value, []).append(place)
        for value, place in zip(h_doc.tolist(), p_doc.tolist(), strict=True):
            if not doc_free[place : place + longest].all():
                continue
            for other in by_hash[value]:
                if item_free[other : other + longest].all():
                    doc_free[place : place + longest] = False
                    item_free[other : other + longest] = False
                    found.append((place, other, longest))
                    break
    return found


def _compact(rows: list[dict], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that matter: stretches covered by seeds, with a gap between stretches; returns the new
    place of each old one by position in the sorted list of used places."""
    used = np.unique(np.concatenate([np.asarray(r["doc_places"]) for r in rows]))
    gaps = np.minimum(np.diff(used), seed + 1)
    return used, np.r_[0, np.cumsum(gaps)]


def _tile_rows(p: Tiling, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "item_words", "matched_words", "tiles")}
            for row in batch.to_pylist():
                shared, words = row["shared"], row["item_words"]
                if words < p.seed:  # its one seed is the whole of it
                    whole = {"doc_word": min(shared[0]["doc_places"]), "item_word": 0, "words": words}
                    for name, value in zip(out, (row["doc_id"], row["item_id"], words, words, [whole]), strict=True):
                        out[name].append(value)
                    continue
                hashes = np.array([s["seed"] for s in shared], np.int64).view(np.uint64)
                item_places = [np.asarray(s["item_places"]) for s in shared]
                item = _laid_out(hashes, item_places, words - p.seed + 1)
                covered = np.zeros(words + 1, np.int64)
                starts = np.flatnonzero(item)
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + p.seed, -1)
                if (np.cumsum(covered)[:-1] > 0).sum() < p.coverage * words:
                    continue  # tiles lie under shared seeds only
                used, short = _compact(shared, p.seed)
                doc_places = [short[np.searchsorted(used, s["doc_places"])] for s in shared]
                found = tiles(_laid_out(hashes, doc_places, int(short[-1]) + 1), item, p.seed)
                matched = sum(t[2] for t in found)
                if matched >= p.coverage * words:
                    out["doc_id"].append(row["doc_id"])
                    out["item_id"].append(row["item_id"])
                    out["item_words"].append(words)
                    out["matched_words"].append(matched)
                    out["tiles"].append(
                        [
                            {"doc_word": int(used[np.searchsorted(short, d, side="right") - 1]), "item_word": i, "words": n}
                            for d, i, n in found
                        ]
                    )
            if out["doc_id"]:
                tile = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))
                types = [id_type] + [pa.int64()] * 3 + [tile]
                arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, list(out))

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, p: Tiling = Tiling()) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, item_words, matched_words,
    coverage, and the tiles (first word in the document and in the item, words)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return _contaminated(docs, "long", benchmark, p)


def text_key(text: str) -> Column:
    """What tells texts apart, whatever their ids; null without a text."""
    return F.sha2(F.col(text).cast("string"), 256)


def contaminated_texts(documents: DataFrame, benchmark: DataFrame, p: Tiling = Tiling()) -> DataFrame:
    """The ``text_key`` of each contaminated text, once."""
    docs = documents.select(text_key("text").alias("id"), F.col("text").cast("string").alias("text"))
    return _contaminated(docs, "string", benchmark, p).select(F.col("doc_id").alias("text_key")).distinct()


def _contaminated(docs: DataFrame, id_type: str, benchmark: DataFrame, p: Tiling) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    item_seeds = stage(items.mapInArrow(_seed_lists(p, None), SEED_ROWS.format("long")).distinct(), "bench-seeds")
    bitmap = seed_bitmap(item_seeds)
    short = item_seeds.where(F.col("n_words") < p.seed).select("n_words").distinct().collect()  # at most seed - 1 rows
    sizes = tuple(sorted(r["n_words"] for r in short))
    doc_seeds = docs.mapInArrow(_seed_lists(p, bitmap, sizes), SEED_ROWS.format(id_type))
    shared = doc_seeds.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("doc_digest"), "seed", F.col("places").alias("doc_places")
    ).join(
        item_seeds.select(
            F.col("id").alias("item_id"),
            F.col("digest").alias("item_digest"),
            F.col("n_words").alias("item_words"),
            "seed",
            F.col("places").alias("item_places"),
        ),
        "seed",
    )
    # Equal rows of one id would repeat each other's seeds: once is enough, the result is per id.
    pairs = shared.groupBy("doc_id", "doc_digest", "item_id", "item_digest", "item_words").agg(
        F.collect_set(F.struct("seed", "doc_places", "item_places")).alias("shared")
    )
    schema = (
        f"doc_id {id_type}, item_id long, item_words long, matched_words long, "
        "tiles array<struct<doc_word: long, item_word: long, words: long>>"
    )
    found = pairs.select("doc_id", "item_id", "item_words", "shared").mapInArrow(
        _tile_rows(p, pa.string() if id_type == "string" else pa.int64()), schema
    )
    return found.select(
        "doc_id",
        "item_id",
        "item_words",
        "matched_words",
        (F.col("matched_words") / F.col("item_words")).alias("coverage"),
        "tiles",
    )
