"""Vectorised word hashing over Arrow string columns.

The bytes of a batch are hashed with running sums, so no Python string is made. Work goes in
pieces cut at separators: memory does not grow with the length of a text beyond its own words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_rng = np.random.default_rng(20240229)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
WINDOW_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

# The white space of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Everything in ASCII but letters and digits, for words without punctuation
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = True
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    NOT_ALNUM[_low:_high] = False


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_tables: dict[str, np.ndarray] = {}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, PIECE + 4096)
        up = _powers(int(WORD_BASE), size)
        down = _powers(pow(int(WORD_BASE), -1, 1 << 64), size)
        if size > 4 * PIECE:  # a single huge word: not kept
            return up, down
        _tables.update(up=up, down=down)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalise 64-bit hashes (the public splitmix64 constants)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; missing texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _piece_words(data: np.ndarray, breaks: np.ndarray, separators: np.ndarray):
    """Hash, start and end of each word of a piece; ``breaks`` are text starts inside it."""
    inside = ~separators[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(data))]
    if len(breaks):
        opens[breaks] = inside[breaks]
        closes[breaks - 1] = inside[breaks - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _tables_for(len(data))
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(BYTE_VALUE[LOWER[data]] * up[: len(data)], dtype=np.uint64, out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts, ends


def unspaced(data: np.ndarray) -> np.ndarray:
    """Starts and ends of the characters of scripts written without spaces, in UTF-8 bytes: kana and Han
    (U+3040 to U+9FFF, and those from U+20000 on), Thai and Lao, Myanmar, Khmer."""
    if len(data) < 3 or data.max() < 0xE0:
        return np.zeros(0, np.int64)
    lead, second = data[:-2], data[1:-1]
    han = ((lead == 0xE3) & (second >= 0x81)) | ((lead >= 0xE4) & (lead <= 0xE9))
    thai = (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    khmer = (lead == 0xE1) & np.isin(second, [0x80, 0x81, 0x9E, 0x9F])
    three = np.flatnonzero(han | thai | khmer)
    four = np.flatnonzero((lead == 0xF0) & (second >= 0xA0) & (second <= 0xB3))
    return np.unique(np.concatenate([three, three + 3, four, four + 4]))


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, split_unspaced: bool = False):
    """Hashes of the A-Z lower-cased words of all texts, with ``pointers``: text i owns
    ``hashes[pointers[i]:pointers[i + 1]]``. Also returns each word's start and end byte. With
    ``split_unspaced`` each character of a script without spaces is a word."""
    parts, at, n = [], 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        while end < n:  # move the cut to a separator or to the start of a text
            gap = np.flatnonzero(separators[data[end : end + 4096]])
            nxt = offsets[np.searchsorted(offsets, end)]
            cut = min(end + gap[0] if len(gap) else n, nxt)
            if cut <= end + 4096:
                end = int(cut)
                break
            end = min(n, end + 4096)
        low, high = np.searchsorted(offsets, [at, end])
        breaks = offsets[low:high] - at
        if split_unspaced:
            breaks = np.concatenate([breaks, unspaced(data[at:end])])
        hashes, starts, ends = _piece_words(data[at:end], breaks, separators)
        parts.append((hashes, starts + at, ends + at))
        at = end
    if not parts:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), empty, empty
    hashes, starts, ends = (np.concatenate([p[i] for p in parts]) for i in range(3))
    return hashes, np.searchsorted(starts, offsets), starts, ends


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; the run starting at word i is at place i."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * WINDOW_BASE + words[i : i + n]
    return mix(out)


def shingle_sets(words: np.ndarray, pointers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted shingles of each text, and their pointers. A text of fewer words than
    ``size`` gives its whole sequence as one shingle, a text without words none."""
    windows = window_hashes(words, size)
    sets = []
    for low, high in zip(pointers[:-1].tolist(), pointers[1:].tolist(), strict=True):
        if high - low >= size:
            run = np.sort(windows[low : high - size + 1])
            keep = np.empty(len(run), bool)
            keep[0] = True
            np.not_equal(run[1:], run[:-1], out=keep[1:])
            sets.append(run[keep])
        elif high > low:
            value = np.uint64(high - low)
            with np.errstate(over="ignore"):
                for word in words[low:high]:
                    value = value * WINDOW_BASE + word
            sets.append(mix(np.array([value], np.uint64), 3))
        else:
            sets.append(np.zeros(0, np.uint64))
    lengths = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of at most ``limit`` bytes of text (a longer text stands alone)."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        at, rows = 0, len(offsets) - 1
        while at < rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(rows, max(at + 1, end))
            yield batch.slice(at, end - at)
            at = end


def reduce_by(op: np.ufunc, values: np.ndarray, pointers: np.ndarray, empty) -> np.ndarray:
    """``op.reduceat`` over the runs of ``pointers``; empty runs give ``empty``."""
    shape = (len(pointers) - 1, *values.shape[1:])
    out = np.full(shape, empty, dtype=values.dtype)
    filled = np.flatnonzero(pointers[1:] > pointers[:-1])
    if len(filled):
        out[filled] = op.reduceat(values, pointers[:-1][filled], axis=0)
    return out
