"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (runs of letters and digits, A-Z lower-cased) are hashed; hashes seen in enough training texts
own an embedding, all others share the zero embedding. Filters of several widths slide over the
embeddings, each keeps its maximum over the whole text, and a logistic layer weighs the maxima. One
coordinate of each embedding starts at the word's log odds in the training texts beyond two standard
errors, the rest near zero.

Every labelled row is learnt from, with its whole text. The rows are dealt by a hash to packs of about
``pack_texts`` rows, written once. In each epoch every pack is descended from the common model, and the
mean of what the packs changed (of an embedding, those that changed it) is the next one; a single pack
is plain descent. Changes are summed as whole numbers, so that no order of tasks shows. Beyond
``most_words`` words the rarer ones share ``shared_places`` embeddings, so that the model stays bounded.

Of each pack, by a hash of the id, three quarters train and one quarter calibrates: the logit is scaled
to it, counted on a grid, and a decision threshold is set for each language. The score depends on the
text alone; the language only picks the threshold of the decision.

Defined results: a null or empty text has the score of a text without known words; without labels
of both classes every score is 0; contradicting labels of an id count as toxic; a language unseen
in calibration, or null, gets the common threshold; equal texts get equal scores; rows without an
id are scored and never learnt from; extra columns are ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .near_dedup import _complete_groups, _group_runs
from .staging import broadcast_if_few, stage
from .words import NOT_ALNUM, slices, text_bytes, word_hashes


@dataclass(frozen=True)
class ToxicityParameters:
    pack_texts: int = 4096
    pack_bytes: int = 16 << 20
    most_words: int = 1 << 20
    shared_places: int = 1 << 18
    least_texts: int = 3
    standard_errors: float = 1.5
    dimensions: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 8
    batch: int = 32
    rate: float = 0.01
    embedding_rate: float = 0.02
    threshold: float = 0.7
    least_calibration: int = 20
    grid: int = 4096
    seed: int = 3


@dataclass
class ToxicityModel:
    """Vocabulary hashes with embeddings, filters and output weights: bounded by the parameters."""

    widths: tuple[int, ...]
    known: np.ndarray
    embeddings: np.ndarray  # row 0 belongs to all unknown words; the last ``shared`` to words by their hash
    filters: list[np.ndarray]  # per width: width x dimensions x filters
    bias: list[np.ndarray]
    output: np.ndarray
    intercept: float
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.7
    shared: int = 0

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        other = np.zeros(len(hashes), np.int64)
        if self.shared:
            other = 1 + len(self.known) + (hashes % np.uint64(self.shared)).astype(np.int64)
        if not len(self.known):
            return other
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == hashes, at + 1, other)

    def pooled(self, hashes: np.ndarray, pointers: np.ndarray) -> np.ndarray:
        """texts x all filters: the maximum of each filter over the text, at least 0.

        Windows without a known word give a filter's bias alone, so only places within reach of a
        known word are computed.
        """
        rows = self.rows_of(hashes)
        n_texts = len(pointers) - 1
        parts = []
        for width, weights, bias in zip(self.widths, self.filters, self.bias, strict=True):
            best = np.tile(np.maximum(bias, 0), (n_texts, 1)).astype(np.float32)
            hit = np.flatnonzero(rows)
            if len(hit):
                places = np.unique(np.concatenate([hit - k for k in range(width)]))
                places = places[places >= 0]
                owner = np.searchsorted(pointers, places, side="right") - 1
                # a window that starts in a text and runs beyond its end meets zero embeddings there
                tables = [self.embeddings @ weights[k] for k in range(width)]
                for at in range(0, len(places), 1 << 16):
                    own, place = owner[at : at + (1 << 16)], places[at : at + (1 << 16)]
                    values = np.tile(bias, (len(place), 1)).astype(np.float32)
                    for k in range(width):
                        inside = place + k < pointers[own + 1]
                        row = np.where(inside, rows[np.minimum(place + k, len(rows) - 1)], 0)
                        values += tables[k][row]
                    change = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    top = np.maximum.reduceat(values, change, axis=0)
                    best[own[change]] = np.maximum(best[own[change]], top)
            parts.append(best)
        return np.concatenate(parts, axis=1)

    def logit(self, hashes: np.ndarray, pointers: np.ndarray) -> np.ndarray:
        return self.pooled(hashes, pointers) @ self.output + self.intercept

    def score_of(self, logits: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * np.clip(logits.astype(float), -30, 30) + self.shift)

    def score(self, hashes: np.ndarray, pointers: np.ndarray) -> np.ndarray:
        return self.score_of(self.logit(hashes, pointers))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class _Adam:
    def __init__(self, arrays: list[np.ndarray], first: list[np.ndarray], second: list[np.ndarray], step: int, rate: float):
        self.arrays, self.first, self.second, self.step, self.rate = arrays, first, second, step, rate

    def apply(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for a, g, m, v in zip(self.arrays, gradients, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


@dataclass
class _Pack:
    """Labelled rows that are descended together; the words of all texts as places in ``used``."""

    y: np.ndarray
    lang: list[str | None]
    lengths: np.ndarray
    used: np.ndarray
    codes: np.ndarray

    @property
    def pointers(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.lengths)])

    @property
    def calibrates(self) -> np.ndarray:
        return np.arange(len(self.y)) % 4 == 3


PACK_SCHEMA = "fits long, toxic long, y binary, lang array<string>, lengths binary, used binary, codes binary"


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        hashes, pointers, _, _ = word_hashes(*text_bytes(batch.column("text")), NOT_ALNUM)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("doc_id", "y", "lang", "pick")],
                pa.array([hashes[a:b].tobytes() for a, b in zip(pointers[:-1], pointers[1:], strict=True)], pa.binary()),
            ],
            ["doc_id", "y", "lang", "pick", "words"],
        )


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _complete_groups(batches, ["pack"]):
        for low, high in _group_runs(table, ["pack"]):
            part = table.slice(low, high - low)
            words = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("words")]
            used, codes = np.unique(np.concatenate(words), return_inverse=True)
            y = part.column("y").to_numpy().astype(np.uint8)
            fits = y[np.arange(len(y)) % 4 != 3]
            binary = [y, np.array([len(x) for x in words], np.int64), used, codes.astype(np.uint32)]
            y, lengths, used, codes = [pa.array([x.tobytes()], pa.binary()) for x in binary]
            columns = [pa.array([len(fits)]), pa.array([int(fits.sum())]), y, pa.array([part.column("lang").to_pylist()], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [*columns, lengths, used, codes], ["fits", "toxic", "y", "lang", "lengths", "used", "codes"]
            )


def _read_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Pack]:
    kinds = {"y": np.uint8, "lengths": np.int64, "used": np.uint64, "codes": np.uint32}
    for batch in batches:
        for row in range(len(batch)):
            columns = {c: np.frombuffer(batch.column(c)[row].as_buffer(), kind) for c, kind in kinds.items()}
            yield _Pack(lang=batch.column("lang")[row].as_py(), **columns)


def _packs(documents: DataFrame, labels: DataFrame, p: ToxicityParameters) -> DataFrame:
    """The labelled rows with words, all of them and whole, dealt to packs, sorted by a hash of the id and written."""
    pick = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = texts.join(broadcast_if_few(labels), "doc_id").where("text is not null")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    number = max(1, -(-size["n"] // p.pack_texts), -(-(size["bytes"] or 0) // p.pack_bytes))
    words = rows.select("doc_id", "y", "lang", pick.alias("pick"), "text").mapInArrow(
        _word_rows, "doc_id long, y int, lang string, pick double, words binary"
    )
    pack = F.pmod(F.xxhash64(F.lit("pack"), "doc_id", "words"), F.lit(number)).alias("pack")
    dealt = words.where("length(words) > 0").select(pack, "y", "lang", "pick", "words")
    dealt = dealt.repartition("pack").sortWithinPartitions("pack", "pick", "words")
    return stage(dealt.mapInArrow(_pack_rows, PACK_SCHEMA), "toxicity-packs")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each word of a pack, the training texts, and the toxic ones, that have it."""
    for pack in _read_packs(batches):
        owner = np.repeat(np.arange(len(pack.y)), pack.lengths)
        fits = ~pack.calibrates[owner]
        owner, code = np.divmod(np.unique(owner[fits] * len(pack.used) + pack.codes[fits]), len(pack.used))
        in_all = np.bincount(code, minlength=len(pack.used))
        in_toxic = np.bincount(code, weights=pack.y[owner], minlength=len(pack.used)).astype(np.int64)
        there = in_all > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[there]) for x in (pack.used.view(np.int64), in_all, in_toxic)], ["word", "n", "n_toxic"]
        )


def _vocabulary(packs: DataFrame, p: ToxicityParameters) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The words with an embedding of their own, the texts and toxic texts of each embedding, and the number of shared ones."""
    counts = packs.mapInArrow(_word_counts, "word long, n long, n_toxic long").groupBy("word")
    counts = stage(counts.agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")), "toxicity-words")
    least, shared, sums = p.least_texts, 0, []
    by_texts = counts.where(F.col("n") >= least).groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy("n").collect()
    left = sum(r["words"] for r in by_texts)
    for r in by_texts:
        if left <= p.most_words:
            break
        left, least, shared = left - r["words"], r["n"] + 1, p.shared_places
    own = counts.where(F.col("n") >= least).toArrow().combine_chunks()
    words, n, n_toxic = (own.column(c).to_numpy() for c in ("word", "n", "n_toxic"))
    words = words.view(np.uint64)
    order = np.argsort(words)
    if shared:  # a word's hash as an unsigned number, modulo the places, which are a power of two
        place = F.col("word").bitwiseAND(F.lit(shared - 1)).alias("place")
        rest = counts.where(F.col("n") < least).groupBy(place).agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        at, *sums = (rest.toArrow().column(c).to_numpy() for c in ("place", "n", "n_toxic"))
        sums = [np.bincount(at, weights=x, minlength=shared).astype(np.int64) for x in sums]
    n, n_toxic = (np.concatenate([x[order], *sums[i : i + 1]]) for i, x in enumerate((n, n_toxic)))
    return words[order], n, n_toxic, shared


def _start(packs: DataFrame, positive: int, total: int, p: ToxicityParameters) -> tuple[ToxicityModel, np.random.Generator]:
    rng = np.random.default_rng(p.seed)
    known, in_all, in_toxic, shared = _vocabulary(packs, p)
    # a shared embedding has the texts of several words, so its numbers may exceed those of all texts
    odds = np.log((in_toxic + 0.5) / (positive + 1)) - np.log((in_all - in_toxic + 0.5) / (total - positive + 1))
    # Odds seen in few texts are mostly chance: what is left after two standard errors counts.
    error = np.sqrt(1 / (in_toxic + 0.5) + 1 / (in_all - in_toxic + 0.5))
    odds = np.sign(odds) * np.maximum(np.abs(odds) - p.standard_errors * error, 0)
    embeddings = rng.normal(0, 0.01, (len(odds) + 1, p.dimensions)).astype(np.float32)
    embeddings[1:, 0] = np.clip(odds, -3, 3)
    embeddings[0] = 0
    filters, bias = [], []
    for width in p.widths:
        f = rng.normal(0, 0.3, (width, p.dimensions, p.filters)).astype(np.float32)
        f[:, 0, : p.filters // 2] = rng.uniform(0.5, 1, (width, p.filters // 2)) / width
        filters.append(f)
        bias.append(np.full(p.filters, -0.5, np.float32))
    output = rng.normal(0, 0.1, len(p.widths) * p.filters).astype(np.float32)
    output.reshape(len(p.widths), p.filters)[:, : p.filters // 2] = 0.5
    return ToxicityModel(p.widths, known, embeddings, filters, bias, output, -0.5, shared=shared), rng


def _peaks(
    x: np.ndarray, rows: np.ndarray, lengths: np.ndarray, filters: list[np.ndarray], bias: list[np.ndarray], limit: int = 1 << 16
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each width: texts x filters, the largest value of a filter in a text and the place in ``rows`` of its
    first window. ``rows`` has, after each text, zeros for the windows that run beyond it."""
    widest = max(len(f) for f in filters)
    starts = np.cumsum(lengths + widest - 1) - (lengths + widest - 1)
    inside = np.ones(len(rows), bool)
    for k in range(widest - 1):
        inside[starts + lengths + k] = False
    windows = np.flatnonzero(inside)
    owners = np.repeat(np.arange(len(lengths)), lengths)
    stacked = np.concatenate([f[k] for f in filters for k in range(len(f))], axis=1)
    found = [
        (np.full((len(lengths), f.shape[2]), -np.inf, np.float32), np.zeros((len(lengths), f.shape[2]), np.int64)) for f in filters
    ]
    for at in range(0, len(windows), limit):
        window, owner = windows[at : at + limit], owners[at : at + limit]
        first, end = window[0], window[-1] + 1
        products = x[rows[first : end + widest - 1]] @ stacked
        opens = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        texts, column = owner[opens], 0
        for f, b, (best, place) in zip(filters, bias, found, strict=True):
            width, number = len(f), f.shape[2]
            value = sum(products[k : k + end - first, column + k * number : column + (k + 1) * number] for k in range(width))
            value = (value + b)[window - first]
            column += width * number
            top = np.maximum.reduceat(value, opens, axis=0)
            hits, which = np.nonzero(value == np.repeat(top, np.diff(np.r_[opens, len(owner)]), axis=0))
            here = np.zeros_like(top, np.int64)
            here[np.searchsorted(opens, hits[::-1], side="right") - 1, which[::-1]] = window[hits[::-1]]  # the first is set last
            better = top > best[texts]
            place[texts] = np.where(better, here, place[texts])
            best[texts] = np.maximum(best[texts], top)
    return found


def _descend(model: ToxicityModel, first: list, second: list, pack: _Pack, epoch: int, rng: np.random.Generator, p: ToxicityParameters):
    """One epoch over the training rows of a pack. Changes of the dense arrays and their moments, then the rows of
    embeddings changed, with their changes."""
    fit = np.flatnonzero(~pack.calibrates)
    pointers, widest = pack.pointers, max(p.widths)
    used = model.rows_of(pack.used)
    own, local = np.unique(np.r_[0, used], return_inverse=True)  # row 0 comes first, and zeros follow each text
    codes = local[1:][pack.codes]
    x = model.embeddings[own]
    filters, bias = [f.copy() for f in model.filters], [b.copy() for b in model.bias]
    output, intercept = model.output.copy(), np.array([model.intercept], np.float32)
    first, second = ([a.copy() for a in moments] for moments in (first, second))
    dense = [*filters, *bias, output, intercept]
    adam = _Adam(dense, first, second, epoch * -(-len(fit) // p.batch), p.rate)
    before = [a.copy() for a in [*dense, *first, *second]]
    rng, order = copy.deepcopy(rng), np.arange(len(fit))
    for _ in range(epoch + 1):
        rng.shuffle(order)
    for at in range(0, len(order), p.batch):
        chosen = fit[order[at : at + p.batch]]
        lengths = pack.lengths[chosen]
        rows = np.concatenate([np.r_[codes[pointers[i] : pointers[i + 1]], np.zeros(widest - 1, np.int64)] for i in chosen.tolist()])
        peaks = _peaks(x, rows, lengths, filters, bias)
        pooled = np.concatenate([np.maximum(best, 0) for best, _ in peaks], axis=1)
        delta = ((_sigmoid(pooled @ output + intercept[0]) - pack.y[chosen]) / p.batch).astype(np.float32)
        back = delta[:, None] * output * (pooled > 0)
        grads, touched = [], []
        for w, (f, (_, place)) in enumerate(zip(filters, peaks, strict=True)):
            g, grad = back[:, w * p.filters : (w + 1) * p.filters], np.empty_like(f)
            for k in range(len(f)):
                seen = rows[place + k]
                grad[k] = np.einsum("tfd,tf->df", x[seen], g)
                touched.append((seen, f[k].T * g[:, :, None]))
            grads.append(grad)
        grads += [back[:, w * p.filters : (w + 1) * p.filters].sum(axis=0) for w in range(len(filters))]
        adam.apply([*grads, delta @ pooled, delta.sum(keepdims=True)])
        for seen, gradient in touched:  # plain descent: each step touches few embeddings
            np.add.at(x, seen, -p.embedding_rate * gradient)
        x[0] = 0
    changes = [a - b for a, b in zip([*dense, *first, *second], before, strict=True)]
    moved = np.flatnonzero((x != model.embeddings[own]).any(axis=1))
    return np.concatenate([c.ravel() for c in changes]), own[moved], x[moved] - model.embeddings[own[moved]]


#: Changes are summed as multiples of these, which no order of additions alters.
DENSE_UNIT, EMBEDDING_UNIT = 2.0**-40, 2.0**-32
CHANGE_SCHEMA = "chunk int, rows binary, sums binary, packs binary"
CHUNKS = 64


def _added(rows: np.ndarray, sums: np.ndarray, packs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0])
    return rows[order][starts], np.add.reduceat(sums[order], starts, axis=0), np.add.reduceat(packs[order], starts)


def _change_rows(chunk: int, parts: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    packed = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *packed], ["chunk", "rows", "sums", "packs"])


def _epoch(model: ToxicityModel, first: list, second: list, epoch: int, rng: np.random.Generator, p: ToxicityParameters):
    """The changes that a task's packs make, summed: chunk -1 has the dense arrays, the others embeddings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = None, []
        for pack in _read_packs(batches):
            if len(pack.y):
                dense, rows, moved = _descend(model, first, second, pack, epoch, rng, p)
                dense = np.rint(dense / DENSE_UNIT).astype(np.int64)
                total = (dense, 1) if total is None else (total[0] + dense, total[1] + 1)
                if len(rows):
                    held.append((rows, np.rint(moved / EMBEDDING_UNIT).astype(np.int64), np.ones(len(rows), np.int64)))
                if len(held) == 8:
                    held = [_added(*map(np.concatenate, zip(*held, strict=True)))]
        if total is not None:
            yield _change_rows(-1, (np.zeros(1, np.int64), total[0], np.array([total[1]])))
        if held:
            parts = _added(*map(np.concatenate, zip(*held, strict=True)))
            for chunk in range(CHUNKS):
                own = parts[0] % CHUNKS == chunk
                if own.any():
                    yield _change_rows(chunk, tuple(x[own] for x in parts))

    return run


def _summed(width: int):
    """The changes of all tasks, one row for each chunk; ``width`` is that of an embedding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for chunk, *packed in zip(*[batch.column(c).to_pylist() for c in ("chunk", "rows", "sums", "packs")], strict=True):
                rows, sums, packs = (np.frombuffer(x, np.int64) for x in packed)
                new = (rows, sums.reshape(len(rows), -1 if chunk < 0 else width), packs)
                held[chunk] = _added(*map(np.concatenate, zip(held[chunk], new, strict=True))) if chunk in held else new
        for chunk, parts in held.items():
            yield _change_rows(chunk, parts)

    return run


def _fit(packs: DataFrame, positive: int, total: int, p: ToxicityParameters) -> ToxicityModel:
    model, rng = _start(packs, positive, total, p)
    dense = [*model.filters, *model.bias, model.output, np.array([model.intercept], np.float32)]
    first, second = [np.zeros_like(a) for a in dense], [np.zeros_like(a) for a in dense]
    for epoch in range(p.epochs):
        changes = packs.mapInArrow(_epoch(model, first, second, epoch, rng, p), CHANGE_SCHEMA)
        changes = changes.repartition("chunk").mapInArrow(_summed(p.dimensions), CHANGE_SCHEMA)
        for chunk, *packed in changes.collect():
            rows, sums, n_packs = (np.frombuffer(bytes(x), np.int64) for x in packed)
            if chunk >= 0:
                mean = sums.reshape(len(rows), -1) * EMBEDDING_UNIT / n_packs[:, None]
                model.embeddings[rows] += mean.astype(np.float32)
                continue
            at = 0
            for a in [*dense, *first, *second]:
                mean = sums[at : at + a.size] * DENSE_UNIT / n_packs[0]
                a += mean.reshape(a.shape).astype(np.float32)
                at += a.size
        model.intercept = float(dense[-1][0])
    return model


def _logits(model: ToxicityModel, p: ToxicityParameters):
    """Language, label and logit, on the grid, of the rows that calibrate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in _read_packs(batches):
            pointers, places = pack.pointers, []
            rest = np.flatnonzero(pack.calibrates)
            for at in range(0, len(rest), p.batch):
                own = rest[at : at + p.batch]
                words = np.concatenate([pack.codes[pointers[i] : pointers[i + 1]] for i in own.tolist()])
                z = model.logit(pack.used[words], np.concatenate([[0], np.cumsum(pack.lengths[own])]))
                places.append(np.rint(np.clip(z.astype(float), -30, 30) * p.grid).astype(np.int64))
            if places:
                langs = pa.array([pack.lang[i] for i in rest.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(pack.y[rest].astype(np.int32)), pa.array(np.concatenate(places))], ["lang", "y", "place"]
                )

    return run


def _calibrate(model: ToxicityModel, z: np.ndarray, y: np.ndarray, n: np.ndarray, lang: np.ndarray, p: ToxicityParameters) -> None:
    """Scale the logits, of ``n`` rows each, by Platt's method, then the threshold of each language with the fewest
    errors, nearest to the common one."""
    positive, negative = n[y == 1].sum(), n[y == 0].sum()
    goal = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))

    def loss(line: np.ndarray) -> float:  # a weak pull of the slope to 1 keeps separable samples finite
        t = line[0] * z + line[1]
        return float((n * (np.logaddexp(0, t) - goal * t)).sum() + 0.5 * (line[0] - 1) ** 2)

    line, design = np.array([1.0, 0.0]), np.stack([z, np.ones_like(z)])
    for _ in range(50):
        q = _sigmoid(line @ design)
        curve = (design * (n * q * (1 - q))) @ design.T + np.diag([1.0, 1e-3])
        step = np.linalg.solve(curve, design @ (n * (q - goal)) + np.array([line[0] - 1, 0.0]))
        while loss(line - step) > loss(line) and np.abs(step).max() > 1e-9:
            step /= 2
        line = line - step
    a, b = max(0.05, float(line[0])), float(line[1])
    model.slope, model.shift, model.threshold = a, b, p.threshold
    scores = model.score_of(z)
    choices = np.linspace(0.5, 0.9, 81)
    for name in {x for x in lang if x is not None}:
        own = lang == name
        if n[own].sum() < p.least_calibration or y[own].min() == y[own].max():
            continue
        errors = np.array([n[own][(scores[own] >= c) != (y[own] == 1)].sum() for c in choices])
        best = choices[errors == errors.min()]
        model.thresholds[name] = float(best[np.abs(best - p.threshold).argmin()])


def train(documents: DataFrame, labels: DataFrame, p: ToxicityParameters = ToxicityParameters()) -> ToxicityModel | None:
    """From ``documents`` and (doc_id, y), every row of them; None without rows of both classes."""
    labels = stage(labels.where(F.col("y").isin(0, 1)).select("doc_id", "y"), "toxicity-labels")
    if labels.select("y").distinct().count() < 2:
        return None
    packs = _packs(documents, labels, p)
    total, positive = packs.agg(F.sum("fits"), F.sum("toxic")).first()
    if not total or positive in (0, total):
        return None
    model = _fit(packs, positive, total, p)
    found = packs.mapInArrow(_logits(model, p), "lang string, y int, place long").groupBy("lang", "y", "place").count()
    rows = found.orderBy("lang", "y", "place").collect()
    if rows:
        y, n = (np.array([r[c] for r in rows], float) for c in ("y", "count"))
        z, lang = np.array([r["place"] for r in rows]) / p.grid, np.array([r["lang"] for r in rows], object)
        _calibrate(model, z, y, n, lang, p)
    return model


def _score_rows(model: ToxicityModel, text_at: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, pointers, _, _ = word_hashes(*text_bytes(batch.column(text_at)), NOT_ALNUM)
            scores = model.score(hashes, pointers)
            limits = [model.thresholds.get(x, model.threshold) for x in batch.column("lang").to_pylist()]
            if keep_text:
                kept = pa.array(scores < np.array(limits))
                yield batch.filter(kept)
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(scores), pa.array(limits, pa.float64())],
                    ["doc_id", "score", "threshold"],
                )

    return run


def toxicity_scores(
    documents: DataFrame, labels: DataFrame, p: ToxicityParameters = ToxicityParameters()
) -> DataFrame:
    """(doc_id, score, threshold, toxic) of every row; ``labels``: (doc_id, y) of the rows to learn from."""
    model = train(documents, labels, p)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    if model is None:
        return rows.select(
            "doc_id", F.lit(0.0).alias("score"), F.lit(p.threshold).alias("threshold"), F.lit(False).alias("toxic")
        )
    found = rows.mapInArrow(_score_rows(model, 1, False), "doc_id long, score double, threshold double")
    return found.withColumn("toxic", F.col("score") >= F.col("threshold"))


def drop_toxic(documents: DataFrame, labels: DataFrame, p: ToxicityParameters = ToxicityParameters()) -> DataFrame:
    """``documents`` without the rows whose score reaches the threshold of their language."""
    model = train(documents, labels, p)
    if model is None:
        return documents
    return documents.mapInArrow(_score_rows(model, documents.columns.index("text"), True), documents.schema)
