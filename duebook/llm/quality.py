"""Quality scores: random Fourier features of document statistics, ridge regression from summed
normal equations, isotonic calibration.

One pass over the texts computes the statistics; training and scoring work on those narrow rows.
Each task sums its own normal equations, tasks are summed in groups, and only ``SUM_GROUPS``
matrices of fixed size reach the driver. All labelled rows outside the held-out fold are used: four
fifths for the regression, one fifth for the calibration, told apart by a hash of the id.

Defined results: a null text counts as empty and has all statistics 0; without usable labels of
both classes every score is 0.5; contradicting labels of an id count as the larger one; equal texts
get equal scores; rows without an id are scored and never learnt from; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage
from .words import LOWER, SPACE, reduce_by, slices, text_bytes, word_hashes

STATISTICS = (
    "log_words", "word_length", "upper", "digit", "symbol", "exclaim", "pipe", "punctuation", "space", "beyond_ascii",
    "distinct_words", "repeated_next", "log_lines", "distinct_lines", "line_words", "odd_words",
)
SUM_GROUPS = 8
BINS = 512


def _class_table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in chars]] = 1
    return out


UPPER = _class_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = _class_table("0123456789")
SYMBOLS = _class_table("#$%&*+/<=>@\\^_`{}~")
EXCLAIM = _class_table("!")
PIPE = _class_table("|")
PUNCTUATION = _class_table(",.;:?'\"()-")
SPACES = _class_table(" \t\n\r\x0b\x0c")
HIGH = np.r_[np.zeros(128, np.int64), np.ones(128, np.int64)]
ODD = SYMBOLS + EXCLAIM + PIPE + DIGITS
LINE_BREAK = np.zeros(256, bool)
LINE_BREAK[10] = True


def _distinct(hashes: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    return np.array(
        [len(np.unique(hashes[a:b])) for a, b in zip(pointers[:-1].tolist(), pointers[1:].tolist(), strict=True)], float
    )


def statistics(column: pa.Array) -> np.ndarray:
    """texts x STATISTICS; an empty text is a row of zeros."""
    data, offsets = text_bytes(column)
    n_bytes = np.maximum(np.diff(offsets), 1).astype(float)

    def share(table: np.ndarray) -> np.ndarray:
        return reduce_by(np.add, table[data], offsets, 0) / n_bytes

    words, pointers, starts, ends = word_hashes(data, offsets, SPACE)
    n_words = np.diff(pointers).astype(float)
    some = np.maximum(n_words, 1)
    lines, line_pointers, _, _ = word_hashes(data, offsets, LINE_BREAK)
    n_lines = np.diff(line_pointers).astype(float)
    same = np.zeros(len(words), np.int64)
    same[1:] = words[1:] == words[:-1]
    inner = pointers[:-1][pointers[:-1] < len(words)]
    same[inner] = 0
    odd_bytes = np.r_[0, np.cumsum(ODD[data])]
    odd = (odd_bytes[ends] > odd_bytes[starts]).astype(np.int64)
    upper = share(UPPER) / np.maximum(1e-9, 1 - share(SPACES))
    return np.stack(
        [
            np.log1p(n_words),
            reduce_by(np.add, ends - starts, pointers, 0) / some,
            np.minimum(upper, 1),
            share(DIGITS),
            share(SYMBOLS),
            share(EXCLAIM),
            share(PIPE),
            share(PUNCTUATION),
            share(SPACES),
            share(HIGH),
            _distinct(words, pointers) / some,
            reduce_by(np.add, same, pointers, 0) / some,
            np.log1p(n_lines),
            _distinct(lines, line_pointers) / np.maximum(n_lines, 1),
            np.log1p(n_words / np.maximum(n_lines, 1)),
            reduce_by(np.add, odd, pointers, 0) / some,
        ],
        axis=1,
    )


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        values = statistics(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(values[:, i]) for i in range(len(STATISTICS))]], ["doc_id", *STATISTICS]
        )


@dataclass(frozen=True)
class QualityParameters:
    features: int = 256
    width: float = 4.0  # of the Gaussian kernel, in standard deviations of a statistic
    ridge: float = 1e-3  # per training row
    seed: int = 17


@dataclass
class QualityModel:
    """Everything a task needs: a few hundred KB, whatever the input's size."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1).astype(float)


def _normal_equations(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(model.phases) + 1
        total, any_row = np.zeros((d, d + 1)), False
        for batch in batches:
            f = model.features(_matrix(batch))
            total[:, :d] += f.T @ f
            total[:, d] += f.T @ batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            any_row = any_row or len(batch) > 0
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for value in batch.column("sums"):
            part = np.frombuffer(value.as_py(), float)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def pool_adjacent(levels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest non-decreasing sequence, by weight."""
    blocks: list[list[float]] = []
    for level, weight in zip(levels.tolist(), weights.tolist(), strict=True):
        blocks.append([level, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            w = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _scored(model: QualityModel, raw: bool, extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch)
            out = model.raw(values) if raw else model.score(values)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in extra], pa.array(out)], [*extra, "score"])

    return run


def train(labelled: DataFrame, p: QualityParameters = QualityParameters()) -> QualityModel | None:
    """From the statistics and ``y`` (0 or 1) of labelled rows; None without rows of both classes."""
    calibration = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(5)) == 0
    rows = labelled.withColumn("calibrates", calibration)
    moments = (
        rows.where("not calibrates")
        .agg(
            *[F.avg(c).alias(f"m_{c}") for c in STATISTICS],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in STATISTICS],
            F.count(F.lit(1)).alias("n"),
            F.sum("y").alias("positives"),
        )
        .first()
    )
    if not moments["n"] or moments["positives"] in (0, moments["n"]):
        return None
    rng = np.random.default_rng(p.seed)
    model = QualityModel(
        np.array([moments[f"m_{c}"] for c in STATISTICS]),
        np.array([max(moments[f"s_{c}"], 1e-6) for c in STATISTICS]),
        rng.normal(0, 1 / p.width, (len(STATISTICS), p.features)),
        rng.uniform(0, 2 * np.pi, p.features),
        np.zeros(p.features + 1),
        np.zeros(1),
        np.zeros(1),
    )
    parts = rows.where("not calibrates").mapInArrow(_normal_equations(model), "sums binary")
    sums = parts.repartition(SUM_GROUPS).mapInArrow(_add_up, "sums binary").collect()
    d = p.features + 1
    total = sum(np.frombuffer(bytes(s.sums), float) for s in sums).reshape(d, d + 1)
    model.weights = np.linalg.solve(total[:, :d] + p.ridge * moments["n"] / d * np.eye(d), total[:, d])

    low, step = -0.5, 2 / BINS
    raw = rows.where("calibrates").mapInArrow(_scored(model, True, ["y"]), "y int, score double")
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") - low) / step).cast("int")))
    bins = raw.groupBy(place.alias("bin")).agg(F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    if bins:
        at = np.array([b["bin"] for b in bins])
        n = np.array([b["n"] for b in bins], float)
        model.knots = low + (at + 0.5) * step
        model.levels = pool_adjacent(np.array([b["ones"] for b in bins]) / n, n)
    else:
        model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def document_statistics(documents: DataFrame) -> DataFrame:
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_statistics_rows, "doc_id long, " + ", ".join(f"{c} double" for c in STATISTICS))


def quality_scores(documents: DataFrame, labels: DataFrame, p: QualityParameters = QualityParameters()) -> DataFrame:
    """(doc_id, score) of every row; ``labels``: (doc_id, y) of the rows to learn from."""
    rows = stage(document_statistics(documents), "quality-statistics")
    labelled = stage(rows.join(labels.select("doc_id", "y"), "doc_id"), "quality-labelled")
    model = train(labelled, p)
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    return rows.mapInArrow(_scored(model, False, ["doc_id"]), "doc_id long, score double")
