"""Language by a string kernel: blended-spectrum presence kernel, Nystroem landmarks, one-versus-rest
kernel ridge regression.

A piece of a text is the set of its byte n-grams of 1 to ``longest`` bytes (A-Z lower-cased), hashed to
a fixed number of places. The kernel of two pieces is the number of shared n-grams over the geometric
mean of their set sizes; that of two texts is the mean over all pairs of their pieces, equal parts of at
most ``PIECE_BYTES``, so that places do not fill up however long a text is. Pieces are scored by two
matrix products: presence times landmarks, then kernel values times coefficients.

The model is fitted on a bounded sample of every language, however many there are: about ``per_language``
texts of each, fewer where there are more than ``sample / per_language`` languages but never under
``least``, chosen by a hash of id and text. No step sorts or gathers whole texts: those of the sample are
written where they are found, and their keys are ordered. Landmarks grow with the languages, in turn from
each. What reaches the driver is 64 KB for each landmark and a kernel value for each text and landmark:
at 70 languages 18 MB and 24 MB.

Defined results: a null or letterless text is ``und`` with score 0; without any labelled text, or with an
empty table, nothing is learnt and all are ``und``; rows without a language are scored and never learnt
from; equal texts get equal results, and copies of a sampled row add nothing; score ties go to the first
language in code point order; a text of any length is scored whole, piece by piece; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage
from .words import LOWER, slices, text_bytes

PLACES = 1 << 14
PIECE_BYTES = 1 << 12
BLOCK = 256  # pieces at a time
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageParameters:
    per_language: int = 300
    sample: int = 30_000
    least: int = 24
    landmarks: int = 96
    landmarks_per_language: int = 4
    longest: int = 4
    ridge: float = 1e-3
    seed: int = 5


def presence(data: np.ndarray, offsets: np.ndarray, longest: int) -> np.ndarray:
    """texts x PLACES booleans: which hashed n-grams occur."""
    return _marks(data, offsets[:-1], offsets[1:], longest)


def _marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    out = np.zeros((len(starts), PLACES), bool)
    for row, (low, high) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        marks = out[row]
        for at in range(low, high, 1 << 20):  # long texts in pieces that overlap by an n-gram
            codes = LOWER[data[at : min(high, at + (1 << 20) + longest - 1)]].astype(np.uint32) + np.uint32(1)
            value = codes
            marks[_place(value, 1)] = True
            for n in range(2, longest + 1):
                if len(codes) < n:
                    break
                value = value[:-1] * np.uint32(257) + codes[n - 1 :]
                marks[_place(value, n)] = True
    return out


def _cut(offsets: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the pieces of all texts; pieces of one text overlap by an n-gram."""
    lengths = np.diff(offsets)
    n = np.maximum(1, -(-lengths // PIECE_BYTES))
    text = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[:-1][text] + lengths[text] * number // n[text]
    end = offsets[:-1][text] + lengths[text] * (number + 1) // n[text]
    return text, start, np.minimum(end + longest - 1, offsets[1:][text])


def _blocks(column: pa.Array, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, share of its text, presence over the root of its size) of the pieces of a column, by blocks."""
    data, offsets = text_bytes(column)
    text, start, end = _cut(offsets, longest)
    share = (1 / np.bincount(text, minlength=len(column)))[text].astype(np.float32)
    for at in range(0, len(text), BLOCK):
        own = slice(at, at + BLOCK)
        marks = _marks(data, start[own], end[own], longest)
        sizes = np.sqrt(np.maximum(marks.sum(axis=1), 1)).astype(np.float32)
        yield text[own], share[own], marks.astype(np.float32) / sizes[:, None]


def profiles(column: pa.Array, longest: int) -> np.ndarray:
    """texts x PLACES: the mean of each text's pieces; the kernel is the product of two profiles."""
    out = np.zeros((len(column), PLACES), np.float32)
    for text, share, marks in _blocks(column, longest):
        np.add.at(out, text, marks * share[:, None])
    return out


def kernel_values(column: pa.Array, landmarks: np.ndarray, longest: int) -> np.ndarray:
    """texts x landmarks, without a profile of the texts."""
    out = np.zeros((len(column), len(landmarks)))
    for text, share, marks in _blocks(column, longest):
        np.add.at(out, text, (marks @ landmarks.T) * share[:, None])
    return out


def _place(value: np.ndarray, n: int) -> np.ndarray:
    return ((value + np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)


def _sample_rows(make):
    """Rows (lang, pick, digest, vector): ``make`` gives the vectors of a column of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = make(part.column("text")).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang"),
                        part.column("pick"),
                        part.column("digest"),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                    ],
                    ["lang", "pick", "digest", "vector"],
                )

    return run


SAMPLE_ROWS = "lang string, pick double, digest string, vector binary"


@dataclass
class LanguageModel:
    names: list[str]
    landmarks: np.ndarray  # landmarks x PLACES, profiles
    coefficients: np.ndarray  # landmarks x languages
    longest: int

    def decide(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values = kernel_values(column, self.landmarks, self.longest) @ self.coefficients
        best = values.argmax(axis=1)
        weight = np.exp(6 * (values - values.max(axis=1, keepdims=True)))
        return best, 1 / weight.sum(axis=1)


def train(labelled: DataFrame, p: LanguageParameters = LanguageParameters()) -> LanguageModel | None:
    """From (doc_id, text, lang) of the rows to learn from; None without any."""
    texts = [F.col(c).cast("string").alias(c) for c in ("lang", "text")]
    known = labelled.where("lang is not null and text is not null").select("doc_id", *texts)
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    wanted = max(p.least, min(p.per_language, p.sample // len(counts)))
    # One row for each language, so the broadcast grows with the languages and not with the texts.
    shares = known.sparkSession.createDataFrame([(r["lang"], wanted / r["n"]) for r in counts], "lang string, share double")
    pick = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 52)) / float(1 << 52)
    chosen = known.join(F.broadcast(shares), "lang").withColumn("pick", pick).where("pick < share")
    order = ["pick", "lang", "digest"]
    chosen = chosen.select("lang", "pick", F.sha2("text", 256).alias("digest"), "text")
    # Copies of a chosen row meet map-side, so one row repeated very often sends one text a task.
    sample = stage(chosen.groupBy(*order).agg(F.first("text").alias("text")), "language-sample")
    keys = sample.select(*order).orderBy(*order).collect()
    if not keys:
        return None
    names = sorted({r["lang"] for r in keys})
    # Landmarks in turn from each language, so that small ones are represented.
    turns = {n: [r for r in keys if r["lang"] == n] for n in names}
    ranked = [r for _, _, r in sorted((k, n, r) for n, own in turns.items() for k, r in enumerate(own))]
    wanted = ranked[: max(p.landmarks, p.landmarks_per_language * len(names))]
    marked = sample.join(F.broadcast(sample.sparkSession.createDataFrame(wanted)), order, "left_semi")
    found = marked.mapInArrow(_sample_rows(lambda column: profiles(column, p.longest)), SAMPLE_ROWS).orderBy(*order).collect()
    landmarks = np.array([np.frombuffer(bytes(r["vector"]), np.float32) for r in found])
    rows = sample.mapInArrow(_sample_rows(lambda column: kernel_values(column, landmarks, p.longest)), SAMPLE_ROWS)
    rows = rows.orderBy(*order).collect()
    cross = np.array([np.frombuffer(bytes(r["vector"]), np.float32) for r in rows]).astype(float)
    y = np.array([[1.0 if r["lang"] == n else -1.0 for n in names] for r in rows])
    model = LanguageModel(names, landmarks, np.zeros((len(landmarks), len(names))), p.longest)
    among = (landmarks @ landmarks.T).astype(float)
    weight = 1.0 / np.array([len(turns[r["lang"]]) for r in rows])  # languages count alike
    weight *= len(rows) / weight.sum()
    left = cross.T @ (cross * weight[:, None]) + p.ridge * len(rows) * among + 1e-6 * np.eye(len(landmarks))
    model.coefficients = np.linalg.solve(left, cross.T @ (y * weight[:, None])).astype(np.float32)
    return model


def _decisions(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(model.names, pa.string())
        for batch in slices(batches, "text", 1 << 20):
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                best, score = model.decide(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lettered"), names.take(pa.array(best)), pa.array(score.astype(float))],
                    ["doc_id", "lettered", "lang_pred", "score"],
                )

    return run


def languages(documents: DataFrame, labelled: DataFrame, p: LanguageParameters = LanguageParameters()) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; ``labelled``: (doc_id, text, lang) to learn from."""
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), lettered.alias("lettered"), F.col("text").cast("string").alias("text")
    )
    model = train(labelled, p)
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = rows.mapInArrow(_decisions(model), "doc_id long, lettered boolean, lang_pred string, score double")
    return found.select(
        "doc_id",
        F.when(F.col("lettered"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("score")).otherwise(0.0).alias("score"),
    )
