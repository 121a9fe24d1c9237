"""Token counts behind a cache keyed by content digest and tokenizer version.

The digest of the text with its white space normalised meets the stored counts in a join; each
distinct text that is not stored yet is encoded once, and its count is appended to the cache.

Where the tokenizer drops white space, runs of space, tab, line feed and carriage return become one space
before the digest, which changes no count, and the words between them are encoded by the library one by
one and remembered, since tokens never reach across white space. A Python worker keeps the tokenizer and its
words from task to task, as most words of a task have occurred in earlier ones. Whether it does is tried on
pairs of words with each blank between, before and after them (``drops_blanks``). For any other tokenizer the
text is digested and encoded as it is, whole.

Defined results: a null text counts as empty (0 bytes, 0 tokens); equal texts share one entry, so repeated
rows cost one count; a text of any length is counted whole; an empty table gives no rows; rows without an
id are counted like any other; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

# About 100 bytes each in each Python worker; longer words are counted and forgotten.
REMEMBERED_WORDS = 1_000_000
REMEMBERED_CHARS = 64


def tokenizer_version(path: str) -> str:
    """Name and content digest of the vocabulary file."""
    return f"{Path(path).name}:{hashlib.sha256(Path(path).read_bytes()).hexdigest()[:16]}"


def normalised(text: str) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\r]+", " "))


def content_digest(text: Column, version: str) -> Column:
    return F.unhex(F.sha2(F.concat(F.lit(version + "\n"), text), 256))


def load_tokenizer(path: str):
    """The tokenizer on one thread: a task has one core, and threads would each hold memory of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


def count_texts(texts: list[str], tokenizer, known: dict[str, int]) -> list[int]:
    """Tokens of each text; ``known`` remembers words and is emptied when it is full."""
    split = [t.split(" ") for t in texts]
    fresh = list(set(chain.from_iterable(split)).difference(known))
    if len(known) + len(fresh) > REMEMBERED_WORDS:
        known.clear()
        known[""] = 0
        fresh = list(set(chain.from_iterable(split)) - {""})
    for at in range(0, len(fresh), 4_000):
        part = fresh[at : at + 4_000]
        encoded = tokenizer.encode_batch_fast(part, add_special_tokens=False)
        known.update(zip(part, map(len, encoded), strict=True))
    counts = [sum(map(known.__getitem__, words)) for words in split]
    for word in fresh:
        if len(word) > REMEMBERED_CHARS:
            del known[word]
    return counts


@lru_cache(maxsize=1)
def worker_state(path: str, version: str) -> tuple:
    """The tokenizer and the words counted with it so far: one of each in a Python worker, for all its tasks.

    ``version`` tells a file from another that took its place."""
    return load_tokenizer(path), {"": 0}


BLANKS = (" ", "\t", "\n", "\r", "  ", " \r\n\t ")
PROBES = ("a", "The", "it's", "don't", "x1", "2024", "é", "e\u0301", "\u0301", "日本", "...", "(", "<|", "_", "▁", "##b", "\U0001f600")


def drops_blanks(tokenizer) -> bool:
    """Whether blanks give no tokens and change none of the words beside them, on all pairs of ``PROBES``."""

    def counts(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    alone = dict(zip(PROBES, counts(list(PROBES)), strict=True))
    texts = [(f"{b}{x}{b}{y}{b}", alone[x] + alone[y]) for x in PROBES for y in PROBES for b in BLANKS]
    return not any(counts(list(BLANKS))) and counts([t for t, _ in texts]) == [n for _, n in texts]


def _encode_whole(path: str, version: str):
    """For tokenizers that see blanks: one text at a time, so that one text's tokens are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _ = worker_state(path, version)
        for batch in batches:
            counts = [len(tokenizer.encode(t.as_py(), add_special_tokens=False)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def _encode(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = worker_state(path, version)
        for batch in batches:
            sizes = np.cumsum(batch.column("n_chars").to_numpy())
            at = 0
            while at < len(batch):
                base = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, base + 500_000, side="right")))
                texts = batch.column("text").slice(at, end - at).to_pylist()
                counts = count_texts(texts, tokenizer, known)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("digest").slice(at, end - at), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
                )
                at = end

    return run


def token_counts(documents: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 2048) -> DataFrame:
    """Per row of ``documents``: doc_id, n_bytes, n_tokens, over_limit.

    ``cache_path`` names a folder all executors share; it is made where it is missing. Each tokenizer version
    has a Parquet table (digest, n_tokens) of its own below it, so that entries of others are not read.
    """
    spark = documents.sparkSession
    version = tokenizer_version(tokenizer_path)
    cache_path = f"{cache_path.rstrip('/')}/version={hashlib.sha256(version.encode()).hexdigest()[:16]}"
    by_words = drops_blanks(load_tokenizer(tokenizer_path))
    plain = normalised("text") if by_words else F.coalesce(F.col("text").cast("string"), F.lit(""))
    encode = (_encode if by_words else _encode_whole)(tokenizer_path, version)
    schema = "digest binary, n_tokens long"
    rows = stage(
        documents.select(
            "doc_id",
            F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
            content_digest(plain, version).alias("digest"),
        ),
        "token-rows",
    )
    spark.createDataFrame([], schema).write.mode("append").parquet(cache_path)
    stored = spark.read.schema(schema).parquet(cache_path)
    misses = rows.select("digest").distinct().join(stored.select("digest").distinct(), "digest", "left_anti")
    text = documents.select(plain.alias("text"))
    text = text.withColumn("digest", content_digest(F.col("text"), version))
    texts = text.groupBy("digest").agg(F.first("text").alias("text")).join(misses, "digest", "left_semi")
    counted = texts.withColumn("n_chars", F.length("text").cast("long")).mapInArrow(encode, schema)
    counted.write.mode("append").parquet(cache_path)
    # Two runs may have stored the same digest: their counts are equal.
    counts = spark.read.schema(schema).parquet(cache_path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
