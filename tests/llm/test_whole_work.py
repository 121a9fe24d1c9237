"""Work that must stay whole, and tables that must stay small, as the input grows."""

from __future__ import annotations

import numpy as np
import pytest
from duebook.llm import prefix_join, toxicity
from pyspark.sql import functions as F


@pytest.mark.parametrize("lengths", [(1,), (2, 5), (300, 1, 40)])
def test_packed_places_come_back(lengths):
    rng = np.random.default_rng(1)
    for length in lengths:
        places = np.sort(rng.integers(0, 1 << 32, length, dtype=np.uint64).astype(np.uint32))
        places[-1] = (1 << 32) - 1
        assert (prefix_join._unpacked(prefix_join._packed(places), length) == places).all()


@pytest.fixture(scope="module")
def with_passages(spark):
    """300 texts of 60 words of their own with one of five passages of 16 words: no two are similar."""
    own = [[f"own{i}x{k}" for k in range(60)] for i in range(300)]
    shared = [[f"shared{i}x{k}" for k in range(16)] for i in range(5)]
    rows = [(i, " ".join(own[i][:30] + shared[i % 5] + own[i][30:])) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("bits", [2, 4])
def test_common_passages_connect_nothing_beyond_a_small_table(with_passages, bits):
    """More n-grams than places: passages of 60 texts each stay out of the prefixes all the same."""
    p = prefix_join.PrefixJoin(counter_bits=bits, chunk_bits=6)
    texts = with_passages.select("doc_id", "text")
    levels = prefix_join.gram_levels(texts.select("text"), p)
    rows = texts.mapInArrow(
        prefix_join._prefixes(p, levels), "doc_id long, n long, d1 long, d2 long, group long, prefix array<long>"
    )
    assert prefix_join._proposed(rows.select("group", "n", "prefix"), p).count() == 0


def test_levels_count_every_row(with_passages):
    """A passage has the number of its texts, four steps for each doubling; runs and chunks change nothing."""
    p = prefix_join.PrefixJoin()
    levels = prefix_join.gram_levels(with_passages.select("text"), p)
    again = prefix_join.gram_levels(with_passages.select("text"), prefix_join.PrefixJoin(run_grams=70, chunk_bits=3))
    assert (levels == again).all()
    # 13 n-grams of each of five passages, in 60 texts; places may coincide
    assert set(levels.tolist()) == {0, round(4 * np.log2(60))}
    assert 60 <= (levels > 0).sum() <= 65
    rare = with_passages.select(F.concat(F.lit("r"), "doc_id").alias("text"))
    assert prefix_join.gram_levels(rare, p).max() == 0


def _filler(seed, n):
    return [f"f{x}" for x in np.random.default_rng(seed).integers(0, 500, n)]


@pytest.fixture(scope="module")
def labelled(spark):
    """160 texts, every fourth toxic by one word among others; two have no label and one has no id."""
    rows = [(i, " ".join([*_filler(i, 30), "vile" if i % 4 == 0 else "fine", *_filler(i + 1000, 30)]), "en") for i in range(160)]
    rows += [(200, "vile " * 3, "en"), (201, "fine", None), (None, "vile", "en"), (7, " ".join(_filler(7, 9)), "de")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, y int")
    return documents, labels


def test_long_labelled_texts_are_learnt_from_whole(spark):
    """All that is toxic stands at the end of texts of more than 3,000 words."""
    rows = [(i, " ".join([*_filler(i, 3100 if i % 2 else 40), "vile" if i % 2 else "fine"]), "en") for i in range(48)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(48)], "doc_id long, y int")
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(documents, labels).collect()}
    assert min(scores[i] for i in range(1, 48, 2)) > max(scores[i] for i in range(0, 48, 2))


@pytest.mark.parametrize("pack_texts", [4096, 16])
def test_packs_hold_every_labelled_row(labelled, pack_texts):
    documents, labels = labelled
    packs = list(toxicity._read_packs(toxicity._packs(documents, labels, toxicity.ToxicityParameters(pack_texts=pack_texts)).toArrow().to_batches()))
    assert len(packs) == 1 if pack_texts == 4096 else len(packs) >= 8
    assert sum(len(x.y) for x in packs) == 161 and sum(int(x.y.sum()) for x in packs) == 40
    assert sorted(n for x in packs for n in x.lengths.tolist()) == [9] + [61] * 160
    assert sum(x.lang.count("de") for x in packs) == 1


def test_several_packs_learn_the_same_whatever_the_layout(labelled):
    documents, labels = labelled
    p = toxicity.ToxicityParameters(pack_texts=40, epochs=3)
    one, other = (toxicity.train(documents.repartition(n), labels.repartition(n), p) for n in (2, 7))
    assert (one.known == other.known).all() and (one.embeddings == other.embeddings).all()
    assert (one.output == other.output).all() and one.slope == other.slope and one.thresholds == other.thresholds
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(documents, labels, p).collect()}
    assert min(scores[i] for i in range(0, 160, 4)) > max(scores[i] for i in range(160) if i % 4 and i != 7)


def test_beyond_most_words_rare_words_share_embeddings(labelled):
    documents, labels = labelled
    p = toxicity.ToxicityParameters(most_words=30, shared_places=8, epochs=2)
    model = toxicity.train(documents, labels, p)
    assert 2 <= len(model.known) <= 30 and len(model.embeddings) == 1 + len(model.known) + 8
    rows = model.rows_of(np.array([model.known[1], 3, 11], np.uint64))
    assert rows.tolist() == [2, 1 + len(model.known) + 3, 1 + len(model.known) + 3]
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(documents, labels, p).collect()}
    assert scores[200] > scores[201]


@pytest.mark.parametrize("limit", [1, 3, 1 << 16])
def test_peaks_equal_plain_windows(limit):
    rng = np.random.default_rng(5)
    lengths, widths, n = np.array([1, 4, 2, 7]), (1, 2, 3), 4
    x = rng.integers(-2, 3, (6, 3)).astype(np.float32)
    x[0] = 0
    filters = [rng.integers(-2, 3, (w, 3, n)).astype(np.float32) for w in widths]
    bias = [rng.integers(-1, 2, n).astype(np.float32) for _ in widths]
    rows, starts = [], []
    for length in lengths.tolist():
        starts.append(len(rows))
        rows += [*rng.integers(0, 6, length).tolist(), 0, 0]
    found = toxicity._peaks(x, np.array(rows), lengths, filters, bias, limit)
    for f, b, (best, place) in zip(filters, bias, found, strict=True):
        for t, (start, length) in enumerate(zip(starts, lengths.tolist(), strict=True)):
            values = np.array([b + sum(x[rows[at + k]] @ f[k] for k in range(len(f))) for at in range(start, start + length)])
            assert (best[t] == values.max(axis=0)).all()
            assert (place[t] == start + values.argmax(axis=0)).all()
