"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import public_tokenizers
import pytest
from duebook.llm import decontam, langid, mixing, near_dedup, pii, quality, tokencount, topk, toxicity, urlrules
from duebook.llm.queries import URL_RULES
from duebook.llm.staging import shared_root
from pyspark.sql import Row
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "score double, kept boolean, y int, node long, root long, seed long, size long, hash long, digest binary, "
    "spans string, copies int, mix_copies int, threshold double, bucket long, blocks int, target double, labels string"
)
WORDS = "amber birch cedar delta ember fjord grove heath islet knoll larch maple north ochre pearl quartz ridge slate".split()


def _prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 0.5, True, 1, 1, 1, 1, 1, 1, b"x", "s", 9, 9, 0.1, 1, 1, 1.0, "l")


LONG = _prose(1, 150_000)
ITEM = _prose(2, 40)
TEXTS = [
    _row(1, _prose(3, 100)),
    _row(2, _prose(3, 100) + " extra"),
    _row(3, _prose(3, 100)),
    _row(3, _prose(3, 100)),  # a repeated row
    _row(4, None),
    _row(5, ""),
    _row(6, "  \n\t "),
    _row(7, LONG),
    _row(8, "two words", None, None),
    _row(9, "Two  WORDS", None, None),
    _row(None, _prose(4, 60), "de", None),
    _row(None, _prose(4, 60), "de", None),
    _row(10, " ".join(ITEM.split()[20:] + ["between"] + ITEM.split()[:20]), "fr", "b"),
    _row(11, "1234 5678 !!", "en", "b"),
    _row(12, "é" * 500 + " mail a.b@c.example.org, +44 20 7946 0958", "fr", "b"),
    _row(13, "x" * 2_000_000, None, "b"),
    _row(14, "x " * 50_000, None, "b"),
    _row(15, "idiot " + _prose(5, 30), "en", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 0), (2, 0), (3, 1), (3, 0), (15, 1), (11, 0), (None, 1), (99, 1), (8, None)]
    return spark.createDataFrame([r for r in rows if None not in r], "doc_id long, y int").groupBy("doc_id").agg(F.max("y").alias("y"))


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, y int")


def _by_id(df):
    return {r[0]: r for r in df.collect()}


def test_toxicity(docs, empty, labels, no_labels):
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[4] == by_id[5] == by_id[6]
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(docs, no_labels).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, no_labels).count() == len(TEXTS)


def test_quality(docs, empty, labels, no_labels):
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.quality_scores(empty, labels).count() == 0
    assert {r.score for r in quality.quality_scores(docs, no_labels).collect()} == {0.5}


def test_statistics_of_empty_texts_are_zero():
    import pyarrow as pa

    assert not quality.statistics(pa.array(["", None])).any()


def test_near_duplicates(docs, empty):
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[i].component_id for i in (1, 2, 3)] == [1, 1, 1]
    assert [by_id[i].n_shingles for i in (4, 5, 6)] == [0, 0, 0]
    assert all(by_id[i].component_id == i and by_id[i].kept for i in (4, 5, 6, 7))
    assert by_id[8].component_id == by_id[9].component_id == 8
    assert by_id[14].n_shingles == 1
    unnamed = [r for r in rows if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in unnamed] == [(None, True)] * 2
    assert near_dedup.near_duplicates(empty).count() == 0


def test_top_k(spark):
    schema = "vec_id long, embedding array<float>, rank int, score long, leaf int, v int"
    rows = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (20, [0.25]), (21, []), (1, [1.0, 0.5]),
    ]
    df = spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df).collect())
    same, part = 64 * 64 + 32 * 32, 16 * 64
    assert got == [
        (0, 1, 1, same), (0, 2, 1, same), (0, 3, 2, same), (0, 4, 20, part), (0, 5, 21, 0),
        (20, 1, 0, part), (20, 2, 1, part), (20, 3, 1, part), (20, 4, 2, part), (20, 5, 21, 0),
    ]
    assert topk.top_k(df.where("false")).count() == 0


def test_top_k_with_numbers_beyond_doubles(spark):
    big = float(2**40)
    df = spark.createDataFrame([(0, [big, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df).orderBy("rank").collect()]
    assert got == [(2, 2**52 + 128 * 64), (1, 2**52 + 64 * 64)]


def test_language(docs, empty):
    rows = langid.languages(docs, docs.select("doc_id", "text", "lang")).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (4, 5, 6, 11))
    assert langid.languages(empty, empty).count() == 0
    assert {r.lang_pred for r in langid.languages(docs, empty).collect()} == {"und"}


def test_personal_data(docs, empty):
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r.spans for r in rows}
    assert [(s.kind, s.start, s.end) for s in by_id[12]] == [("email", 506, 523), ("phone", 525, 541)]
    assert by_id[4] == by_id[5] == []
    masked = _by_id(pii.mask_pii(docs).where("doc_id = 12"))[12]
    assert masked.text == "é" * 500 + " mail <EMAIL>, <PHONE>" and masked.n_chars == len(masked.text)
    assert pii.mask_pii(docs).columns == docs.columns
    assert pii.find_pii(empty).count() == 0


def test_contamination(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, ITEM, 1), (1, ITEM, 1), (2, None, 1), (3, "", 1), (4, "two words", 1), (None, _prose(9, 20), 1)],
        "item_id long, text string, seed int",
    )
    rows = decontam.contaminated(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.matched_words) for r in rows] == [(10, 1, 40)]
    assert {(t.doc_word, t.item_word, t.words) for t in rows[0].tiles} == {(0, 20, 20), (21, 0, 20)}
    assert decontam.contaminated(empty, items).count() == 0
    assert decontam.contaminated(docs, items.where("false")).count() == 0


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r["size"] for r in rows if r.doc_id in (4, 5, 6)} == {0}
    assert {r.source for r in rows} == {"a", "b", None}
    assert sorted(r.taken for r in rows) == sorted(r.taken for r in mixing.mix(docs).collect())
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    assert mixing.mix(empty).count() == 0


def test_url_filter(spark):
    schema = "page_id long, url string, verdict string, tokens string, number string"
    rows = [
        (1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.COM/en/1"), (4, "http://a.net/es/5"), (5, "http://example.com/en/"),
        (5, "http://example.com/en/"), (6, "http://notexample.com/en/x?q=1#f"), (None, "x://b.org"), (7, "x://b.org/" + "a/" * 20_000),
        (8, "http://c.org/bad/8"), (9, "http://c.org/bad/9"), (10, "http://c.org/fine/10"),
    ]
    pages = spark.createDataFrame([(*r, "v", "t", "n") for r in rows], schema)
    bad = spark.createDataFrame([(8, True), (9, True), (10, False)], "doc_id long, bad boolean")
    # Three labelled pages carry no rule by the default bound.
    assert {r.verdict for r in urlrules.judge(pages, bad, URL_RULES).collect() if r.rule is None} == {"allow"}
    found = urlrules.judge(pages, bad, URL_RULES, urlrules.MiningParameters(z=0.0)).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert by_id[1] == by_id[2] == ("", "", None, "allow")
    assert by_id[3] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert by_id[4][2:] == ("net/es/", "block") and by_id[5][2:] == ("example.com/en/", "block")
    assert by_id[6] == ("notexample.com", "/en/x", "com/", "allow")
    assert [by_id[i][3] for i in (8, 9, 10)] == ["block", "block", "allow"]
    assert urlrules.judge(pages, bad.where("false"), URL_RULES).count() == len(rows)
    assert urlrules.judge(pages.where("false"), bad, URL_RULES).count() == 0


def test_token_counts(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    cache = f"{shared_root(spark)}/edge-cache"
    first = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in tokencount.token_counts(docs, path, cache).collect())
    assert len(first) == len(TEXTS)
    stored = spark.read.parquet(cache).count()
    again = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in tokencount.token_counts(docs, path, cache).collect())
    assert again == first and spark.read.parquet(cache).count() == stored  # nothing was encoded twice
    assert {(4, 0, 0), (5, 0, 0)} <= set(first)
    assert tokencount.token_counts(empty, path, cache).count() == 0


@pytest.mark.parametrize("text", ["<|startoftext|>a <|endoftext|>", "<|STARTOFTEXT|> b", "a\x0bb \x85 c\u00a0d", "Σίσυφος ΣΑΣ e\u0301 \u0301", "don't we'll it's 12 34", "", " \n "])
def test_words_one_by_one_give_the_text_s_count(text):
    import re

    tokenizer = tokencount.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    normal = re.sub(r"[ \t\n\r]+", " ", text).strip(" ")
    assert tokencount.count_texts([normal], tokenizer, {"": 0}) == [len(tokenizer.encode(text, add_special_tokens=False).ids)]


def test_a_tokenizer_that_keeps_blanks_gets_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = tokencount.load_tokenizer(path)
    assert not tokencount.drops_blanks(tokenizer)
    assert tokencount.drops_blanks(tokencount.load_tokenizer(public_tokenizers.path("word_bpe_49k.json")))
    texts = ["Hello  world\n\tit's  2024", " a b ", "a b", "", None, "x" * 3000 + "  y", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    cache = f"{shared_root(spark)}/blank-cache"
    for _ in range(2):  # counted, then from the cache
        found = {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs, path, cache).collect()}
        assert found == wanted
    other = public_tokenizers.path("word_bpe_49k.json")
    assert tokencount.token_counts(docs, other, cache).count() == len(texts)
    assert {r.n_tokens for r in tokencount.token_counts(docs, path, cache).where("doc_id = 1").collect()} == {wanted[1]}


def test_pipeline_stages(spark, docs, empty, tmp_path):
    for name, columns in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        rows = [(1, 1, 0), (2, 1, 0), (15, 0, 1), (11, 1, 0), (3, None, None)] if name == "labels" else [(1, ITEM), (2, None)]
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    for table in (docs, empty):
        table.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        for name, run in corpus_pipeline.STAGES:
            out = run(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
            assert set(docs.columns) <= set(out.columns), name
            rows = out.collect()
            assert len(rows) <= len(TEXTS)
            if table is docs and name == "near duplicates":
                ids = [r.doc_id for r in rows]
                assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(None) == 1
                assert {4, 5, 6} <= set(ids)
            if table is docs and name == "benchmark decontamination":
                assert 10 not in [r.doc_id for r in rows]
            if table is docs and name == "personal data":
                assert any("<EMAIL>" in (r.text or "") for r in rows) and len(rows) == len(TEXTS)


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    """Two texts under one id, copies without id, rows equal in all columns: texts are judged, not ids."""
    one, other, third = _prose(30, 80), _prose(31, 80), _prose(32, 80)
    rows = [(5, one), (5, other), (3, one + " more"), (None, third), (None, third), (None, third + " end"), (None, "alone it is")]
    rows += [(7, other + " x"), (7, other + " x"), (8, None), (8, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("root", "t1", "rows", "node")})
    for table in (df.repartition(3), df.coalesce(1)):
        kept = near_dedup.one_of_each(table, near_dedup.NearDedup(percent=80))
        assert kept.columns == df.columns
        texts = sorted((str(r.doc_id), r.text or "") for r in kept.collect() if not (r.text or "").startswith(third[:30]))
        assert texts == sorted([("3", one + " more"), ("5", other), ("None", "alone it is"), ("8", ""), ("8", ""), ("9", "")])
        assert kept.where(F.col("text").startswith(third[:30])).count() == 1
        found = near_dedup.near_duplicates(table, near_dedup.NearDedup(percent=80)).collect()
        assert sorted(str(r.component_id) for r in found if r.doc_id == 5) == ["3", "5"]


def test_top_k_of_very_many_equal_rows(spark):
    rng = random.Random(4)
    rows = [(40, [0.5, 0.25, 1.0])] * 9000 + [(i, [rng.random() for _ in range(3)]) for i in range(100, 400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    found = {}
    for r in topk.top_k(df, 20).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    vectors = [(i, [int(64 * x // 1) for x in v]) for i, v in rows]
    for q, v in dict(vectors).items():
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q)[:20]
            assert sorted(found[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]


def test_contaminated_rows_go_and_no_others_of_their_id(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    planted, turned = _prose(20, 10) + " " + ITEM, " ".join(reversed(ITEM.split()))
    rows = [(None, planted), (None, _prose(21, 50)), (None, None), (None, turned), (None, ITEM), (5, planted), (5, _prose(22, 50)), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = corpus_pipeline.drop_contaminated(spark, df, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(str(r) for r in rows if ITEM not in (r[1] or ""))


def test_pipeline_runs(spark, sf):
    first = corpus_pipeline.run(spark, sf)
    rows = first.collect()
    assert rows and isinstance(rows[0], Row) and {r.mix_copies for r in rows} <= {1, 2}
