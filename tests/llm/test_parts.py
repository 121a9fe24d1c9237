"""Parts of the operators against plain versions of themselves."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from duebook.llm import decontam, langid, mixing, near_dedup, pii, quality, topk, toxicity, urlrules, words
from duebook.llm.components import components
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.brute import WORD, base_spans, shingles

TEXTS = st.text(alphabet="ab B.\n\té", max_size=60)


@given(st.lists(TEXTS, max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_hash_alike_only_if_equal(texts):
    hashes, pointers, starts, ends = words.word_hashes(*words.text_bytes(pa.array(texts, pa.string())))
    plain = [[w.replace("B", "b") for w in WORD.findall(t)] for t in texts]
    assert np.diff(pointers).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    assert (ends - starts).tolist() == [len(w.encode()) for w in flat]


def test_words_across_pieces(monkeypatch):
    monkeypatch.setattr(words, "PIECE", 64)
    texts = [" ".join(f"word{i % 7}" for i in range(300)), "x" * 10_000, "", "a b", "y" * 70 + " " + "z" * 200]
    hashes, pointers, _, _ = words.word_hashes(*words.text_bytes(pa.array(texts)))
    assert np.diff(pointers).tolist() == [len(t.split()) for t in texts]
    assert len(set(hashes.tolist())) == 7 + 1 + 2 + 2


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=40, deadline=None)
def test_shingle_sets_have_the_right_sizes_and_overlaps(texts):
    hashes, pointers, _, _ = words.word_hashes(*words.text_bytes(pa.array(texts, pa.string())))
    flat, at = words.shingle_sets(hashes, pointers, 5)
    ours = [set(flat[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in ours] == [len(s) for s in plain]
    for i, j in combinations(range(len(texts)), 2):
        assert len(ours[i] & ours[j]) == len(plain[i] & plain[j])


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    sets = [np.sort(pool[:600]), np.sort(pool[100:700])]  # 500 of 700
    sig = near_dedup.signatures(np.concatenate(sets), np.array([0, 600, 1200]), 2048)
    assert abs((sig[0] == sig[1]).mean() - 500 / 700) < 0.04


@pytest.mark.parametrize("percent", [80, 85])
def test_the_bayesian_test_keeps_true_pairs_and_drops_unlike_ones(percent):
    p = near_dedup.NearDedup(percent=percent)
    bounds = near_dedup.least_matches(p)
    assert [n for n, _ in bounds] == list(range(16, 129, 16))
    rng = np.random.default_rng(1)

    def pairs(similarity, n):
        left = rng.integers(0, 256, (n, p.hashes), dtype=np.uint8)
        right = np.where(rng.random((n, p.hashes)) < similarity, left, rng.integers(0, 256, (n, p.hashes)))
        kept = 0
        for a, b in zip(left, right.astype(np.uint8), strict=True):
            kept += len(near_dedup.survivors(a[None], b[None], bounds)[0])
        return kept

    assert pairs(percent / 100, 3000) == 3000
    assert pairs(0.3, 1000) == 0


def _naive_tiles(doc, item, least):
    marked_d, marked_i, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and d + n not in marked_d and i + n not in marked_i:
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < least:
            return out
        out.append((d, i, n))
        marked_d.update(range(d, d + n))
        marked_i.update(range(i, i + n))


@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=25))
@settings(max_examples=150, deadline=None)
def test_tiles_equal_naive_greedy_tiling(doc, item):
    seed = 3
    wanted = _naive_tiles(doc, item, seed)

    def seeds(sequence):
        own = words.window_hashes(np.array(sequence, np.uint64) + np.uint64(1), seed)
        return own

    d, i = seeds(doc), seeds(item)
    if not len(d) or not len(i):
        assert not wanted
        return
    shared = np.intersect1d(d, i)
    d, i = np.where(np.isin(d, shared), d, np.uint64(0)), np.where(np.isin(i, shared), i, np.uint64(0))
    assert decontam.tiles(d, i, seed) == wanted


def test_reordered_and_partial_passages(spark):
    rng = random.Random(4)
    item = [f"w{rng.randrange(10**6)}" for _ in range(40)]
    other = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    docs = [
        (1, " ".join(other[:50] + item[20:] + other[50:60] + item[:20])),  # reordered
        (2, " ".join(other + item[:12])),  # less than half
        (3, " ".join(item).upper().replace(" ", ", ")),  # case and punctuation
        (4, " ".join(x for pair in zip(item, other, strict=False) for x in pair)),  # no run of five
    ]
    found = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.matched_words) for r in found) == [(1, 40), (3, 40)]


def test_short_items_and_scripts_without_spaces(spark):
    rng = random.Random(6)
    prose = [f"v{rng.randrange(10**6)}" for _ in range(60)]
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(24))
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(30))
    items = [(1, "Zebra quartz, violin. Ember"), (2, han), (3, thai), (4, "v0"), (5, "東京大学"), (6, "Ember, violin quartz")]
    docs = [
        (1, " ".join(prose + ["zebra QUARTZ violin ember"] + prose)),
        (2, " ".join(prose[:9]) + " あの" + han[12:] + "この" + han[:12] + "です。"),  # reordered, no spaces
        (3, " ".join(prose) + thai),
        (4, "v0 zebra quartz violin " + " ".join(prose) + " ember"),  # not in a row
        (5, "昨日東京大学へ行きました"),
        (6, "東京の大学 v0 v0"),
        (7, ""),
        (8, "ember violin quartz"),  # as short as the item
        (9, han[:6] + "へ" + han[16:20]),  # under half
    ]
    found = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.item_id, r.matched_words) for r in found) == [(1, 1, 4), (2, 2, 24), (3, 3, 30), (5, 5, 4), (8, 6, 3)]
    assert next(r.tiles for r in found if r.doc_id == 1)[0].asDict() == {"doc_word": 60, "item_word": 0, "words": 4}


def test_characters_without_spaces_are_words():
    texts = ["ab漢字cd", "漢", "かな カナ", "ภาษาไทย", "ខ្មែរ", "héé ß", "𠀀𠀁x", "", "한국어 문장"]
    _, pointers, starts, ends = words.word_hashes(*words.text_bytes(pa.array(texts)), words.NOT_ALNUM, split_unspaced=True)
    assert np.diff(pointers).tolist() == [4, 1, 4, 7, 5, 2, 3, 0, 2]
    data = "".join(texts).encode()
    assert [data[s:e].decode() for s, e in zip(starts[:4], ends[:4], strict=True)] == ["ab", "漢", "字", "cd"]


@given(st.text(alphabet="a1.@+- ()9é_\n", max_size=80))
@settings(max_examples=400, deadline=None)
def test_base_spans_equal_the_plain_patterns(text):
    ours = [(s.kind, s.start, s.end) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]
    assert ours == base_spans(text)


@pytest.mark.parametrize("text", ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "1 " * 150_000, "AB12" * 100_000])
def test_scanning_time_grows_with_the_length(text):
    import time

    started = time.perf_counter()
    pii.find_spans(text)
    assert time.perf_counter() - started < 5


def test_validators_confirm_and_context_moves_scores():
    text = "transfer to iban DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00; ssn 123-45-6789, plain 123-45-6789"
    spans = pii.find_spans(text)
    assert [(s.kind, text[s.start : s.end]) for s in spans if s.kind == "iban"] == [("iban", "DE89 3704 0044 0532 0130 00")]
    for behind in (" BIC COBADEFFXXX", " NOW PLEASE", ", X", " GB29 NWBK 6016 1331 9268 19", "", " A", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEF"):
        line = "DE89 3704 0044 0532 0130 00" + behind
        found = [line[s.start : s.end] for s in pii.find_spans(line) if s.kind == "iban"]
        assert found == ["DE89 3704 0044 0532 0130 00", *[behind.strip()] * ("GB29" in behind)]
    assert not [s for s in pii.find_spans("DE89370400440532013000X DE8937040044053201300") if s.kind == "iban"]
    near = pii.find_spans("card number 4111 1111 1111 1111")[0]
    far = pii.find_spans("x 4111 1111 1111 1111")[0]
    assert near.kind == far.kind == "card" and near.score > far.score
    assert not pii.find_spans("4111 1111 1111 1112")


def test_pooled_adjacent_is_the_closest_monotone_sequence():
    levels = quality.pool_adjacent(np.array([0.2, 0.1, 0.5, 0.4, 0.9]), np.array([1.0, 3.0, 1.0, 1.0, 1.0]))
    assert np.allclose(levels, [0.125, 0.125, 0.45, 0.45, 0.9])


def test_normal_equations_of_parts_equal_those_of_the_whole():
    rng = np.random.default_rng(3)
    x = rng.random((50, len(quality.STATISTICS)))
    y = rng.integers(0, 2, 50)
    n = len(quality.STATISTICS)
    model = quality.QualityModel(x.mean(0), x.std(0), rng.normal(size=(n, 8)), rng.random(8), np.zeros(9), np.zeros(1), np.zeros(1))
    batch = pa.RecordBatch.from_arrays([*[pa.array(x[:, i]) for i in range(n)], pa.array(y)], [*quality.STATISTICS, "y"])
    parts = [r for cut in (batch.slice(0, 20), batch.slice(20)) for r in quality._normal_equations(model)(iter([cut]))]
    total = np.frombuffer(next(quality._add_up(iter(parts))).column(0)[0].as_py(), float).reshape(9, 10)
    f = model.features(x)
    assert np.allclose(total[:, :9], f.T @ f) and np.allclose(total[:, 9], f.T @ y)


def test_presence_holds_the_n_grams_and_nothing_else():
    marks = langid.presence(*words.text_bytes(pa.array(["abA", "ba"])), 2)
    assert marks.sum(axis=1).tolist() == [4, 3]  # a b ab ba; a b ba
    assert (marks[0] & marks[1]).sum() == 3


def test_presence_of_long_texts_does_not_depend_on_pieces():
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(2_200_000))
    whole = langid.presence(*words.text_bytes(pa.array([text])), 3)
    codes = {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}
    assert whole.sum() <= len(codes) and whole.sum() > 0.9 * len(codes)


def test_long_texts_of_rich_vocabulary_keep_their_language(spark):
    """1 MB of ever new words: nearly all n-grams of the letters occur, their frequencies tell the language."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    weights = {lang: [rng.random() ** 2 + 0.02 for _ in letters] for lang in ("aa", "bb", "cc", "dd")}

    def text(lang, size):
        stream = rng.choices(letters, weights[lang], k=size)
        for i in range(0, size, rng.randrange(4, 9)):
            stream[i] = " "
        return "".join(stream)

    learnt = [(i * 4 + k, text(lang, 1500), lang) for i in range(30) for k, lang in enumerate(weights)]
    long = [(1000 + k, text(lang, size), lang) for size in (3000, 1_000_000) for k, lang in enumerate(weights)]
    schema = "doc_id long, text string, lang string"
    found = langid.languages(spark.createDataFrame(long, schema), spark.createDataFrame(learnt, schema))
    assert sorted((r.doc_id, r.lang_pred) for r in found.collect()) == sorted((i, lang) for i, _, lang in long)


def test_seventy_languages_are_all_learnt(spark):
    """Each with words of its own; one holds a third of the rows, and one row of it very many copies."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"l{k:02d}" for k in range(70)]
    own = {n: ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(40)] for n in names}

    def text(lang):
        return " ".join(rng.choices(own[lang], k=40))

    learnt = [(i * 70 + k, text(n), n) for i in range(12) for k, n in enumerate(names)]
    learnt += [(10_000 + i, text("l00"), "l00") for i in range(200)] + [(None, "the same row", "l00")] * 200
    held = [(k, text(n), n) for k, n in enumerate(names)]
    schema = "doc_id long, text string, lang string"
    found = langid.languages(spark.createDataFrame(held, schema), spark.createDataFrame(learnt, schema)).collect()
    right = sum(r.lang_pred == names[r.doc_id] for r in found)
    assert len(found) == 70 and right >= 67


def test_kernel_values_are_products_of_profiles_over_all_pieces():
    rng = random.Random(4)
    column = pa.array(["ab" * 40, None, "".join(rng.choice("abcdefgh ") for _ in range(3 * langid.PIECE_BYTES + 5)), "c"])
    whole = langid.profiles(column, 3)
    assert np.allclose(langid.kernel_values(column, whole, 3), whole @ whole.T, atol=1e-5)
    assert ((whole > 0) == langid.presence(*words.text_bytes(column), 3)).all()


def test_cover_trees_cover_and_hold_each_row_once():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 1, (200, 5)) for c in (0, 20, 40)] + [np.zeros((50, 5))])
    tree = topk.cover_tree(points, np.arange(len(points)), 16)

    def check(node):
        rows = topk._all_rows(node)
        assert topk._distances(points[rows], node.center).max() <= node.radius + 1e-9
        for child in node.children:
            check(child)
        return rows

    assert sorted(check(tree).tolist()) == list(range(len(points)))


@given(st.integers(0, 10_000))
@settings(max_examples=25, deadline=None)
def test_dual_tree_search_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(-20, 20, (300, 4)) + rng.integers(0, 3, (300, 1)) * 100
    queries = np.concatenate([data[:20], rng.integers(-50, 50, (20, 4))])
    ids, q_ids = np.arange(300), np.arange(40)
    best = topk.Best(40, 5)
    topk.search(topk.make_block(q_ids, queries, 4), topk.make_block(ids, data, 8), best)
    for q in range(40):
        wanted = sorted((-int(queries[q] @ data[i]), i) for i in range(300) if i != q)[:5]
        assert list(zip(best.scores[q].tolist(), best.ids[q].tolist(), strict=True)) == [(-s, i) for s, i in wanted]


def test_pruning_prunes():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(0, 10, (2000, 8)) + 100 * i for i in range(5)])
    seen = []
    block = topk.make_block(np.arange(len(data)), data, 32)
    original = topk._products
    try:
        topk._products = lambda a, b, exact: seen.append(len(a) * len(b)) or original(a, b, exact)
        topk.search(topk.make_block(np.arange(50) + 10**6, data[-50:], 8), block, topk.Best(50, 5))
    finally:
        topk._products = original
    assert sum(seen) < 0.5 * 50 * len(data)


def test_toxicity_model_equals_a_plain_convolution():
    rng = np.random.default_rng(7)
    known = np.sort(rng.integers(1, 1 << 62, 30, dtype=np.uint64))
    model = toxicity.ToxicityModel(
        (1, 2, 3), known, np.r_[np.zeros((1, 4)), rng.normal(size=(30, 4))].astype(np.float32),
        [rng.normal(size=(w, 4, 5)).astype(np.float32) for w in (1, 2, 3)], [rng.normal(size=5).astype(np.float32) for _ in range(3)],
        rng.normal(size=15).astype(np.float32), 0.1,
    )
    texts = [rng.choice(np.r_[known, rng.integers(1, 99, 20, dtype=np.uint64)], n) for n in (0, 1, 2, 9, 40)]
    pooled = model.pooled(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])])
    for row, text in zip(pooled, texts, strict=True):
        x = np.r_[model.embeddings[model.rows_of(text)], np.zeros((3, 4), np.float32)]
        parts = []
        for w, f, b in zip(model.widths, model.filters, model.bias, strict=True):
            values = [b + sum(x[i + k] @ f[k] for k in range(w)) for i in range(len(text))] or [b]
            parts.append(np.maximum(np.maximum(np.max(values, axis=0), b), 0))
        assert np.allclose(row, np.concatenate(parts), atol=1e-4)


@pytest.mark.parametrize("n", [1, 5, 12])
def test_targets_follow_the_resharing_rule(spark, n):
    rng = random.Random(n)
    sizes = {f"s{i:02d}" if i else None: rng.choice([0, 1, 10, 500, 20_000]) for i in range(n)}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df, (3, 1, 2), 1.5, 2).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:  # step by step: stop those above twice their size, share the rest anew
        factor = left / sum(weight[s] for s in free)
        above = {s for s in free if factor * weight[s] > 2 * sizes[s]}
        if not above:
            target |= {s: factor * weight[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        free -= above
    assert {s: round(t, 6) for s, t in got.items()} == {s: round(t, 6) for s, t in target.items()}


def test_mined_rules_equal_counting(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        tokens = [t for t in "abcde" if rng.random() < 0.5]
        rows.append((tokens, "a" in tokens and "b" in tokens and rng.random() < 0.9))
    p = urlrules.MiningParameters(support=0.05, confidence=0.75)
    mined = {r[0]: (r[1], r[2]) for r in urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), p)}
    every = {}
    for n in range(1, 6):
        for tokens in combinations("abcde", n):
            own = [bad for t, bad in rows if set(tokens) <= set(t)]
            if own and sum(own) / len(rows) >= 0.05 and sum(own) / len(own) >= 0.75:
                every[tokens] = (sum(own) / len(own), sum(own) / len(rows))
    kept = {t: v for t, v in every.items() if not any(set(s) < set(t) and w[0] >= v[0] for s, w in every.items())}
    assert mined.keys() == kept.keys()
    assert all(np.allclose(mined[t], kept[t]) for t in kept)


def test_rules_beyond_the_most_frequent_tokens_and_long_addresses(spark):
    """300 tokens more frequent than a spam path, and pages of 60 tokens that FP-growth cannot list."""
    rows = [([f"host:h{i}", "path:a"], False) for i in range(300) for _ in range(4)]
    long = [f"ext:{i:02d}" for i in range(60)]
    rows += [([*long, "path:spam"], True)] * 3 + [(long, False)] * 3
    mined = {r[0]: r[1] for r in urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))}
    assert mined == {("path:spam",): 1.0}


def test_no_rule_rests_on_chance(spark):
    """Few blocked pages of a rare token are no rule where blocked pages are common, and are one where they are not."""
    rows = [([f"path:p{i % 50}", "host:h"], i % 3 == 0) for i in range(300)] + [(["path:rare", "host:h"], True)] * 3
    rows += [(["path:bad", "host:h"], True)] * 40 + [(["path:once", "host:x"], True)]
    mined = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    assert {r[0] for r in mined} == {("path:bad",)}
    rows = [([f"path:p{i % 50}", "host:h"], False) for i in range(2000)] + [(["path:rare", "host:h"], True)] * 3
    assert {r[0] for r in urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))} == {("path:rare",)}


def test_matching_finds_the_surest_rule(spark):
    rules = [(("a", "b"), 0.8, 0.1), (("c",), 0.7, 0.1), (("b", "d"), 0.9, 0.1)]
    sets = [("1", ["a", "b"]), ("2", ["a"]), ("3", ["b", "c", "d"]), ("4", ["c"])]
    found = urlrules.match(spark.createDataFrame(sets, "signature string, tokens array<string>"), rules).collect()
    assert {r.signature: r.confidence for r in found} == {"1": 0.8, "3": 0.9, "4": 0.7}


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test-components").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in (200, 201, 202)}


def test_blocks_of_large_buckets_lose_no_pair(spark):
    """Tiny blocks, so that buckets and groups are cut: the same components as in one piece."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
        base = text if i % 3 == 0 else base
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    cut = near_dedup.near_duplicates(docs, near_dedup.NearDedup(bucket_block=5, group_block=1000)).collect()
    assert {r.doc_id: r.component_id for r in cut} == whole and len(set(whole.values())) < 30
