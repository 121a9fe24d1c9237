"""The conversation trie, the lexical search and the n-gram join against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, duck_rows, spark_rows
from duebook.llm import lexical, prefix_join, trie
from duebook.llm.queries import ORACLE, QUERIES
from duebook.llm.running import running_sums
from pyspark.sql import functions as F

from llm import brute

TURN = "conv_id long, turn long, role string, text string"
DOC = "doc_id long, text string"


def nodes_of(rebuilt):
    """{conv_id: turns} to the rows of the trie's nodes."""
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(k[:-1] for k in members if k)
    rows = set()
    for key, convs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(key))
        rows.add(
            (
                min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), children[key],
                sum(not children[k] for k in below),
                sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return rows


def ordered_turns(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}


def spliced_turns(own):
    rebuilt = {}
    for c, turns in own.items():
        heads = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:heads] + turns[heads:]
    return rebuilt


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", ["op3_near_dedup", "op4_topk", "op11_prefix_trie", "op12_lexical_search", "op13_ngram_join"])
def test_query_equals_sql(spark, sf, name):
    assert spark_rows(QUERIES[name](spark, sf)) == duck_rows(connect(sf), ORACLE[name])


def test_trie_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = tuples(QUERIES["op11_prefix_trie"](spark, sf))
    assert len(found) == len(set(found)) and set(found) == nodes_of(spliced_turns(ordered_turns(rows)))


def test_trie_of_long_shared_and_empty_conversations(spark):
    """Deeper than a band of bands, with branches at every depth, nulls, repeated rows and extra columns."""
    rows = [(c, t, "user", f"turn {t}" if t < 45 - c else f"own {c} {t}") for c in range(9) for t in range(50 - 3 * c)]
    rows += [(20, None, "user", "first"), (20, 1, None, None), (21, 0, "user", "turn 0"), (21, 0, "user", "turn 0")]
    rows += [(None, 0, "user", "turn 0"), (1001, 1, "a", "b")]
    table = spark.createDataFrame(rows, TURN).withColumns({c: F.lit(5) for c in ("place", "depth", "k1", "saved")})
    table = table.repartition(5)
    want = nodes_of(ordered_turns([r for r in rows if r[0] is not None]))
    for band in (2, 3, 8):
        found = tuples(trie.conversation_trie(table, band))
        assert len(found) == len(want) and set(found) == want
    places = trie.turn_places(table)
    base = F.col("conv_id") - F.col("conv_id") % 100
    spliced = trie.spliced(places, base, F.crc32(F.col("conv_id").cast("string")) % 6)
    want = nodes_of(spliced_turns(ordered_turns([r for r in rows if r[0] is not None])))
    assert set(tuples(trie.prefix_nodes(*spliced))) == want
    assert trie.conversation_trie(spark.createDataFrame([], TURN)).count() == 0


def test_ends_of_one_node_are_hashed_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    ids = list(range(-20, 400))
    ends = spark.createDataFrame([(1, 2, i) for i in ids] + [(1, 3, 4)], "k1 long, k2 long, conv_id long").repartition(6)
    found = {r[:2]: r[2] for r in tuples(trie._end_digests(ends))}
    assert found == {(1, 2): hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (1, 3): hashlib.sha256(b"4").hexdigest()}


def test_running_sums_of_a_key_over_many_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), i, int(v)) for i, (k, v) in enumerate(zip(rng.choice([1, 2, 5, 6], 3000, p=[0.9, 0.04, 0.03, 0.03]), rng.integers(-(1 << 62), 1 << 62, 3000), strict=True))]
    found = running_sums(spark.createDataFrame(rows, "k long, o long, v long").repartition(7), "k", ["o"], ["v"], "running-test")
    so_far, want = defaultdict(int), set()

    def wrapped(x):
        return (x + (1 << 63)) % (1 << 64) - (1 << 63)

    for k, o, v in rows:
        before = wrapped(so_far[k])
        so_far[k] += v
        want.add((k, o, v, before, wrapped(so_far[k])))
    assert found.columns == ["k", "o", "v", "v_before", "v_upto"]
    assert set(tuples(found)) == want
    # a key whose rows are all equal in the order is split as well
    same = running_sums(spark.createDataFrame([(1, 0, 1)] * 500, "k long, o long, v long").repartition(4), "k", ["o"], ["v"], "running-test")
    assert sorted(r[4] for r in tuples(same)) == list(range(1, 501))


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall((text or "").translate(brute.A_TO_Z))


def ranked(docs, items, k):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    rows = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * n // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms_of(text)
            )
            scores.append((-score, doc is None, doc))
        scores = sorted(s for s in scores if s[0])[:k]
        rows += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(scores)]
    return rows


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("p", [lexical.Lexical(k=3), lexical.Lexical(k=2, bits=3, block_rows=5, block_terms=9, first_batch=1, df_rows=6)])
def test_search_of_odd_documents(spark, p):
    """Nulls, ties, copies, repeated ids, long texts; a tiny sketch and small batches change no result."""
    words = "ash beech cedar elm fir Zürich été 木 x1".split()
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "... !"), (103, "elm-FIR,elm"), (3, "fir cedar"), (3, "fir cedar"), (None, "cedar cedar")]
    docs += [(200 + i, "ash oak") for i in range(40)] + [(300, "elm " * 70_000), (301, "oak")]
    items = [(0, "elm fir"), (0, "ash"), (1, "Cedar CEDAR beech"), (2, None), (3, "nowhere"), (None, "oak"), (5, "木 été, Zürich"), (6, "?")]
    table = spark.createDataFrame(docs, DOC).withColumns({c: F.lit(1) for c in ("d1", "n", "sketch", "item", "rank", "score")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(1) for c in ("item", "terms", "doc_id")})
    found = lexical.search(table.repartition(4), asked, p)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert key(tuples(found)) == key(ranked(docs, items, p.k))


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOC), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], DOC)
    assert lexical.search(docs, one.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert lexical.search(one, items).count() == 0


def test_bounds_are_never_below_scores(spark, docs, sf):
    p = lexical.Lexical(bits=6)
    index = lexical.lexical_index(spark.read.parquet(f"{sf}/documents.parquet"), p)
    sketches = index.where("sketch is not null and n > 0").limit(200).toArrow().to_batches()
    items = [{"item": 0, "terms": lexical._term_counts(_array("und the de que la"))[1].view(np.int64).tolist(), "tfs": [1, 2, 1, 1, 3]}]
    block = lexical.Block(items, {}, 1000, 300_000, p.bits)
    for batch in sketches:
        bounds = lexical._bounds(batch, block, *block.bound_weights())[:, 0]
        for doc_id, n, bound in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), bounds, strict=True):
            text, terms, tf, _ = lexical._term_counts(_array(docs[doc_id].text))
            m = block.length_factor(np.array([n]))[0]
            at = {int(t): int(lexical.impacts(np.array([f]), m)[0]) for t, f in zip(terms.view(np.int64), tf, strict=True)}
            score = sum(block.weight[i] * f * at.get(int(block.vocabulary.view(np.int64)[i]), 0) for i, f in zip(block.terms[0], block.tfs[0], strict=True))
            assert bound >= score


def _array(text):
    import pyarrow as pa

    return pa.array([text])


def join_components(docs, percent, size):
    """Row-wise components over (id, text): the list of (id, set size, smallest id reachable)."""
    sets = [brute.shingles(t, size) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                up[max(root(a), root(b))] = min(root(a), root(b))
    least = defaultdict(list)
    for row, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(row)].append(doc)
    return [
        (doc, len(sets[row]), (min(least[root(row)], default=None) if sets[row] else doc)) for row, (doc, _) in enumerate(docs)
    ]


def test_join_query_equals_brute_force(docs, result):
    want = {i: len(brute.shingles(r.text, 4)) for i, r in docs.items()}
    rows = result("op13_ngram_join")
    assert len(rows) == len(docs) and all(r.n_shingles == want[r.doc_id] for r in rows)
    shingles = brute.shingles
    try:
        brute.shingles = lambda text: shingles(text, 4)
        assert {r.doc_id: r.component_id for r in rows} == brute.near_components({i: r.text for i, r in docs.items()}, 85)
    finally:
        brute.shingles = shingles


@pytest.mark.parametrize(
    "p",
    [
        prefix_join.PrefixJoin(counter_bits=10, chunk_bits=8),
        prefix_join.PrefixJoin(counter_bits=4, chunk_bits=8, short_list=2, held_pairs=3, block_grams=300, block_members=5),
        prefix_join.PrefixJoin(percent=60, size=2, counter_bits=8, chunk_bits=4, block_members=9),
    ],
)
def test_join_of_edited_texts(spark, p):
    """Copies, near copies around the threshold, common lines, nulls, short texts, repeated and missing ids."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(40)]
    docs, line = [], " ".join(f"common{i}" for i in range(14))
    for family in range(12):
        base = list(rng.choice(words, rng.integers(6, 60)))
        for copy in range(rng.integers(1, 9)):
            text = list(base)
            for _ in range(rng.integers(0, 4)):
                text[rng.integers(len(text))] = str(rng.choice(words))
            if family % 3 == 0:
                text.append(line)
            docs.append((len(docs), " ".join(text)))
    docs += [(500, None), (501, ""), (502, " \t"), (503, "one two"), (504, "ONE  two"), (505, "two one"), (506, line), (507, line)]
    docs += [(0, docs[5][1]), (0, "an own text under a used id"), (None, docs[3][1]), (None, "nobody has this one text"), (None, "nobody has this one text")]
    table = spark.createDataFrame(docs, DOC).withColumns({c: F.lit(1) for c in ("n", "d1", "class", "group", "prefix", "gram")})
    found = tuples(prefix_join.prefix_join(table.repartition(5), p).select("doc_id", "n_shingles", "component_id"))
    assert key(found) == key(join_components(docs, p.percent, p.size))


def test_join_of_an_empty_table(spark):
    assert prefix_join.prefix_join(spark.createDataFrame([], DOC), prefix_join.PrefixJoin(counter_bits=6)).count() == 0
