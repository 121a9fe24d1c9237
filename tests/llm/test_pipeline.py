"""Each pipeline stage on all that its predecessor kept, against a plain version of the stage."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from compare import connect
from duebook.llm.queries import ORACLE

from llm.brute import base_spans, near_components, shingles

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """{stage: (rows in, rows out)} by id, each stage written and read again."""
    root, found = tmp_path_factory.mktemp("stages"), {}
    path = f"{sf}/documents.parquet"
    for number, (name, run) in enumerate(corpus_pipeline.STAGES):
        before = spark.read.parquet(path)
        out = run(spark, before, sf)
        path = f"{root}/{number}"
        out.write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns[: len(before.columns)] == before.columns
        found[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}, f"{root}/{number - 1}")
    return found


def test_toxic_documents_go(spark, sf, stages):
    before, after, _ = stages["toxicity"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(after[i] == before[i] for i in after)
    known = [i for i in before if i in labels]
    assert sum((i in after) == (labels[i] == 0) for i in known) >= 0.95 * len(known)
    assert sum(i not in after for i in before if labels.get(i) == 0) <= 0.01 * len(known)


def test_one_of_each_group_stays(stages):
    before, after, _ = stages["near duplicates"]
    roots = near_components({i: r.text for i, r in before.items()}, 80)
    assert set(after) == {i for i in before if roots[i] == i}
    assert all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, sf, stages):
    before, after, _ = stages["benchmark decontamination"]
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for i, r in before.items():
        own = shingles(r.text)
        if any(item <= own for item in items):
            assert i not in after
        elif not any(item & own for item in items):
            assert after[i] == r


def test_personal_data_is_masked_and_nothing_else(stages):
    before, after, _ = stages["personal data"]
    assert set(after) == set(before)
    changed = 0
    for i, r in before.items():
        spans, text = base_spans(r.text), after[i].text
        assert not base_spans(text) and after[i].n_chars == len(text)
        if not spans:
            assert text == r.text
            continue
        changed += 1
        marks = {"EMAIL", "IP", "CARD", "PHONE", "IBAN", "SSN"}
        pieces = [text]
        for mark in marks:
            pieces = [p for piece in pieces for p in piece.split(f"<{mark}>")]
        at = 0
        for piece in pieces:  # what is left of the text stands in it in order
            at = r.text.index(piece, at) + len(piece)
    assert changed


def test_the_mix_is_that_of_sql(stages):
    before, after, path = stages["mixing"]
    con = connect("/root/testdata/sf0.001")
    con.execute(f"create or replace view documents as select * from '{path}/*.parquet'")
    wanted = {}
    cursor = con.execute(ORACLE["op8_mixing"])
    names = [d[0] for d in cursor.description]
    for row in cursor.fetchall():
        r = dict(zip(names, row, strict=True))
        wanted[r["doc_id"]] = r["taken"] // r["size"] if r["size"] else None
    for i in before:
        if wanted[i] is not None:
            assert (after[i].mix_copies if i in after else 0) == wanted[i]
