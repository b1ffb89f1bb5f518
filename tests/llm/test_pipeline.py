from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tierline.llm.shared import settled

SMALL = "/root/testdata/sf0.001"
sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SMALL))
        out.append(docs.collect())
    return out


def test_stages_equal_brute_force(stages, spark):
    import test_decontamination
    import test_ngram_join
    import test_pii
    import test_quality

    first, cleaned, single, free, private, mix = stages
    kept = {r.doc_id for r in first if test_quality.kept(r.text)}
    assert {r.doc_id for r in cleaned} == kept
    before = {r.doc_id: r.text for r in first}
    for r in cleaned:
        lines = [x for x in before[r.doc_id].split("\n") if x.strip(test_quality.SPACE)]
        good = [x for x in lines if not test_quality.fails(x)]
        assert r.text == (before[r.doc_id] if good == lines else "\n".join(good))
    classes = test_ngram_join.brute([(r.doc_id, r.text) for r in cleaned])
    assert {r.doc_id for r in single} == {c for c, _ in classes.values()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {d for d, _ in test_decontamination.brute([(r.doc_id, r.text) for r in single], items)}
    assert {r.doc_id for r in free} == {r.doc_id for r in single} - bad
    text = {r.doc_id: r.text for r in free}
    assert {r.doc_id for r in private} == set(text)
    for r in private:
        assert bool(re.search(r"\[(EMAIL|IP|CARD|PHONE|SECRET)\]", r.text)) >= bool(test_pii.base(text[r.doc_id]))
        assert not any(k == "email" for k, _, _ in test_pii.base(r.text))
    assert {r.doc_id for r in mix} <= set(text) and all(1 <= r.repeats <= 3 for r in mix)


def test_columns_stay_and_run_equals_its_stages(stages, spark):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all([*rows[0].asDict()] == names for rows in stages[:-1])
    assert [*stages[-1][0].asDict()] == [*names, "repeats"]
    assert all(r.n_chars == len(r.text) for rows in stages[1:] for r in rows)
    got = sorted((r.doc_id, r.text, r.repeats) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == sorted((r.doc_id, r.text, r.repeats) for r in stages[-1])


def test_extra_columns_pass_through_every_stage(docs, spark):
    extra = ["q_row", "m_row", "p_row", "cid", "leaking_doc_id", "repeat"]
    good = " ".join(f"word{i}" for i in range(90)) + "."
    frame = docs([good, good, None, ""], extra=extra)
    for _, stage in corpus_pipeline.STAGES:
        frame = settled(stage(spark, frame, SMALL))
        assert set(extra) <= set(frame.columns)
    assert [(r.doc_id, r.p_row, r.m_row) for r in frame.collect()] == [(0, "own p_row", "own m_row")]
