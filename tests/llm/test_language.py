from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm import language
from tierline.llm.language import Automaton, Parser, identified, op12_language_id, samples

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("data", [b"", b"a", b"aaaa", b"abcbc", b"mississippi", bytes(random.Random(1).choices(b"abc", k=120))])
def test_automaton_holds_every_part_and_no_other(data):
    parts = {data[i:j] for i in range(len(data)) for j in range(i, len(data) + 1)} | {b""}
    states = Automaton(data).next

    def follows(part):
        s = 0
        for c in part:
            if c not in states[s]:
                return False
            s = states[s][c]
        return True

    assert all(follows(p) for p in parts) and len(states) <= max(2, 2 * len(data))
    assert not any(follows(p + bytes([c])) for p in parts for c in b"abcmisp" if p + bytes([c]) not in parts)


def plain_phrases(parser, sample, text):
    """Greedy phrases by searching the sample itself, block by block."""
    inside = parser.symbols(sample).tobytes()
    data = parser.symbols(text).tobytes()
    total = 0
    for at in range(0, len(data), language._BLOCK):
        block, i = data[at : at + language._BLOCK], 0
        while i < len(block):
            n = 1
            while i + n < len(block) and block[i : i + n + 1] in inside and block[i : i + 1] in inside:
                n += 1
            total += 1
            i += n
    return total


def test_phrases_equal_a_search_in_the_sample(monkeypatch):
    monkeypatch.setattr(language, "_BLOCK", 100)
    draw = random.Random(7)
    make = lambda letters, n: "".join(draw.choices(letters, k=n)).encode()
    learned = {"x": make("abc  é", 600), "y": make("abcd .", 400), "z": make("xyz", 50)}
    parser = Parser(learned)
    texts = [b"", b" ", "ß\x80€".encode(), *[make("abcdéx 1,", draw.randrange(1, 450)) for _ in range(40)]]
    sizes, total = parser.phrases(texts)
    for t, n, row in zip(texts, sizes, total):
        assert n == len(parser.symbols(t))
        assert row.tolist() == [plain_phrases(parser, learned[x], t) for x in parser.languages], t


def test_held_out_documents(spark):
    got = {r.doc_id: r for r in op12_language_id(spark, SMALL).collect()}
    want = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
    tested = [r for r in got.values() if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang_pred == want[r.doc_id].lang for r in tested)
    assert len(tested) > 200 and right / len(tested) > 0.97


ENGLISH, GERMAN = "the quick brown fox jumps over the lazy dog and runs away ", "der schnelle braune fuchs springt über den faulen hund und läuft weg "


def test_null_ties_repeats_and_unlabelled(docs):
    rows = [(i, ENGLISH * 3 if i % 2 else GERMAN * 3, "s") for i in range(40)]
    rows += [(100, None, "s"), (101, "", "s"), (102, "123 456 !", "s"), (None, GERMAN, "s"), (3, "the fox " * 50_000, "s"), (3, ENGLISH * 3, "s"), (104, "日本", "s")]
    frame = docs(rows, extra=["held_out", "score", "state"]).withColumn("lang", F.expr("CASE WHEN doc_id IS NULL THEN 'no' WHEN doc_id > 90 THEN NULL WHEN doc_id % 2 = 1 THEN 'en' ELSE 'de' END"))
    learned = samples(frame)
    assert sorted(learned) == ["de", "en"]
    got = identified(frame, learned).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is None:
            assert (r.lang_pred, r.held_out) == ("de", False)
        elif r.doc_id < 90:
            assert r.lang_pred == ("en" if r.doc_id % 2 else "de")
        else:
            assert r.lang_pred in learned and r.score < 0.2
    assert samples(frame.where("doc_id > 90")) == {} and {r.lang_pred for r in identified(frame, {}).collect()} == {"und"}
    assert identified(docs([]), learned).count() == 0 and samples(docs([])) == {}


def test_sample_reads_only_rows_that_are_not_held_out(docs):
    rows = [(i, ("held " if zlib.crc32(str(i).encode()) % 4 == 2 else "free ") * 40, "s") for i in range(300)]
    learned = samples(docs(rows), rows=20, excerpt=50)
    assert b"held" not in learned["en"] and len(learned["en"]) == 20 * 51


def test_scores_do_not_depend_on_neighbours(docs, small):
    learned = {"en": ENGLISH.encode() * 4, "de": GERMAN.encode() * 4}
    parser = Parser(learned)
    texts = [t or "" for _, t in small]
    alone = [parser.predict([t])[0] for t in texts]
    assert parser.predict(texts) == alone
    assert np.isfinite([s for _, s in alone]).all()
