from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm.licenses import NOTICES, PHRASES, Notice, notices_in, op5_license_scan, words_line

SMALL = "/root/testdata/sf0.001"


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def base_of(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_all_documents_equal_brute_force(spark, small):
    got = {r.doc_id: r for r in op5_license_scan(spark, SMALL).collect()}
    for i, text in small:
        assert base_of(got[i]) == brute(text)
        assert set(got[i].base_labels.split(",")) - {""} <= set(got[i].labels.split(",")) and 0 <= got[i].score <= 1


def test_hard_texts_equal_brute_force(docs):
    texts = [
        None, "", "CC BY", "cc-by cc by. Cc by", "cc by cc by", "ALL RIGHTS RESERVED all\nrights\treserved", "xcc by cc byx",
        "ÄLL rights reserved é cc by", "general public license " * 3000, "a" * 100_000, "K cc by", "all rights all rights reserved",
    ]
    got = {r.doc_id: r for r in notices_in(docs(texts, extra=["spans", "labels", "score"])).collect()}
    for i, text in enumerate(texts):
        assert base_of(got[i]) == brute(text), text


def test_edited_notices_are_found_with_their_spans(docs):
    texts = [
        "foo This is Licenced under the Apach License here", "so all rihgts reserved now", "the GNU Genral Public Licens ok",
        "released undr the MIT license", "Licensed under CC BY-NC 4.0.", "nothing of the kind here",
    ]
    got = {r.doc_id: r for r in notices_in(docs(texts)).collect()}
    assert [got[i].labels for i in range(6)] == ["apache", "reserved", "gpl", "mit", "cc-by,cc-by-nc", ""]
    span = got[1].spans[0]
    assert (span.first, span.end, span.label) == (1, 4, "reserved") and 1 <= span.edits <= 2
    assert got[4].score == 1 and 0 < got[1].score < 1 and got[5].score == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, len(NOTICES) - 1), st.lists(st.tuples(st.integers(0, 60), st.sampled_from("xdr")), max_size=4))
def test_a_notice_within_its_edits_is_always_a_candidate(which, edits):
    text, label, most = NOTICES[which]
    letters = list(text)
    for place, kind in edits[:most]:
        k = place % len(letters)
        if letters[k] != " ":
            letters[k] = {"x": "q", "d": "", "r": letters[k] + "q"}[kind]
    line, _ = words_line(f"before {''.join(letters)} after")
    inner = line.strip()[len("before ") : -len(" after")]
    if inner and distance(inner, text) <= most:
        assert Notice(text, label, most).found(line)


def test_empty_table_null_ids_and_repeats(docs):
    assert notices_in(docs([])).count() == 0
    assert notices_in(docs([(None, "cc by", "s"), (1, "cc by", "s"), (1, "cc by", "s")])).where("n_base = 1").count() == 3


def test_long_texts_full_of_hits(docs):
    """Work in proportion to the text: 400,000 phrases and 40,000 notices in one text each."""
    import time

    texts = ["cc by " * 400_000, "general publik license x " * 40_000]
    begun = time.time()
    got = {r.doc_id: r for r in notices_in(docs(texts)).collect()}
    assert time.time() - begun < 60
    assert (got[0].n_base, got[0].first_word, got[0].last_word) == (400_000, 0, 799_998)
    assert got[1].n_base == 0 and got[1].labels == "gpl" and len(got[1].spans) == 40_000
    assert [tuple(s)[:2] for s in got[1].spans[:2]] == [(0, 3), (4, 7)]


def test_best_spans_equal_comparing_all_with_all():
    import random

    from tierline.llm.licenses import best_spans

    draw = random.Random(4)
    for _ in range(50):
        spans = [(a, a + draw.randrange(1, 9), draw.choice("xy"), draw.randrange(3), 0.0) for a in (draw.randrange(60) for _ in range(40))]
        slow = []
        for s in sorted(spans, key=lambda s: (s[3], s[0] - s[1])):
            if not any(s[2] == t[2] and s[0] < t[1] and t[0] < s[1] for t in slow):
                slow.append(s)
        assert best_spans(spans) == slow
