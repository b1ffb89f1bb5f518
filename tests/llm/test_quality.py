from __future__ import annotations

import re
from collections import Counter

from tierline.llm.quality import BOILERPLATE, NAVIGATION, SEPARATORS, clean, measured, op1_quality_rules

SMALL = "/root/testdata/sf0.001"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def fails(line):
    """The line rules once more, written plainly."""
    low = line.lower()
    ended = line.rstrip("\"'’”»)] \t\x0b\f\r")[-1:] in list(".!?;:…。！？") or any(s + " " in line for s in ".!?")
    if not ended or line.count("!!") * 16 > len(line) or len(re.findall(r"[#*$%&|<>]", line)) * 10 > len(line):
        return True
    parted = len(re.findall(f" [{SEPARATORS}] ", line)) * 24 > len(line)
    return parted or low in NAVIGATION or any(p in low for p in BOILERPLATE)


def kept(text):
    n, *_, failed = base(text)
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    lost = sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines if fails(x))
    return not failed and 100 * lost <= 30 * n


def test_all_documents_equal_brute_force(spark, small):
    got = {r.doc_id: r for r in op1_quality_rules(spark, SMALL).collect()}
    for doc_id, text in small:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text)
        assert r.kept == kept(text)


def test_hard_texts_equal_brute_force(docs):
    texts = [
        None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "x " * 5000, "a b a b a b a", "é😀 ü b\n\n\né😀 ü b",
        "same line.\n" * 30, "w" * 100_000, " ".join(str(i) for i in range(30_000)) + ".", "x\x0by\x0cz\rw",
    ]
    rows = {r.doc_id: r for r in measured(docs(texts)).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.q_words, r.q_word_chars, r.q_symbols, r.q_dup_lines, r.q_repeat_words, r.q_base_failed) == base(text), text[:20]


def test_long_texts_of_many_windows_equal_brute_force(docs):
    """Many windows share the bits that the first sort compares; only truly equal ones count."""
    words = [f"w{i}" for i in range(300_000)]
    texts = [" ".join(words), " ".join(words + words[1000:1005]), " ".join([*words[:40], *words[20:40]] * 500)]
    rows = {r.doc_id: r.q_repeat_words for r in measured(docs(texts)).collect()}
    assert [rows[i] for i in range(3)] == [base(t)[4] for t in texts] and rows[0] == 0 and rows[1] == 10


def test_lines_that_break_rules_are_removed(docs):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    text = f"Home\n{good}\nWe use cookies and more here.\na | b | c | d | e\nSHOUT!! LOUD!! NOW!!"
    row = clean(docs([text, "short."], extra=["q_row", "q_words", "words"])).collect()
    assert [(r.doc_id, r.text, r.n_chars, r.q_row, r.q_words) for r in row] == [(0, good, len(good), "own q_row", "own q_words")]


def test_a_document_that_loses_too_much_is_rejected(docs):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    bad = " ".join(f"junk{i} |" for i in range(80))
    assert [r.q_kept for r in measured(docs([good, f"{good}\n{bad}"])).orderBy("doc_id").collect()] == [True, False]


def test_empty_table_and_repeated_rows(docs):
    assert measured(docs([])).count() == 0 and clean(docs([])).count() == 0
    good = " ".join(f"word{i}" for i in range(80)) + "."
    assert clean(docs([(1, good, "s"), (1, good, "s"), (None, good, None)])).count() == 3
