from __future__ import annotations

import random
import re
from itertools import combinations

from tierline.llm.ngram_join import _intersections, components, join, one_of_each, one_text_of_each, op7_ngram_jaccard_join, runs_needed

SMALL = "/root/testdata/sf0.001"


def brute(rows, threshold=0.8, size=5):
    """Links and components over all pairs that share a shingle."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[top(a)] = top(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (least[top(i)], links[i]) for i, (d, _) in enumerate(rows)}


def changed(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_all_documents_equal_brute_force(spark, small):
    got = {r.doc_id: (r.class_id, r.n_links) for r in op7_ngram_jaccard_join(spark, SMALL).collect()}
    assert got == brute(small)


def test_large_groups_are_split_and_compared_in_blocks(docs, monkeypatch):
    import tierline.llm.ngram_join as module

    monkeypatch.setattr(module, "_SMALL", 8)
    monkeypatch.setattr(module, "_TEXTS", 16)
    monkeypatch.setattr(module, "_IDS", 32)
    rng = random.Random(5)
    texts = []
    for g in range(4):
        words = [f"g{g}w{i}" for i in range(120)]
        texts += [changed(words, rng.randrange(5), rng) for _ in range(50)]
        texts += [" ".join(words)] * 3
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.class_id, r.n_links) for r in join(docs(texts, extra=["cid", "sig", "rep", "node"])).collect()}
    assert got == brute(rows)


def test_short_null_and_repeated(docs):
    rows = [(5, "a b", "s"), (3, "a b", "s"), (7, "a  b", "s"), (8, None, "s"), (9, "", "s"), (None, "a b", "s"), (3, "a b", "s")]
    got = sorted((r.doc_id or -1, r.class_id, r.n_copies, r.n_links) for r in join(docs(rows)).collect())
    # equal words in another spacing are another text with the same set
    assert got == [(-1, None, 1, 0), (3, 3, 3, 3), (3, 3, 3, 3), (5, 3, 3, 3), (7, 3, 1, 3), (8, 8, 1, 0), (9, 9, 1, 0)]
    assert join(docs([])).count() == 0


def test_one_of_each_keeps_the_smallest(docs):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(4, text, "s"), (2, text + " x", "s"), (2, text + " x", "s"), (6, "other", "s"), (None, text, "s")]
    assert sorted(r.doc_id or -1 for r in one_of_each(docs(rows, extra=["class_id"])).collect()) == [-1, 2, 6]


def test_components_of_long_chains(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 1001: 1000}


def test_intersections_both_ways():
    import numpy as np

    rng = np.random.default_rng(3)
    tokens = [np.unique(rng.integers(0, 400, 120).astype(np.uint64)) for _ in range(30)]
    a, b = map(np.array, zip(*combinations(range(30), 2)))
    exact = [len(set(tokens[x]) & set(tokens[y])) for x, y in zip(a, b)]
    assert _intersections(tokens, a, b).tolist() == exact
    assert _intersections(tokens, a[:1], b[:1]).tolist() == exact[:1]


def test_more_runs_for_more_recall():
    assert runs_needed(0.8, 0.9999, 2) > runs_needed(0.8, 0.9, 2) >= 1


def test_no_row_is_lost(docs):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words, "s"), (1, None, "s"), (2, words, "s"), (3, None, "s"), (1, " \n", "s"), (2, "other words", "s"), (None, None, "s")]
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_copies, r.n_links) for r in join(docs(rows)).collect())
    assert got == [(0, 0, 1, 0), (1, 1, 1, 0), (1, 1, 1, 0), (1, 1, 2, 1), (2, 1, 2, 1), (2, 2, 1, 0), (3, 3, 1, 0)]


def test_one_text_of_each_judges_rows_by_their_text(docs):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(60))
    rows = [
        (4, text(0), "s"), (2, text(0) + " x", "s"), (2, text(0) + " x", "s"), (None, text(0), "s"), (None, text(0) + " y", "s"),
        (2, text(1), "s"), (9, None, "s"), (9, "", "s"), (None, None, "s"), (None, "", "s"), (7, text(2), "s"),
        (None, text(3), "s"), (None, text(3), "s"), (None, text(3) + " z", "s"),
    ]
    frame = docs(rows, extra=["o_doc", "digest", "cid"])
    kept = one_text_of_each(frame)
    assert kept.columns == frame.columns
    found = sorted((r.doc_id or 0, (r.text or "")[:4]) for r in kept.collect())
    assert found == [(0, ""), (0, ""), (0, "t3w0"), (2, "t0w0"), (2, "t1w0"), (7, "t2w0"), (9, "")]
    assert one_text_of_each(docs([])).count() == 0


def test_a_third_without_id_is_deduplicated_too(docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(80)]
    rows = [(i if i % 3 else None, changed(words, rng.randrange(2), rng), "s") for i in range(60)]
    rows += [(1000 + i, " ".join(f"own{i}w{k}" for k in range(20)), "s") for i in range(10)]
    found = [r.doc_id for r in one_text_of_each(docs(rows)).collect()]
    assert sorted(found) == [1, *range(1000, 1010)]


def test_recall_at_the_depth_that_splits_reach(docs, monkeypatch):
    """Small nodes force splits down to the last depth; pairs at the threshold are still met."""
    import tierline.llm.ngram_join as module

    monkeypatch.setattr(module, "_SMALL", 2)
    rng = random.Random(12)
    texts = []
    for g in range(60):
        words = [f"g{g}w{i}" for i in range(100)]
        texts += [" ".join(words), changed(words, 2, rng)]  # ten of 96 shingles differ: a similarity of about 0.81
    want = brute(list(enumerate(texts)))
    got = {r.doc_id: (r.class_id, r.n_links) for r in join(docs(texts)).collect()}
    linked = [d for d, (_, n) in want.items() if n]
    assert len(linked) > 40 and sum(got[d] == want[d] for d in linked) >= 0.9 * len(linked)
    assert module.runs_needed(0.8, 0.9999, module._DEPTH) >= module.runs_needed(0.8, 0.9999, 2)


def test_one_text_of_each_joins_classes_not_rows(docs):
    """Groups are named by their classes; their plan has the roots and the rows that are kept, each once."""
    text = " ".join(f"w{i}" for i in range(30))
    frame = one_text_of_each(docs([(4, text, "s"), (2, text + " x", "s"), (None, text, "s"), (9, "one other text of words", "s")]))
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert sorted(r.doc_id for r in frame.collect()) == [2, 9]
