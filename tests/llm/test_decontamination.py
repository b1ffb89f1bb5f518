from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from tierline.llm.decontamination import COLUMN_BITS, SKETCH_ROWS, Parts, _CLEAN, _sketch, blocks, common, fitted, inverse_frequencies, leak_free, leaks, op6_benchmark_decontamination, without_leaks

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def words_of(text):
    return (text or "").encode().translate(_CLEAN).split()


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    return row[-1]


def brute(docs, items):
    """Every passage against every item by the subsequence and answer checks alone."""
    found = set()
    for d, text in docs:
        w = words_of(text)
        for i, item in items:
            x = words_of(item)
            for a in range(0, max(1, len(w) - 24), 24):
                near = w[max(0, a - 24) : a + 72]
                n = common(x, near)
                if x and (n >= 0.75 * len(x) or (n >= 0.55 * len(x) and common(x[-5:], near) >= 0.8 * len(x[-5:]))):
                    found.add((d, i))
                    break
    return found


def test_recall_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    expected = brute(docs, items)
    got = {(r.doc_id, r.item_id) for r in op6_benchmark_decontamination(spark, MEDIUM).collect()}
    assert got <= expected and len(got & expected) >= 0.9 * len(expected) > 0


def prose(rng, n):
    return [f"v{rng.randrange(4000)}" for _ in range(n)]


def test_paraphrases_are_found_and_clean_documents_left(docs, spark):
    rng = random.Random(11)
    items = [(i, " ".join(prose(rng, 20 + i))) for i in range(30)]
    texts = []
    for i, text in items:  # one word in six replaced, one in ten left out, the answer kept
        words = text.split()
        body = [f"z{rng.randrange(99)}" if rng.random() < 0.16 else w for w in words[:-5] if rng.random() > 0.1]
        texts.append(" ".join([*prose(rng, rng.randrange(80)), *body, *words[-5:], *prose(rng, rng.randrange(80))]))
    texts += [" ".join(prose(rng, 150)) for _ in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(texts, extra=["item_id", "overlap", "leaking_doc_id"])
    got = {(r.doc_id, r.item_id) for r in leaks(frame, bench).collect()}
    assert len(got & {(i, i) for i in range(30)}) >= 27 and all(d == i for d, i in got)
    assert {r.doc_id for r in without_leaks(frame, bench).collect()} == set(range(90)) - {d for d, _ in got}


def test_long_items_are_found_in_parts(docs, spark):
    rng = random.Random(2)
    item = prose(rng, 200)
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    frame = docs([" ".join([*prose(rng, 50), *item[96:160], *prose(rng, 50)]), " ".join(prose(rng, 100))])
    assert [(r.doc_id, r.item_id) for r in leaks(frame, bench).collect()] == [(0, 7)]


def test_null_empty_and_repeated(docs, spark):
    rng = random.Random(3)
    text = " ".join(prose(rng, 30))
    bench = spark.createDataFrame([(1, text), (2, text), (3, None), (4, ""), (None, text)], "item_id long, text string")
    rows = [(None, text, "s"), (5, text, "s"), (5, text, "s"), (6, None, "s"), (7, "", "s")] + [(100 + i, " ".join(prose(rng, 40)), "s") for i in range(20)]
    got = sorted((r.doc_id or 0, r.item_id or 0) for r in leaks(docs(rows), bench).collect())
    assert got == [(0, 0), (0, 1), (0, 2), (5, 0), (5, 0), (5, 1), (5, 1), (5, 2), (5, 2)]
    kept = without_leaks(docs(rows), bench)
    assert {r.doc_id for r in kept.collect()} == {None, 6, 7, *range(100, 120)}
    assert leaks(docs([]), bench).count() == 0
    assert leaks(docs(rows), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_the_basis_keeps_the_items_apart(docs):
    rng = random.Random(4)
    frame = docs([" ".join(prose(rng, 100)) for _ in range(50)])
    parts = Parts([(i, " ".join(prose(rng, 30))) for i in range(40)])
    basis = fitted(frame, inverse_frequencies(frame), parts)
    between = basis.queries @ basis.queries.T
    assert np.allclose(basis.directions.T @ basis.directions, np.eye(basis.directions.shape[1]), atol=1e-3)
    assert between.diagonal().min() > 0.9 and (between - np.diag(between.diagonal())).max() < 0.5


@pytest.mark.parametrize("seed", range(20))
def test_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 70))] for _ in range(2))
    assert common(a, b) == slow_common(a, b)


def changed(rng, words):
    """The words, one in six replaced and one in ten left out, the last five kept."""
    return [f"z{rng.randrange(99)}" if rng.random() < 0.16 else w for w in words[:-5] if rng.random() > 0.1] + words[-5:]


@pytest.mark.parametrize("paraphrased", [False, True])
def test_recall_does_not_depend_on_the_size_of_the_benchmark(docs, spark, paraphrased):
    rng = random.Random(21)
    corpus = [r.text.split() for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").orderBy("doc_id").limit(600).collect()]
    vocabulary = [w for text in corpus for w in text]  # words as frequent as there
    items = [rng.choices(vocabulary, k=rng.randrange(16, 60)) for _ in range(1_020)]
    texts = [" ".join([*t[:60], *(changed(rng, x) if paraphrased else x), *t[60:120]]) for t, x in zip(corpus[:300], items)]
    texts += [" ".join(t[:150]) for t in corpus[300:]]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs(texts), bench).collect()}
    print(f"found {len(got)} of 300")
    assert len(got) >= 0.9 * 300 and all(d == i for d, i in got)


def test_blocks_hold_as_many_parts_as_the_basis_has_dimensions():
    rng = random.Random(5)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([30, 0, 200, 30, 30, 2_000, 30])]
    found = list(blocks(iter(items), 6))
    assert [[p.item for p in block] for block in found][0] == [[0, 2, 2, 2, 2, 3]]
    assert all(len(p.words) <= 6 for block in found for p in block)
    assert [i for block in found for i in dict.fromkeys(i for p in block for i in p.item)] == [0, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("share", [0.1, 0.33, 1.0])
def test_items_that_leaked_into_many_documents_are_found(docs, spark, share):
    rng = random.Random(31)
    corpus = [r.text.split() for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").orderBy("doc_id").limit(600).collect()]
    vocabulary = [w for text in corpus for w in text]
    items = [rng.choices(vocabulary, k=n) for n in (16, 20, 24, 30, 36, 44, 50, 58)]
    texts, planted = [], set()
    for d, t in enumerate(corpus):
        t, at = t[:160], rng.randrange(30, 90)
        if rng.random() < share:
            i = rng.randrange(8) if share < 0.3 else d % 2
            t = [*t[:at], *items[i], *t[at:]]
            planted.add((d, i))
        texts.append(" ".join(t))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs(texts), bench).collect()}
    print(f"found {len(got & planted)} of {len(planted)}, others {len(got - planted)}")
    assert len(got & planted) >= 0.95 * len(planted) and got <= planted


def test_rows_are_judged_by_themselves(docs, spark):
    rng = random.Random(6)
    text, other = " ".join(prose(rng, 30)), " ".join(prose(rng, 30))
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = [(None, text, "s"), (None, other, "s"), (None, None, "s"), (5, text, "s"), (5, other, "s"), (6, "", "s")]
    rows += [(100 + i, " ".join(prose(rng, 40)), "s") for i in range(20)]
    frame = docs(rows, extra=["leaks", "item_id"])
    kept = leak_free(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in frame.collect() if r.text != text)
    assert {r.doc_id for r in corpus_rows(spark, frame, bench)} == {None, 5, 6, *range(100, 120)}
    assert leak_free(frame, spark.createDataFrame([], "item_id long, text string")).count() == len(rows)


def corpus_rows(spark, frame, bench):
    """What the pipeline's stage keeps; no row that holds the item."""
    import tempfile

    import corpus_pipeline

    folder = tempfile.mkdtemp(prefix="run-")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    kept = corpus_pipeline.decontamination(spark, frame, folder).collect()
    assert not {r.text for r in kept} & {r.text for r in bench.collect()}
    return kept


def test_words_that_stand_together_share_their_directions(docs):
    """A passage of other words than the item's, which stand where those stand in the corpus, is near it in the latent
    space; plain TF-IDF sees nothing in common, and without its leading directions the space does not either."""
    import pyarrow as pa

    from tierline.llm.decontamination import _Words

    rng = random.Random(13)
    subjects = [([f"s{k}a{i}" for i in range(12)], [f"s{k}b{i}" for i in range(12)]) for k in range(8)]
    corpus = []
    for _ in range(400):  # either word of a pair, with equal chance, among words of no subject
        a, b = rng.choice(subjects)
        text = [rng.choice((a[i], b[i])) for i in (rng.randrange(12) for _ in range(40))]
        corpus.append(" ".join(w for pair in zip(text, prose(rng, 40)) for w in pair))
    frame = docs(corpus)
    items = [(k, " ".join(rng.choices(a, k=24))) for k, (a, _) in enumerate(subjects)]
    items += [(100 + k, " ".join(prose(rng, 24))) for k in range(192)]
    parts = Parts(items)
    idf = inverse_frequencies(frame)
    basis = fitted(frame, idf, parts, rank=10)
    assert basis.directions.shape[1] == 10 < len(parts.words)
    words = _Words(pa.array([" ".join(rng.choices(b, k=48)) for _, b in subjects]))
    of_subjects = lambda found: {(d, parts.item[q]) for d, _, _, q, _ in found if parts.item[q] < 8}
    assert of_subjects(basis.near(words, 0.35, 9.0)) == {(k, k) for k in range(8)}
    # Plain TF-IDF: not a column in common.
    item_columns = [set(c.tolist()) for c in parts.columns[:8]]
    own = [set(words.column[words.first[k] : words.first[k + 1]].tolist()) for k in range(8)]
    assert not any(own[k] & item_columns[k] for k in range(8))
    # The directions are what finds them: without the leading ones most are not near.
    wide = fitted(frame, idf, parts, rank=60)
    weak = type(wide)(idf, parts, np.flatnonzero(wide.place >= 0), wide.directions[:, 10:])
    assert len(of_subjects(weak.near(words, 0.35, 9.0)) & {(k, k) for k in range(8)}) <= 2


@pytest.mark.parametrize("n", [40, 200])
def test_recall_of_copies_and_paraphrases_by_the_size_of_the_benchmark(docs, spark, n):
    rng = random.Random(n)
    corpus = [r.text.split() for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").orderBy("doc_id").limit(500).collect()]
    vocabulary = [w for text in corpus for w in text]
    items = [rng.choices(vocabulary, k=rng.randrange(16, 60)) for _ in range(n)]
    texts = [" ".join([*t[:60], *(changed(rng, items[d % n]) if d % 2 else items[d % n]), *t[60:120]]) for d, t in enumerate(corpus[:300])]
    texts += [" ".join(t[:150]) for t in corpus[300:]]
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs(texts), bench).collect()}
    want = {(d, d % n) for d in range(300)}
    assert len(got & want) >= 0.9 * 300 and got <= want


def test_one_scan_of_the_documents_whatever_the_number_of_items(docs, spark):
    rng = random.Random(8)
    frame = docs([" ".join(prose(rng, 60)) for _ in range(30)])
    bench = spark.createDataFrame([(i, " ".join(prose(rng, 40))) for i in range(1_020)], "item_id long, text string")
    plan = leaks(frame, bench)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan


def test_the_basis_is_fitted_on_all_documents(docs, spark):
    """Words that only documents beyond the first thousand by hash of the id hold have a part in the directions."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from tierline.llm.decontamination import _Words, _fitted_blocks

    rng = random.Random(13)
    order = [r.id for r in spark.range(1_400).orderBy(F.xxhash64("id"), "id").collect()]
    subjects = [([f"s{k}a{i}" for i in range(12)], [f"s{k}b{i}" for i in range(12)]) for k in range(8)]
    rows = [(i, " ".join(prose(rng, 20)), "s") for i in order[:1_000]]
    for i in order[1_000:]:
        a, b = rng.choice(subjects)
        text = [rng.choice((a[j], b[j])) for j in (rng.randrange(12) for _ in range(40))]
        rows.append((i, " ".join(w for pair in zip(text, prose(rng, 40)) for w in pair), "s"))
    items = [(k, " ".join(rng.choices(a, k=24))) for k, (a, _) in enumerate(subjects)]
    items += [(100 + k, " ".join(prose(rng, 24))) for k in range(192)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    [[basis]] = _fitted_blocks(docs(rows), bench)
    words = _Words(pa.array([" ".join(w for _, b in subjects for w in b)]))
    assert np.linalg.norm(basis.directions[basis.place[words.column]], axis=1).min() > 0.05


def test_the_driver_holds_the_sketch_once(docs, spark):
    """The parts of the sketch come one after another, so that the driver never holds them beside the whole."""
    frame = docs([" ".join(f"w{(i * 131 + j * 17) % 9_973}" for j in range(400)) for i in range(60)]).select("doc_id", "text")
    columns = 4_096
    place = np.arange(1 << COLUMN_BITS, dtype=np.int32) % columns
    tracemalloc.start()
    try:
        sketch = _sketch(frame, np.ones(1 << COLUMN_BITS, np.float32), place, SKETCH_ROWS, columns)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sketch.shape == (SKETCH_ROWS, columns) and np.count_nonzero(sketch.any(1)) > 500
    assert peak < 1.5 * sketch.nbytes


def test_the_driver_holds_few_copies_of_the_basis(monkeypatch):
    """The basis of many columns takes a few times its own size on the driver, beside the sketch."""
    from tierline.llm import decontamination

    rng = random.Random(3)
    parts = Parts([(k, " ".join(f"v{rng.randrange(40_000)}" for _ in range(40))) for k in range(200)])
    idf = np.random.default_rng(4).uniform(1, 9, 1 << COLUMN_BITS).astype(np.float32)
    given = []

    def sketch(docs, idf, place, rows, columns):
        given.append(np.random.default_rng(5).standard_normal((300, columns), np.float32))
        return given[0]

    monkeypatch.setattr(decontamination, "_sketch", sketch)
    tracemalloc.start()
    try:
        basis = fitted(None, idf, parts)
        peak = tracemalloc.get_traced_memory()[1] - given[0].nbytes
    finally:
        tracemalloc.stop()
    own = basis.directions
    assert own.shape == (len(given[0][0]), 128) and np.abs(own.T @ own - np.eye(128)).max() < 1e-4
    assert peak < 8 * own.nbytes
