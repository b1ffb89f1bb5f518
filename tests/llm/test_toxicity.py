from __future__ import annotations

import random

import pytest

from tierline.llm.toxicity import CATEGORIES, scored, stems_in, trained

MEDIUM = "/root/testdata/sf0.1"
LABELS = "doc_id long, toxic int, quality int"


def corpus(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice([*CATEGORIES["insult"], *CATEGORIES["contempt"]])
        texts.append(" ".join(words))
        labels.append((i, int(toxic), 1))
    return texts, labels


def test_held_out_accuracy_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic")
    chain = trained(docs, labels.where("doc_id % 2 = 0"))
    rows = scored(docs, chain).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id").collect()
    hit = sum(r.toxic and r.label == 1 for r in rows)
    assert hit / sum(r.label == 1 for r in rows) > 0.85
    assert hit / sum(r.toxic for r in rows) > 0.9


def test_chain_has_a_weight_for_each_earlier_category(docs, spark):
    texts, labels = corpus(400, 1)
    chain = trained(docs(texts), spark.createDataFrame(labels, LABELS))
    assert chain.categories == ["insult", "contempt", "toxic"]
    assert [len(w) - 1 - len(chain.terms) for w in chain.weights] == [0, 1, 2]
    held, truth = corpus(200, 2)
    got = {r.doc_id: r for r in scored(docs(held, extra=["label", "features"]), chain).collect()}
    assert all(got[i].toxic == bool(y) for i, y, _ in truth)
    assert all(0 <= p <= 1 for r in got.values() for p in (r.p_insult, r.p_contempt, r.p_toxic))


def test_the_sample_bound_holds(docs, spark):
    texts, labels = corpus(400, 3)
    assert trained(docs(texts), spark.createDataFrame(labels, LABELS), sample=80, features=16).weights[0].shape == (17,)


def test_nothing_to_learn_from(docs, spark):
    texts, labels = corpus(20, 4)
    assert trained(docs(texts), spark.createDataFrame([], LABELS)) is None
    assert trained(docs(texts), spark.createDataFrame([(i, 0, 1) for i in range(20)], LABELS)) is None
    row = scored(docs(texts), None).first()
    assert row.p_toxic is None and row.toxic is False


def test_null_empty_and_repeated(docs, spark):
    texts, labels = corpus(200, 5)
    chain = trained(docs(texts + [None, ""]), spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1), (0, 1, 1)], LABELS))
    rows = scored(docs([(None, "idiot moron scum", "s"), (1, None, "s"), (1, "", "s"), (1, "", "s")]), chain).collect()
    assert [r.toxic for r in rows] == [True, False, False, False]
    assert scored(docs([]), chain).count() == 0


@pytest.mark.parametrize("words,expected", [([], set()), ([b"abcd"], set()), ([b"abcde", b"abcdf"], {b"abcd*1", b"abcd*2"})])
def test_stems(words, expected):
    assert stems_in(words) == expected


def test_repeated_ids_with_other_labels_and_texts_give_the_same_chain(docs, spark):
    from tierline.llm.toxicity import trained

    rows = [(i, f"nice calm words {i % 7} " * 5 if i % 2 else f"stupid trash clown {i % 5} " * 5, "s") for i in range(80)]
    rows += [(i, "another text of the same id", "s") for i in range(0, 80, 9)]
    labels = [(i, 1 - i % 2) for i in range(80)] + [(i, 1) for i in range(1, 80, 8)] + [(3, None)]
    frames = [(docs(rows).repartition(k), spark.createDataFrame(labels, "doc_id long, toxic int").repartition(k)) for k in (1, 5)]
    one, two = (trained(d, l) for d, l in frames)
    assert one.terms == two.terms and one.threshold == two.threshold
    assert all((a == b).all() for a, b in zip(one.weights, two.weights))


def test_chain_equals_a_plain_one_on_all_rows(docs, spark):
    """Every probability once more, link by link: a logistic function of the terms and of the links before."""
    import math

    from tierline.llm.toxicity import scored, terms_in, trained

    rows = [(i, f"nice calm words {i % 7} number{i}", "s") if i % 3 else (i, f"stupid loser trash {i % 5} number{i}", "s") for i in range(120)]
    frame = docs(rows)
    chain = trained(frame, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in scored(frame, chain).collect()}
    for i, text, _ in rows:
        present = [1.0 if t in terms_in(text) else 0.0 for t in chain.terms]
        links = []
        for w in chain.weights:
            z = w[0] + sum(a * b for a, b in zip(w[1:], [*present, *links]))
            links.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        r = got[i]
        assert [r.p_insult, r.p_contempt, r.p_toxic] == pytest.approx(links) and r.toxic == (links[-1] >= chain.threshold)


def kinds_corpus(n, seed):
    """Every third document is toxic: by one invented vocabulary, by another, or by both."""
    rng = random.Random(seed)
    groups = [["zorbak", "quenlid", "mivrost"], ["thalpon", "werdigo", "jusmeck"]]
    texts, labels, truth = [], [], []
    for i in range(n):
        words = [f"w{rng.randrange(200)}" for _ in range(40)]
        own = ([0], [1], [0, 1])[rng.randrange(3)] if i % 3 == 0 else []
        for g in own:
            for word in rng.sample(groups[g], 2):
                words[rng.randrange(40)] = word
        present = set(words)
        texts.append(" ".join(words))
        labels.append((i, int(bool(own)), 1))
        truth.append([bool(present & set(g)) for g in groups])
    return groups, texts, labels, truth


def test_kinds_are_found_in_the_documents(docs, spark):
    from tierline.llm.toxicity import terms_in

    groups, texts, labels, _ = kinds_corpus(600, 6)
    chain = trained(docs(texts), spark.createDataFrame(labels, LABELS), None, features=12, kinds=2)
    assert chain.categories == ["kind_1", "kind_2", "toxic"]
    assert [len(w) - 1 - len(chain.terms) for w in chain.weights] == [0, 1, 2]
    assert sorted(t for k in chain.kinds.values() for t in k) == chain.terms
    kind_of = {t: k for k, terms in chain.kinds.items() for t in terms}
    found = [{kind_of[t] for w in g for t in terms_in(w) if t in kind_of} for g in groups]
    assert [len(f) for f in found] == [1, 1] and found[0] != found[1]

    _, held, wanted, truth = kinds_corpus(300, 7)
    got = {r.doc_id: r for r in scored(docs(held), chain, None).collect()}
    names = [f"p_{next(iter(f))}" for f in found]
    right = sum((got[i][name] > 0.5) == truth[i][g] for i in range(300) for g, name in enumerate(names))
    assert right / 600 > 0.97
    assert sum(got[i].toxic == bool(y) for i, y, _ in wanted) / 300 > 0.97


def test_kinds_do_not_depend_on_partitions_and_need_no_evidence(docs, spark):
    _, texts, labels, _ = kinds_corpus(150, 8)
    one, two = (trained(docs(texts).repartition(n), spark.createDataFrame(labels, LABELS).repartition(n), None) for n in (1, 5))
    assert one.kinds == two.kinds and all((a == b).all() for a, b in zip(one.weights, two.weights))
    same = trained(docs(["alike"] * 60), spark.createDataFrame([(i, i % 2, 1) for i in range(60)], LABELS), None)
    assert same.terms == [] and same.kinds == {"kind_1": [], "kind_2": [], "kind_3": []}
    assert scored(docs([None, "", "alike"]), same, None).count() == 3
    assert scored(docs(["x"]), None, None).columns == ["doc_id", "p_kind_1", "p_kind_2", "p_kind_3", "p_toxic", "toxic"]


def test_more_kinds_than_terms():
    import numpy as np

    from tierline.llm.toxicity import kinds_of, labelled_by_kind

    toxic = np.array([[1, 0, 1], [0, 1, 0], [1, 0, 1], [0, 1, 0]], float)
    assert kinds_of(toxic, np.array([1.0, 5.0, 1.0]), 2).tolist() == [1, 0, 1]
    assert set(kinds_of(toxic, np.ones(3), 9)) <= {0, 1, 2}
    kind, of = labelled_by_kind([([0, 2], 1), ([1], 1), ([0, 1], 1), ([], 1), ([], 0), ([], 0)], 3, 2)
    assert kind[0] == kind[2] != kind[1]
    assert [of[0], of[1], of[3], of[4]] == [[int(kind[0] == k) for k in (0, 1)], [int(kind[1] == k) for k in (0, 1)], [0, 0], [0, 0]]
