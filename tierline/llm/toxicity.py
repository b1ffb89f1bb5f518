"""Toxicity by a classifier chain: each category's linear model also reads the probabilities of the categories before
it, and is trained on out-of-fold predictions of these."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import slices

#: Words by which a document labelled toxic also belongs to a category, for a chain of named categories.
#: Without names the categories are found in the data (`kinds_of`). Each chain ends with "toxic".
CATEGORIES = {
    "insult": ("clown", "idiot", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "pathetic", "scum", "trash", "worthless"),
}
#: Labelled rows used at most (half of them of either label), features, and folds.
SAMPLE, FEATURES, FOLDS = 8_000, 256, 5
#: Categories that are found where none are named, and the evidence that makes a document of a further kind, as a share
#: of that of its strongest one.
KINDS, BESIDE = 3, 1 / 3

_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Bytes of a stem, and how many words of one stem are told apart.
_HEADS, _TIMES = (4, 6), 3


def words_in(text: str) -> set[bytes]:
    return set(text.lower().encode().translate(_WORDS).split())


def stems_in(words: Iterable[bytes]) -> set[bytes]:
    """stem*k for the first bytes of words, for each k up to the number of different words that begin so."""
    counts = Counter(w[:n] for w in words for n in _HEADS if len(w) > n)
    return {b"%s*%d" % (stem, k + 1) for stem, c in counts.items() for k in range(min(c, _TIMES))}


def terms_in(text: str) -> set[bytes]:
    words = words_in(text)
    return words | stems_in(words)


@dataclass
class Chain:
    """Weights by category: an intercept, one a term, one for each earlier category. threshold: of the last."""

    terms: list[bytes]
    categories: list[str]
    weights: list[np.ndarray]
    threshold: float
    kinds: dict[str, list[bytes]] | None = None  # the terms of each category that was found

    def __post_init__(self) -> None:
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.heads = {t.split(b"*")[0][: _HEADS[0]] for t in self.terms}

    def features(self, text: str) -> list[int]:
        near = [w for w in words_in(text) if w[: _HEADS[0]] in self.heads]
        return sorted({self.place[t] for t in [*near, *(stems_in(near) if near else ())] if t in self.place})

    def probabilities(self, features: list[int]) -> list[float]:
        earlier: list[float] = []
        for w in self.weights:
            z = w[0] + w[1 + np.array(features, int)].sum() + w[1 + len(self.terms) :] @ np.array(earlier)
            earlier.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return earlier


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method; the first column is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return w


def fitted(terms: list[bytes], names: list[str], rows: list[tuple[list[int], list[int], int, float]], folds: int) -> Chain:
    """The chain from rows of (features, labels by category, fold, weight)."""
    x = np.zeros((len(rows), 1 + len(terms)))
    x[:, 0] = 1
    for r, (features, *_) in enumerate(rows):
        x[r, [1 + i for i in features]] = 1
    fold, weight = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    models, out_of_fold = [], np.zeros(len(rows))
    for k in range(len(names)):
        y = np.array([r[1][k] for r in rows], float)
        out_of_fold = np.zeros(len(rows))
        for f in range(folds):
            train, test = fold != f, fold == f
            if train.any() and test.any():
                out_of_fold[test] = 1 / (1 + np.exp(-np.clip(x[test] @ _logistic(x[train], y[train], weight[train]), -30, 30)))
        models.append(_logistic(x, y, weight))
        x = np.column_stack([x, out_of_fold])
    y = np.array([r[1][-1] for r in rows], float)
    order = np.argsort(-out_of_fold, kind="stable")
    hit, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / np.maximum(all_ + (weight * y).sum(), 1e-9)
    best = int(np.argmax(f1)) if len(rows) else 0
    # Midway between the last document that is called toxic and the next.
    scores = np.append(out_of_fold[order], 0.0) if len(rows) else np.array([1.0, 1.0])
    return Chain(terms, names, models, float(np.clip((scores[best] + scores[best + 1]) / 2, 0.05, 0.95)))


def kinds_of(toxic: np.ndarray, evidence: np.ndarray, kinds: int, rounds: int = 50) -> np.ndarray:
    """The kind, from 0, of every term: terms that toxic documents use together are of one kind.

    `toxic` has a row a toxic document and a column a term, 1 where it occurs; `evidence` is a term's weight. Spherical
    k-means over the centred columns, from the term of most evidence and then from the strongest ones least alike
    those taken; ties go to the first term, so reruns agree. Kinds are numbered by falling evidence.
    """
    centred = toxic - toxic.mean(axis=0)
    length = np.linalg.norm(centred, axis=0)
    unit = centred / np.where(length > 1e-9, length, 1)
    # The evidence that toxic documents hold by a term, the same by whichever of its columns.
    mass = evidence * toxic.sum(axis=0)
    taken: list[int] = []
    nearest = np.full(len(mass), -1.0)
    for _ in range(min(kinds, len(mass))):
        gain = mass * (1 - np.maximum(nearest, 0))
        gain[taken] = -1
        taken.append(int(np.argmax(gain)))
        nearest = np.maximum(nearest, unit[:, taken[-1]] @ unit)
    middle = unit[:, taken]
    kind = np.argmax(middle.T @ unit, axis=0)
    for _ in range(rounds):
        pulled = np.stack([(unit * (mass * (kind == k))).sum(axis=1) for k in range(len(taken))], axis=1)
        length = np.linalg.norm(pulled, axis=0)
        middle = np.where(length > 1e-9, pulled / np.where(length > 1e-9, length, 1), middle)
        before, kind = kind, np.argmax(middle.T @ unit, axis=0)
        if (kind == before).all():
            break
    order = np.argsort([-mass[kind == k].sum() for k in range(len(taken))], kind="stable")
    return np.argsort(order)[kind]


def labelled_by_kind(rows: list[tuple[list[int], int]], n_terms: int, kinds: int) -> tuple[np.ndarray, list[list[int]]]:
    """The kind of each term, and for each of `rows` (features, toxic) a label a kind.

    Evidence is the log odds of a document's terms between toxic and other rows. A toxic document is of the kind that
    it holds most evidence of, and of those that it holds BESIDE times as much of. Documents without evidence and all
    others are of none.
    """
    x = np.zeros((len(rows), n_terms))
    for r, (features, _) in enumerate(rows):
        x[r, features] = 1
    y = np.array([r[1] for r in rows], bool)
    odds = np.log((x[y].sum(axis=0) + 0.5) / (y.sum() + 1)) - np.log((x[~y].sum(axis=0) + 0.5) / ((~y).sum() + 1))
    evidence = np.maximum(odds, 0)
    if not n_terms or not y.any():
        return np.zeros(n_terms, int), [[0] * kinds for _ in rows]
    kind = kinds_of(x[y], evidence, kinds)
    held = np.stack([x @ (evidence * (kind == k)) for k in range(kinds)], axis=1)
    most = held.max(axis=1, keepdims=True)
    of = (held >= most * BESIDE) & (most > 0) & y[:, None]
    return kind, of.astype(int).tolist()


def names_of(categories: dict | None, kinds: int = KINDS) -> list[str]:
    """The links of a chain: the named categories, or kind_1 to kind_n, and toxic."""
    return [*(categories if categories is not None else (f"kind_{k + 1}" for k in range(kinds))), "toxic"]


def trained(
    docs: DataFrame, labels: DataFrame, categories: dict | None = CATEGORIES, sample: int = SAMPLE, features: int = FEATURES, kinds: int = KINDS
) -> Chain | None:
    """The chain, from `sample` labelled documents at most; None where either label is missing.

    The sample takes each label's documents in the order of a hash of their id, half of the bound each, and weighs
    them back to their numbers. An id with several labels is toxic if one of them says so. Its terms are counted by Spark; the strongest `features` by G-squared and the sample's
    rows, in these features, come to the driver. With None for `categories`, the links before the last are `kinds`
    categories found among the sample's toxic documents.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("label")
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))  # toxic if any label of the id says so
    numbers = dict(known.groupBy("label").count().collect())
    if len(numbers) < 2:
        return None
    parts = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for k in (0, 1)]
    chosen = parts[0].unionByName(parts[1])  # `sample` rows of two numbers at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    texts = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            both = (Counter(), Counter())
            for y, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                both[y].update(terms_in(text))
            terms = [*(both[0].keys() | both[1].keys())]
            yield pa.record_batch(
                [pa.array(terms, pa.binary()), *(pa.array([c[t] for t in terms], pa.int64()) for c in both)], names=["term", "b", "a"]
            )

    counts = texts.mapInArrow(listed, "term binary, b long, a long").groupBy("term").agg(
        F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b")
    )
    n_a, n_b = (float(max(1, min(numbers[k], sample // 2))) for k in (1, 0))
    share = (F.col("a") + F.col("b")) / (n_a + n_b)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    strength = sum(
        (part(x, e) for x, e in ((F.col("a"), share * n_a), (F.col("b"), share * n_b), (n_a - F.col("a"), (1 - share) * n_a), (n_b - F.col("b"), (1 - share) * n_b))),
        F.lit(0.0),
    )
    strongest = (
        counts.where("a + b >= 5").withColumn("g", strength).where(F.col("a") / n_a > F.col("b") / n_b).orderBy(F.desc("g"), "term").limit(int(min(features, n_a))).select("term").collect()
    )
    names = names_of(categories, kinds)
    bare = Chain(sorted(bytes(r[0]) for r in strongest), names, [], 0.5)
    seeds = [{w.encode() for w in words} for words in (categories or {}).values()]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, y, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))):
                words = words_in(text)
                rows.append((doc_id, bare.features(text), [int(bool(y and words & s)) for s in seeds] + [y]))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))],
                names=["doc_id", "features", "labels"],
            )

    rows = texts.mapInArrow(marked, "doc_id long, features array<int>, labels array<int>")
    # Of the texts of one id, the one of the first features, so that reruns agree.
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("features", "labels")).alias("own")).select("doc_id", "own.*")
    rows = rows.select("features", "labels", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).alias("fold"), "doc_id").collect()
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        return None
    weight = {1: numbers[1] / n_a, 0: numbers[0] / n_b}
    if categories is not None:
        return fitted(bare.terms, names, [(r["features"], r["labels"], r["fold"], weight[r["labels"][-1]]) for r in rows], FOLDS)
    kind, of = labelled_by_kind([(r["features"], r["labels"][-1]) for r in rows], len(bare.terms), kinds)
    chain = fitted(bare.terms, names, [(r["features"], [*k, r["labels"][-1]], r["fold"], weight[r["labels"][-1]]) for r, k in zip(rows, of)], FOLDS)
    chain.kinds = {name: [t for t, k in zip(bare.terms, kind) if k == i] for i, name in enumerate(names[:-1])}
    return chain


def scored(docs: DataFrame, chain: Chain | None, categories: dict | None = CATEGORIES) -> DataFrame:
    """For each row of `docs`: doc_id, a probability p_<category> each, and toxic (the last one reaches the threshold).

    NULL and empty texts have no term; a row without doc_id is judged too; repeated rows get repeated results. Without
    a chain (nothing to learn from) probabilities, by the names of `categories`, are NULL and toxic is false. Only doc_id
    and text are read.
    """
    names = [f"p_{c}" for c in (chain.categories if chain else names_of(categories))]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if chain is None:
        return base.select("doc_id", *[F.lit(None).cast("double").alias(n) for n in names], F.lit(False).alias("toxic"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.float64()) for n in names], ("toxic", pa.bool_())])
        for batch in slices(batches, "text"):
            p = [chain.probabilities(chain.features(t or "")) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), *zip(*p), [x[-1] >= chain.threshold for x in p]]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return base.mapInArrow(judge, ", ".join(["doc_id long", *[f"{n} double" for n in names], "toxic boolean"]))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the chain calls toxic, out of all, with their probabilities: of three kinds of toxic documents
    found in the labelled ones, and of being toxic at all.

    NULL and empty texts are not toxic, rows without doc_id are judged, repeated rows come repeatedly; no labels or
    labels of one value, no rows.
    """
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    return scored(docs, trained(docs, labels, None), None).where("toxic")
