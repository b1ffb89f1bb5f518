from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm.whitening import components, op11_embedding_whitening, planes_of, sliced_products, whitened

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, n string, white string"


def plain(vectors, most=8):
    """n, S, V as fractions and the axes, from whole integers."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    v = np.array([[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3)) for j in range(d)] for i in range(d)])
    return x, n, s, v


@pytest.mark.parametrize("n,high", [(1, 5), (63, 2048), (64, 1), (1000, 4096), (200, 1 << 40), (70, 1 << 58)])
def test_products_of_planes(n, high):
    y = np.random.default_rng(n).integers(0, high, (n, 5))
    y[:, 3] = 0
    want = y.astype(object).T @ y.astype(object)
    assert (np.triu(sliced_products(y)) == np.triu(want)).all()
    words, dims, places = planes_of(y)
    assert len(words) == len(dims) == len(places) == sum(int(c.max()).bit_length() for c in y.T)


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 0, "own id", "own n", "own white") for i, v in rows], SCHEMA)

    return make


def check(got, kept, most=8):
    x, n, s, v = plain([e for _, e in kept], most)
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    trace = np.trace(v)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    for k, rows in by.items():
        assert len(rows) == n
        assert all(r.n == n and abs(r.explained - values[k - 1] / trace) < 1e-9 and r.identity_error < 1e-9 for r in rows)
        deviations = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
        assert sorted((r[0] is None, r[0] or 0, int(r.deviation)) for r in rows) == sorted((i is None, i or 0, z) for (i, _), z in zip(kept, deviations))
    return x, n, s, v, by


def test_small_table_equals_numpy(spark):
    source = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = op11_embedding_whitening(spark, SMALL).collect()
    x, n, s, v, by = check(got, source)
    assert sorted(by) == list(range(1, 9))
    values, axes = np.linalg.eigh(v)
    where = {i: k for k, (i, _) in enumerate(source)}
    centred = np.array(x) - np.array(s) / n
    for k in range(1, 9):
        want = centred @ axes[:, -k] / np.sqrt(values[-k])
        mine = np.empty(n)
        for r in by[k]:
            mine[where[r.vec_id]] = r.whitened
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8


def test_null_ties_repeats_and_other_lengths(vectors):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, -0.3]), (1, [0.1, 0.2, -0.3]), (2, [0.5, -0.25, 0.0]), (None, [0.0, 0.0, 1.0]), (3, [-1.0, 2.0, 0.125]), (4, [-0.0001, 0.0, 0.0])]
    bad = [(5, None), (6, []), (7, [0.1, None, 0.2]), (8, [nan, 0.0, 0.0]), (9, [0.0, -inf, 0.0]), (10, [1e30, 0.0, 0.0]), (11, [0.5, 0.5]), (12, [1.0] * 5)]
    check(whitened(vectors(good + bad)).collect(), good)


def test_wide_entries_and_few_directions(vectors):
    rows = [(i, [float(2**14 * i), 1.0, float(i % 3)]) for i in range(9)]
    assert sorted(check(whitened(vectors(rows)).collect(), rows)[-1]) == [1, 2]
    rows = [(i, [float(2**44 * i), 1.0, float(i % 3)]) for i in range(9)]  # the second is below the first's rounding error
    assert sorted(check(whitened(vectors(rows)).collect(), rows)[-1]) == [1]
    assert whitened(vectors([(i, [1.0, 2.0]) for i in range(5)])).count() == 0  # no direction at all
    assert whitened(vectors([])).count() == 0
    assert whitened(vectors([(1, None)])).count() == 0


def test_blocks_and_tasks_add_up(vectors, monkeypatch):
    from tierline.llm import whitening

    monkeypatch.setattr(whitening, "_BLOCK", 64)
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=4).astype(np.float32).tolist()) for i in range(500)]
    frame = vectors(rows).repartition(3).withColumn("hot", F.lit(1))
    check(whitened(frame, most=3).collect(), rows, 3)


def test_components_are_exact_for_offsets_far_from_zero():
    x = [[10**17 + a, 10**17 - 2 * a + b] for a, b in ((0, 0), (1, 0), (2, 1), (3, 0))]
    s = [sum(c) for c in zip(*x)]
    products = [[sum(r[i] * r[j] for r in x) for j in range(2)] for i in range(2)]
    fit = components(4, s, products, 8)
    near = np.array(x, object) - 10**17
    assert np.allclose(fit.values, np.sort(np.linalg.eigvalsh(np.cov(near.astype(float).T, bias=True)))[::-1])
