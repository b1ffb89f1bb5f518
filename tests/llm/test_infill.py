from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm.infill import SkipList, infilled, line_lengths, op13_fill_in_middle, restored


def plain(doc_id, text, seed=7, rate=100, spm=50):
    """The whole operator once more, without lanes."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    i, j = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < spm else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("n", [0, 1, 2, 5, 64, 1000])
def test_lanes_reach_every_rank(n):
    lengths = np.random.default_rng(n).integers(1, 50, n)
    lanes = SkipList(lengths)
    assert [lanes.before(k) for k in range(n + 1)] == [0, *np.cumsum(lengths).tolist()]
    assert n < 64 or len(lanes.units) > 2
    for units, points in zip(lanes.units, lanes.points):  # any lane passes over what the lane below it does
        assert units.sum() <= n and points.sum() == lengths[: units.sum()].sum()


def test_units():
    for text in ("", "\n", "a", "a\n", "a\nb", "\n\n", "é😀\r\n\x0b x\n\n"):
        assert line_lengths(text).tolist() == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


TEXTS = [
    None, "", "\n", "one line", "a\nb\nc\nd\n", "x <P> y\nz", "<S>", "a\n<M", "<\nP>\n<", "M>\n<S\n<", "\n" * 300, "é😀\r\n" * 2000, "tab\t\n\x00\nq",
    "word " * 400_000, "a line of a very long text\n" * 60_000,
]


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_rows_equal_brute_force(docs, rate, spm):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(4, "a\nb\nc\nd\n", "s"), (4, "other\ntext", "s"), (None, "no\nid\n", "s"), (2**60 + 1, "a\nb", "s")]
    frame = infilled(docs(rows, extra=["n", "form", "draws", "output"]), rate=rate, spm=spm)
    got = frame.withColumn("back", restored(F.col("form"), F.col("output"))).collect()
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), str(r[5]))
    want = sorted(((i, *plain(i, t, rate=rate, spm=spm)) for i, t, _ in rows), key=key)
    assert sorted((tuple(r)[:6] for r in got), key=key) == want
    assert sorted(r.back for r in got) == sorted(t or "" for _, t, _ in rows)


def test_all_documents(spark, small):
    got = {r.doc_id: r for r in op13_fill_in_middle(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert len(got) == len(small)
    for i, t in small:
        n, form, a, m, out = plain(i, t)
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, a, m, sha(out), sha(t or ""))


def test_empty_table(docs):
    assert infilled(docs([])).count() == 0
