from __future__ import annotations

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa

from tierline.llm import substring
from tierline.llm.substring import op8_substring_dedup, repeats

SMALL = "/root/testdata/sf0.001"


def brute(rows, window=13):
    """Windows in a dictionary, by the smallest document."""
    rows = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in rows:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, y in zip(w, gone) if not y)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_all_documents_equal_brute_force(spark, small):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op8_substring_dedup(spark, SMALL).collect()}
    assert got == brute(small)


def test_planted_repeats_at_every_offset(docs):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words)]
    for shift in range(16):  # the passage begins at every place of an aligned block
        texts.append(" ".join([f"a{shift}x{i}" for i in range(shift)] + words[20:33] + ["end"]))
        texts.append(" ".join([f"b{shift}x{i}" for i in range(shift)] + words[20:32] + ["end"]))  # one word short
    texts += ["\t".join(words[5:30]), "x " * 40, "x " * 50, None, "", "one", texts[0]]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats(docs(texts, extra=["hits", "found", "blob"])).collect()}
    assert got == brute(rows)


def test_spans_are_maximal(docs):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(["p", "q", *words[3:30], "r", *words[10:25]])]
    row = repeats(docs(texts)).where("doc_id = 1").first()
    assert [(s.start, s.end) for s in row.spans] == [(2, 29), (30, 45)] and row.kept == "p q r"


def test_unordered_ids_and_other_windows(docs):
    words = [f"w{i}" for i in range(30)]
    rows = [(9, " ".join(words), "s"), (-3, " ".join(words[4:20]), "s"), (5, " ".join(words[10:]), "s")]
    got = {r.doc_id: r.n_removed for r in repeats(docs(rows), window=5).collect()}
    assert got == {i: x[1] for i, x in brute([(i, t) for i, t, _ in rows], 5).items()}


def test_null_ids_repeated_rows_and_empty_tables(docs):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, "s"), (1, text, "s"), (1, text, "s"), (2, text, "s"), (2, text, "s")]
    got = sorted((r.doc_id or 0, r.n_removed) for r in repeats(docs(rows)).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 20), (2, 20)]
    assert repeats(docs([])).count() == 0


def test_a_hot_passage_stays_small(docs):
    """A passage in all documents is sent once a slice, not once a document."""
    words = " ".join(f"h{i}" for i in range(30))
    got = repeats(docs([f"own{i} {words} tail{i}" for i in range(3000)])).collect()
    assert sum(r.n_removed == 30 for r in got) == 2999


def test_large_ids_next_to_null(docs):
    words = " ".join(f"w{i}" for i in range(40))
    big = 2**53 + 1
    rows = [(big, words, "s"), (None, words, "s"), (big + 2, words + " end", "s"), (None, "few words", "s"), (-(2**62) - 1, "own text", "s")]
    got = repeats(docs(rows).coalesce(1)).collect()
    assert sorted(((r.doc_id or 0), r.n_words, r.n_removed) for r in got) == [
        (-(2**62) - 1, 2, 0), (0, 2, 0), (0, 40, 0), (big, 40, 0), (big + 2, 41, 40)
    ]


def test_lanes_spread_ids_with_a_pattern():
    import numpy as np

    from tierline.llm.substring import _by_lane

    ids = np.arange(-500, 500, dtype=np.int64) * 4_096
    lanes = [lane for lane, _ in _by_lane(ids, ids.astype(np.uint64), 64)]
    assert len(lanes) == len(set(lanes)) > 60 and all(0 <= x < 64 for x in lanes)


def _bucket(rng, n, kinds, senders=40):
    """A bucket as `senders` slices send it, n entries in all, and the same as arrays."""
    blobs, rows = [], []
    for ids in np.array_split(np.arange(senders * 5, dtype=np.int64), senders):
        size = n // senders
        own = np.sort(rng.choice(ids, size))
        parts = [rng.integers(0, 2, size).astype(bool) if k is bool else rng.integers(0, 8 * n, size).astype(k) for k in kinds]
        blobs.append(substring._packed(own, *[np.packbits(x) if x.dtype == bool else x for x in parts]))
        rows.append([own, *parts])
    return pa.table([pa.array([3] * senders), pa.array(blobs, pa.binary())], schema=substring._SENT), [np.concatenate(x) for x in zip(*rows)]


def _hits(table):
    out = set()
    for blob in table["blob"].to_pylist():
        ids, counts, keys = substring._opened(blob, np.uint64)
        out |= set(zip(np.repeat(ids, counts).tolist(), keys.tolist()))
    return out


def _measured(find, table):
    tracemalloc.start()
    try:
        out = find((pa.scalar(3),), table)
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_bucket_takes_few_bytes_an_entry():
    rng, n = np.random.default_rng(5), 1_000_000
    table, (ids, short, anchor) = _bucket(rng, n, (np.uint32, bool))
    out, peak = _measured(substring._probe(4, 16), table)
    _, at, count = np.unique(short, return_inverse=True, return_counts=True)
    hit = (count[at] > 1) & (np.bincount(at, anchor) > 0)[at]
    assert _hits(out) == set(zip(ids[hit].tolist(), (short[hit].astype(np.uint64) | np.uint64(3 << 32)).tolist()))
    assert peak < 36 * n

    table, (ids, k1, k2) = _bucket(rng, n, (np.uint64, np.uint32))
    k1 //= 16  # many windows in several documents
    k2[:] = k1 % 7
    blobs, cuts = [], np.linspace(0, n, 41).astype(int)
    for a, b in zip(cuts, cuts[1:]):
        blobs.append(substring._packed(ids[a:b], k1[a:b], k2[a:b]))
    out, peak = _measured(substring._smallest(4, 16), pa.table([table["bucket"], pa.array(blobs, pa.binary())], schema=substring._SENT))
    _, at = np.unique(k1, return_inverse=True)
    least = np.full(at.max() + 1, ids.max())
    np.minimum.at(least, at, ids)
    later = ids > least[at]
    assert _hits(out) == set(zip(ids[later].tolist(), k1[later].tolist()))
    assert peak < 60 * n
