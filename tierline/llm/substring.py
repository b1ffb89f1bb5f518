"""Exact repeats across documents by fixed-block anchors.

Any window of `window` words holds a whole aligned block of (window + 1) // 2 words of the document it is copied from.
Those non-overlapping blocks are the anchors; every rolling block of every document probes them. Only places that
hit take part in the second step, which extends each hit to the windows around it, compares these by 96 bits of
hashes and so grows runs of windows to maximal repeats.

Hashes travel packed: a slice of documents sends each hash once, for its smallest document, whatever the number of
documents that share it, to one of many buckets. So a passage that a third of all documents share costs one entry a
slice. What a slice can settle among its own documents it settles itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import column_bytes, settled, slices, space_flags, splitmix, window_hashes, word_bounds, word_hashes

_SPACE = space_flags()
_SENT = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])
_LANE = pa.schema([("lane", pa.int64()), ("blob", pa.binary())])
_FOUND = pa.schema([("doc", pa.int64()), ("blob", pa.binary())])
#: Entries of a bucket: what one task holds at a time.
_BUCKET_ENTRIES = 6_000_000
#: Pieces of a bucket of windows, which are sorted one by one.
_PIECES = 8


class _Slice:
    """Documents of a batch in the order of their ids, as one array of word hashes."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)  # NULLs would make them floats
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        self.data, starts = column_bytes(batch.column("text").take(pa.array(self.order)))
        self.begin, self.end = word_bounds(self.data, _SPACE)
        self.first = np.searchsorted(self.begin, starts)
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(ids)), self.n_words)
        self.words = word_hashes(self.data, self.begin, self.end)

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of `size` words that lie in one document, and their hashes."""
        words = self.words if not seed else word_hashes(self.data, self.begin, self.end, seed)
        hashes = window_hashes(words, size)
        inside = np.flatnonzero(self.doc[: len(hashes)] == self.doc[size - 1 :]) if len(hashes) else np.empty(0, np.int64)
        return inside, hashes[inside]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _by_doc(ids: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The values of each id as bytes; ids in runs."""
    at = [*_runs(ids), len(ids)] if len(ids) else []
    for a, b in zip(at, at[1:]):
        yield int(ids[a]), np.ascontiguousarray(values[a:b]).tobytes()


def _packed(ids: np.ndarray, *parts: np.ndarray) -> bytes:
    """Sender ids, which come in runs, and further columns, as bytes."""
    at = _runs(ids)
    head = np.array([len(ids), len(at)], np.int64)
    counts = np.diff(np.append(at, len(ids))).astype(np.uint32)
    return b"".join(np.ascontiguousarray(x).tobytes() for x in (head, ids[at], counts, *parts))


def _opened(blob: bytes | pa.Buffer, *kinds: type) -> list[np.ndarray]:
    """Sender ids, how many entries each has, and the further columns, without a copy where these are whole bytes."""
    n, n_ids = np.frombuffer(blob, np.int64, 2)
    at = 16
    out = [np.frombuffer(blob, np.int64, n_ids, at)]
    at += 8 * n_ids
    out.append(np.frombuffer(blob, np.uint32, n_ids, at))
    at += 4 * n_ids
    for kind in kinds:
        if kind is bool:
            size = (n + 7) // 8
            out.append(np.unpackbits(np.frombuffer(blob, np.uint8, size, at))[:n].astype(bool))
        else:
            size = n * np.dtype(kind).itemsize
            out.append(np.frombuffer(blob, kind, n, at))
        at += size
    return out


def _gather(table: pa.Table, *kinds: type) -> list[np.ndarray]:
    """The entries of all blobs: ids of the senders, each entry's sender by its place there, and the further columns.

    Arrays of the final size are filled blob by blob, as a second copy of a bucket would be as large as the bucket.
    """
    blobs = [x.as_buffer() for x in table["blob"]]
    sizes = np.array([np.frombuffer(x, np.int64, 2) for x in blobs]).reshape(-1, 2).sum(0)
    senders, place = np.empty(sizes[1], np.int64), np.empty(sizes[0], np.uint32)
    columns = [np.empty(sizes[0], kind) for kind in kinds]
    a = k = 0
    for blob in blobs:
        ids, counts, *parts = _opened(blob, *kinds)
        b = a + len(parts[0])
        senders[k : k + len(ids)] = ids
        place[a:b] = np.repeat(np.arange(k, k + len(ids), dtype=np.uint32), counts)
        for column, part in zip(columns, parts):
            column[a:b] = part
        a, k = b, k + len(ids)
    return [senders, place, *columns]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _by_lane(ids: np.ndarray, keys: np.ndarray, lanes: int) -> Iterator[tuple[int, bytes]]:
    """Hits packed by the lane of their documents, a hash, as ids may have a pattern."""
    lane = (splitmix(ids) % np.uint64(lanes)).astype(np.int32)
    order = np.lexsort((ids, lane))
    lane, ids, keys = lane[order], ids[order], keys[order]
    at = [*_runs(lane), len(lane)] if len(lane) else []
    for a, b in zip(at, at[1:]):
        yield int(lane[a]), _packed(ids[a:b], keys[a:b])


def _gathered(key: tuple, table: pa.Table) -> pa.Table:
    """The hits of a lane, one row a document."""
    senders, place, keys = _gather(table, np.uint64)
    ids = senders[place]
    order = np.argsort(ids, kind="stable")
    return pa.Table.from_batches([_table(list(_by_doc(ids[order], keys[order])), _FOUND)])


def _anchors(block: int, bits: int, lanes: int) -> Callable:
    """Sends each rolling block of a slice once; documents that share a block inside the slice are hits at once."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            part = _Slice(batch)
            at, h = part.windows(block)
            if not len(at):
                continue
            doc = part.doc[at]
            anchor = (at - part.first[doc]) % block == 0
            key = h >> np.uint64(32 - bits)
            order = np.argsort(key, kind="stable")
            key, doc, anchor = key[order], doc[order], anchor[order]
            run = _runs(key)
            last = np.append(run[1:], len(key)) - 1
            anchored = np.logical_or.reduceat(anchor, run)
            shared = np.repeat(doc[run] != doc[last], last - run + 1)
            rows = []
            for lane, blob in _by_lane(part.ids[doc[shared]], key[shared], lanes):
                rows.append(((1 << bits) + lane, blob))
            key, sender = key[run], doc[run]
            bucket = (key >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((sender, bucket))
            bucket, key, sender, anchored = bucket[order], key[order].astype(np.uint32), part.ids[sender[order]], anchored[order]
            at = [*_runs(bucket), len(bucket)]
            for a, b in zip(at, at[1:]):
                rows.append((int(bucket[a]), _packed(sender[a:b], key[a:b], np.packbits(anchored[a:b]))))
            yield _table(rows, _SENT)

    return send


def _probe(bits: int, lanes: int) -> Callable:
    """In a bucket: hashes that several slices sent, one of them with an anchor, are hits of all their senders."""

    def find(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= 1 << bits:
            return pa.table([pa.array(np.full(len(table), bucket - (1 << bits))), table["blob"]], schema=_LANE)
        # One number an entry, sorted in place: the hash, whether it is an anchor, and the sender.
        senders, place, short, anchor = _gather(table, np.uint32, bool)
        entry = short.astype(np.uint64)
        entry <<= np.uint64(32)
        entry |= place
        np.bitwise_or(entry, np.uint64(1 << 31), out=entry, where=anchor)
        del place, short, anchor
        entry.sort()
        # Most hashes stand alone and need no more room.
        same = np.zeros(len(entry) + 1, bool)
        same[1:-1] = entry.view(np.uint32)[3::2] == entry.view(np.uint32)[1:-1:2]
        entry = entry[same[1:] | same[:-1]]
        short = entry >> np.uint64(32)
        run = _runs(short)
        size = np.diff(np.append(run, len(short)))
        anchored = (entry[run + size - 1] >> np.uint64(31)) & np.uint64(1) > 0  # a run's anchors come last
        hit = np.repeat(anchored, size)
        ids, short = senders[entry[hit] & np.uint64((1 << 31) - 1)], short[hit] | np.uint64(bucket << 32)
        return pa.Table.from_batches([_table(list(_by_lane(ids, short, lanes)), _LANE)])

    return find


def _extended(block: int, window: int, bits: int, bits2: int, lanes: int) -> Callable:
    """Sends the windows around the hits of each document, once a slice; what repeats inside the slice is settled."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            part = _Slice(batch)
            at, h = part.windows(block)
            key = h >> np.uint64(32 - bits)
            hit = np.zeros(len(part.words) + 1, np.int64)
            bounds = np.searchsorted(part.doc[at], np.arange(len(part.ids) + 1))
            hits = batch.column("hits")
            for d, row in enumerate(part.order):
                a, b = bounds[d], bounds[d + 1]
                known = np.frombuffer(hits[int(row)].as_py(), np.uint64)
                hit[at[a:b][np.isin(key[a:b], known)] + 1] = 1
            np.cumsum(hit, out=hit)
            start, k1 = part.windows(window)
            near = hit[np.minimum(start + window - block + 1, len(hit) - 1)] > hit[start]
            start, k1 = start[near], k1[near]
            if not len(start):
                continue
            k2 = part.windows(window, seed=1)[1][near].astype(np.uint32)
            ids = part.ids[part.doc[start]]
            order = np.lexsort((start, k2, k1))
            ids, k1, k2 = ids[order], k1[order], k2[order]
            run = _runs(k1, k2)
            least = np.repeat(ids[run], np.diff(np.append(run, len(k1))))
            rows = []
            later = ids > least
            for lane, blob in _by_lane(ids[later], k1[later], lanes):
                rows.append(((1 << bits2) + lane, blob))
            ids, k1, k2 = ids[run], k1[run], k2[run]
            bucket = (k1 >> np.uint64(64 - bits2)).astype(np.int64) if bits2 else np.zeros(len(k1), np.int64)
            order = np.lexsort((ids, bucket))
            ids, k1, k2, bucket = ids[order], k1[order], k2[order], bucket[order]
            at = [*_runs(bucket), len(bucket)]
            for a, b in zip(at, at[1:]):
                rows.append((int(bucket[a]), _packed(ids[a:b], k1[a:b], k2[a:b])))
            yield _table(rows, _SENT)

    return send


def _smallest(bits2: int, lanes: int) -> Callable:
    """In a bucket: every sender of a window that a smaller document sent too has a repeat."""

    def find(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= 1 << bits2:
            return pa.table([pa.array(np.full(len(table), bucket - (1 << bits2))), table["blob"]], schema=_LANE)
        senders, place, k1, k2 = _gather(table, np.uint64, np.uint32)
        piece = k1.view(np.uint8)[::8] % _PIECES  # windows of equal hashes share a piece; one is sorted at a time
        found = []
        for i in range(_PIECES):
            own = np.flatnonzero(piece == i)
            ids, x, y = senders[place[own]], k1[own], k2[own]
            order = np.lexsort((ids, y, x))
            ids, x, y = ids[order], x[order], y[order]
            run = _runs(x, y)
            later = ids > np.repeat(ids[run], np.diff(np.append(run, len(x))))
            found.append((ids[later], x[later]))
        del senders, place, k1, k2
        ids, keys = (np.concatenate(x) for x in zip(*found))
        return pa.Table.from_batches([_table(list(_by_lane(ids, keys, lanes)), _LANE)])

    return find


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept string"


def _cut(window: int, with_text: bool) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            part = _Slice(batch)
            start, k1 = part.windows(window)
            bounds = np.searchsorted(part.doc[start], np.arange(len(part.ids) + 1))
            found = batch.column("found")
            empty = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            rows = []
            raw = part.data.tobytes()
            for d, row in enumerate(part.order):
                first, n = int(part.first[d]), int(part.n_words[d])
                blobs = found[int(row)].as_py()
                gone = np.zeros(n + 1, np.int32)
                if blobs and not empty[row]:
                    a, b = bounds[d], bounds[d + 1]
                    hits = start[a:b][np.isin(k1[a:b], np.frombuffer(blobs, np.uint64))] - first
                    np.add.at(gone, hits, 1)
                    np.add.at(gone, hits + window, -1)
                lost = np.cumsum(gone)[:n] > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], lost, [0]))))
                words = raw[part.begin[first] : part.end[first + n - 1]].split() if n else []
                kept = b" ".join(w for w, x in zip(words, lost) if not x) if len(edge) else b" ".join(words)
                rows.append(
                    (
                        None if empty[row] else int(part.ids[d]),
                        n,
                        int(lost.sum()),
                        hashlib.sha256(kept).hexdigest(),
                        [{"start": int(x), "end": int(y)} for x, y in zip(edge[0::2], edge[1::2])],
                        kept.decode() if with_text else None,
                    )
                )
            yield _table(rows, _ARROW_RESULT)

    return cut


_ARROW_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("kept", pa.string()),
    ]
)


def _bits(entries: int) -> int:
    """So many bits of a hash name its bucket that a bucket gets _BUCKET_ENTRIES at most, on average."""
    return min(28, max(1, int(entries // _BUCKET_ENTRIES).bit_length()))


def repeats(docs: DataFrame, window: int = 13, with_text: bool = True) -> DataFrame:
    """For each row: words, removed words, their spans, the kept words and their SHA-256.

    A word goes if it lies in a window of `window` words that also starts in a document with a smaller doc_id. Spans
    are the maximal runs of such words. NULL text is an empty text; a row without doc_id is neither cut nor a
    reference; rows of the same doc_id don't cut each other. Other columns are not read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    block = (window + 1) // 2
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = base.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = _bits(chars // 6)
    lanes = 1 << bits

    def exchanged(sent: DataFrame, find: Callable, name: str) -> DataFrame:
        lane = sent.groupBy("bucket").applyInArrow(find, "lane long, blob binary")
        found = settled(lane.groupBy("lane").applyInArrow(_gathered, "doc long, blob binary"))
        return found.select(F.col("doc").alias("doc_id"), F.col("blob").alias(name))

    sent = named.mapInArrow(_anchors(block, bits, lanes), "bucket long, blob binary")
    joined = named.join(exchanged(sent, _probe(bits, lanes), "hits"), "doc_id")
    sent = joined.mapInArrow(_extended(block, window, bits, bits, lanes), "bucket long, blob binary")
    found = exchanged(sent, _smallest(bits, lanes), "found")
    return base.join(found, "doc_id", "left").mapInArrow(_cut(window, with_text), _RESULT)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """`repeats` over all documents, windows of 13 words, without the kept text itself."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return repeats(docs, 13, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
