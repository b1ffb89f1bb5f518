"""Latent semantic search for benchmark items in documents, checked by longest common subsequences and answers.

Passages are windows of words, weighed by TF-IDF over hashed columns. A randomised SVD over the items and all passages of
all documents gives the latent directions, far fewer than there are items or passages. Passages and items are projected on
these and compared there, in one scan. What comes near is checked word by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import column_bytes, slices, space_flags, splitmix, word_bounds, word_hashes

#: Words of a passage and from one to the next; words up to which an item is searched for as a whole.
PASSAGE, STRIDE, WHOLE = 48, 24, 64
#: Hashed columns (as bits), latent dimensions, and how many columns the basis has besides those of the items: the most
#: frequent ones.
COLUMN_BITS, RANK, OTHER_COLUMNS = 18, 128, 8_192
#: Rows of the sketch that all passages are added up in: at most, and cells beyond which it has fewer, though twice the rank.
SKETCH_ROWS, SKETCH_CELLS = 1_024, 1 << 24
#: Parts of items that one scan of the documents looks for.
PARTS_A_SCAN = 32_768
#: Latent cosine of a candidate, and the share of an item that a candidate contains there; shares of an item's words that
#: count as a leak, by themselves and with the answer.
LEAST, CONTAINED, ALONE, WITH_ANSWER = 0.5, 0.5, 0.75, 0.55
#: Weight of a word that all documents have. Latent directions mix columns, so no item may weigh next to nothing.
LEAST_WEIGHT = 1.0
#: Words at the end of an item that count as its answer.
ANSWER = 5

_CLEAN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_SPACE = space_flags(b" ")
_SEGMENTS = 64


class _Words:
    """The words of a batch of texts: hashes, columns, and where each text begins. A-Z count as a-z."""

    def __init__(self, texts: pa.Array) -> None:
        data, starts = column_bytes(texts)
        data = np.frombuffer(data.tobytes().translate(_CLEAN), np.uint8)
        begin, end = word_bounds(data, _SPACE)
        self.first = np.searchsorted(begin, starts)
        self.hash = word_hashes(data, begin, end)
        self.column = (self.hash >> np.uint64(64 - COLUMN_BITS)).astype(np.int32)

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word and end word of every passage; the last one of a text may be shorter."""
        n = np.diff(self.first)
        many = np.where(n > 0, np.maximum(1, -(-(n - STRIDE) // STRIDE)), 0)
        doc = np.repeat(np.arange(len(n)), many)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        begin = self.first[doc] + k * STRIDE
        return doc, begin, np.minimum(begin + PASSAGE, self.first[doc + 1])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log((1 + documents) / (1 + documents with a word of the column)) by column, over all documents; 1 at least."""

    columns, size = 1 << COLUMN_BITS, (1 << COLUMN_BITS) // _SEGMENTS + 1  # the place after the columns counts documents

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * _SEGMENTS, np.int32)
        for batch in slices(batches, "text"):
            words = _Words(batch.column("text"))
            doc = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(words.first))
            pairs = np.sort((doc << COLUMN_BITS) | words.column)
            new = np.ones(len(pairs), bool)
            new[1:] = pairs[1:] != pairs[:-1]
            total[:columns] += np.bincount(pairs[new] & (columns - 1), minlength=columns).astype(np.int32)
            total[columns] += batch.num_rows
        some = np.flatnonzero(total).astype(np.int32)
        for i in np.unique(some // size):
            own = some[some // size == i]
            blob = np.concatenate([own - i * size, total[own]]).astype(np.int32).tobytes()
            yield pa.record_batch([pa.array([i], pa.int64()), pa.array([blob], pa.binary())], names=["segment", "blob"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for blob in table["blob"].to_pylist():
            at, n = np.frombuffer(blob, np.int32).reshape(2, -1)
            total[at] += n
        return pa.table({"segment": table["segment"][:1], "blob": pa.array([total.tobytes()], pa.binary())})

    parts = docs.select("text").mapInArrow(count, "segment long, blob binary").groupBy("segment")
    total = np.zeros((_SEGMENTS, size))
    for segment, blob in parts.applyInArrow(add, "segment long, blob binary").collect():  # a number a column
        total[segment] = np.frombuffer(blob)
    total = total.ravel()
    return np.maximum(np.log((1 + total[columns]) / (1 + total[:columns])), LEAST_WEIGHT).astype(np.float32)


class Parts:
    """A block of items cut into parts of WHOLE words at most, as word hashes."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        item_of, words_of, last = [], [], []
        words = _Words(pa.array([t for _, t in items], pa.string()))
        for k, (item, _) in enumerate(items):
            own = words.hash[words.first[k] : words.first[k + 1]]
            cuts = [0] if len(own) <= WHOLE else [*range(0, len(own) - PASSAGE // 2, PASSAGE)]
            for a, b in zip(cuts, [*cuts[1:], len(own)]):
                if b > a:
                    item_of.append(item)
                    words_of.append(own[a:b])
                    last.append(b == len(own))
        self._set(item_of, words_of, last)

    def _set(self, item: list[int], words: list[np.ndarray], last: list[bool]) -> None:
        self.item, self.words, self.last = item, words, last
        self.columns = [(w >> np.uint64(64 - COLUMN_BITS)).astype(np.int64) for w in self.words]
        self.vocabulary = np.unique(np.concatenate(self.columns)) if self.columns else np.empty(0, np.int64)

    def cut(self, most: int) -> list[Parts]:
        """The same parts in turn, `most` at a time."""
        out = []
        for a in range(0, len(self.words), most):
            piece = Parts([])
            piece._set(self.item[a : a + most], self.words[a : a + most], self.last[a : a + most])
            out.append(piece)
        return out


def blocks(items: Iterator[tuple[int, str]], most: int = PARTS_A_SCAN) -> Iterator[list[Parts]]:
    """The items in turn, in blocks of `most` parts at most.

    An item of more parts has a block of several Parts, which are searched for together, as its best part counts.
    """
    held, n = [], 0
    for item in items:
        own = len(Parts([item]).words)
        if held and n + own > most:
            yield Parts(held).cut(most)
            held, n = [], 0
        if own:
            held.append(item)
            n += own
    if held:
        yield Parts(held).cut(most)


class Basis:
    """Latent directions: `place` is a column's row of `directions`, or -1. Items and passages are sums of their words'
    rows, weighed by idf; `queries` are the items' projections of unit length, `size` their lengths before."""

    def __init__(self, idf: np.ndarray, parts: Parts, columns: np.ndarray, directions: np.ndarray) -> None:
        self.idf, self.parts, self.directions = idf, parts, directions
        self.place = np.full(1 << COLUMN_BITS, -1, np.int32)
        self.place[columns] = np.arange(len(columns))
        weighed = directions * idf[columns][:, None]
        self.table = np.vstack([weighed, np.zeros((1, directions.shape[1]))]).astype(np.float32)  # the last row: no column
        rows = np.array([self.table[self.place[c]].sum(0) for c in parts.columns], np.float32).reshape(len(parts.columns), -1)
        self.size = np.linalg.norm(rows, axis=1)
        self.queries = rows / np.maximum(self.size, 1e-6)[:, None]

    def __getstate__(self) -> dict:
        kept = {k: v for k, v in self.__dict__.items() if k not in ("directions", "idf")}
        return kept | {"table": self.table.astype(np.float16)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state | {"table": state["table"].astype(np.float32)})

    def near(self, words: _Words, least: float, contained: float = CONTAINED) -> Iterator[tuple[int, int, int, int, float]]:
        """(document, first word, end word, part, cosine) of the passages that come near an item in the latent space.

        That is a cosine of `least` or more, or a product of `contained` times the item's own squared length, which
        neither the words around an item nor the number of documents that hold it make smaller. Words are summed up
        by STRIDE, as neighbouring passages share these halves.
        """
        doc, begin, end = words.passages()
        rows = np.append(self.place[words.column], -1)
        steps = np.arange(STRIDE)
        for at in range(0, len(doc), 1_024):
            b, e = begin[at : at + 1_024], end[at : at + 1_024]
            # A passage is the half that it begins with and the next one, which is the first half of the next passage, if
            # that is of the same document; the words of halves stand side by side, -1 (a row of zeros) beyond the end.
            last = np.append(b[1:] != b[:-1] + STRIDE, True)
            first, stop = np.concatenate([b, b[last] + STRIDE]), np.concatenate([np.minimum(b + STRIDE, e), e[last]])
            token = first[:, None] + steps
            token = np.where(token < stop[:, None], token, len(rows) - 1)
            halves = self.table[rows[token[:, 0]]]
            for k in range(1, STRIDE):
                halves += self.table[rows[token[:, k]]]
            passages = halves[: len(b)].copy()
            passages[:-1][~last[:-1]] += halves[1 : len(b)][~last[:-1]]
            passages[last] += halves[len(b) :]
            length = np.maximum(np.linalg.norm(passages, axis=1), 1e-6)
            product = passages @ self.queries.T
            enough = np.minimum((least * length)[:, None], np.maximum(contained * self.size, 1e-6)[None, :])
            for p, q in zip(*np.nonzero(product >= enough)):
                yield int(doc[at + p]), int(b[p]), int(e[p]), int(q), float(product[p, q] / length[p])


def _sketch(docs: DataFrame, idf: np.ndarray, place: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """S A for the passages A of all documents and a random S of one sign a passage, in one of `rows` rows; A'S'SA is A'A on
    average. Row and sign are hashes of the document's id, the place and the words, so copies count each for itself."""
    size = rows * columns // _SEGMENTS + 1

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * _SEGMENTS, np.float32)
        for batch in slices(batches, "text"):
            words = _Words(batch.column("text"))
            ids = splitmix(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            doc, begin, end = words.passages()
            for at in range(0, len(doc), 4_096):
                d, b, e = doc[at : at + 4_096], begin[at : at + 4_096], end[at : at + 4_096]
                first = np.cumsum(e - b) - (e - b)
                token = np.arange((e - b).sum()) - np.repeat(first - b, e - b)
                row = np.repeat(np.arange(len(b)), e - b)
                column, weight = place[words.column[token]], idf[words.column[token]]
                norm = np.sqrt(np.maximum(np.bincount(row, weight.astype(np.float64) ** 2, len(b)), 1e-9))
                with np.errstate(over="ignore"):
                    own = splitmix(np.add.reduceat(words.hash[token], first) + ids[d] + (b - words.first[d]).astype(np.uint64))
                target = (own % np.uint64(rows)).astype(np.int64) * columns
                sign = np.where(own >> np.uint64(63), -1.0, 1.0) / norm
                keep = column >= 0
                np.add.at(total, (target[row] + column)[keep], (sign[row] * weight)[keep].astype(np.float32))
        some = np.flatnonzero(total)
        cuts = np.searchsorted(some, np.arange(_SEGMENTS + 1) * size)
        for i in np.flatnonzero(np.diff(cuts)):
            own = some[cuts[i] : cuts[i + 1]]
            blob = (own - i * size).astype(np.int32).tobytes() + total[own].tobytes()
            yield pa.record_batch([pa.array([i], pa.int64()), pa.array([blob], pa.binary())], names=["segment", "blob"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for blob in table["blob"].to_pylist():
            at, x = np.frombuffer(blob, np.int32).reshape(2, -1)
            total[at] += x.view(np.float32)
        return pa.table({"segment": table["segment"][:1], "blob": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    # A row without an id is one of its own. Each task sends sums of the sketch's size, so there is one task a core.
    some = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.monotonically_increasing_id()).alias("doc_id"), "text")
    some = some.coalesce(docs.sparkSession.sparkContext.defaultParallelism)
    parts = some.mapInArrow(add_up, "segment long, blob binary").groupBy("segment")
    total = np.zeros((_SEGMENTS, size), np.float32)
    for segment, blob in parts.applyInArrow(add, "segment long, blob binary").toLocalIterator():  # the sketch, of a fixed size
        total[segment] = np.frombuffer(blob, np.float32)
    return total.ravel()[: rows * columns].reshape(rows, columns)


def fitted(docs: DataFrame, idf: np.ndarray, parts: Parts, rank: int = RANK, seed: int = 17) -> Basis:
    """The basis by a randomised SVD of the items and all passages of the documents.

    Its columns are those of the items and the OTHER_COLUMNS most frequent others, so that words which stand where an
    item's words stand share its directions. One scan adds up the passages A in a sketch of SKETCH_ROWS rows, S A, whatever
    their number. The driver multiplies it and the items by a random matrix and back in four rounds, orthogonalises, and
    turns the result to the singular directions by the small Gram matrix. Items weigh as much as all passages.
    """
    others = np.setdiff1d(np.argsort(idf, kind="stable")[: OTHER_COLUMNS + len(parts.vocabulary)], parts.vocabulary, True)[:OTHER_COLUMNS]
    columns = np.sort(np.concatenate([parts.vocabulary, others]))
    m, k = len(columns), min(rank + 16, len(columns))
    place = np.full(1 << COLUMN_BITS, -1, np.int32)
    place[columns] = np.arange(m)
    sketch = _sketch(docs, idf, place, max(min(SKETCH_ROWS, SKETCH_CELLS // m), 2 * k), m)

    def product(column: np.ndarray, weight: np.ndarray, row: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        return np.add.reduceat(by[column] * weight[:, None], starts, axis=0), np.cumsum(np.diff(row, prepend=-1) > 0) - 1

    def back(out: np.ndarray, column: np.ndarray, weight: np.ndarray, row: np.ndarray, by: np.ndarray) -> None:
        if len(row):
            y, at = product(column, weight, row, by)
            order = np.argsort(column, kind="stable")
            c = column[order]
            starts = np.flatnonzero(np.diff(c, prepend=-1))
            out[c[starts]] += np.add.reduceat(y[at[order]] * weight[order][:, None], starts, axis=0)

    def gram(out: np.ndarray, column: np.ndarray, weight: np.ndarray, row: np.ndarray, by: np.ndarray) -> None:
        if len(row):
            y, _ = product(column, weight, row, by)
            out += y.T @ y

    items = []
    for c in parts.columns:
        w = idf[c]
        items.append((place[c], (w / max(np.sqrt((w**2).sum()), 1e-9)).astype(np.float32)))
    own = (
        np.concatenate([c for c, _ in items]),
        np.concatenate([w for _, w in items]),
        np.repeat(np.arange(len(items)), [len(c) for c, _ in items]),
    )

    # The items weigh as much as all passages, so that neither takes all directions: by the Frobenius norms of both products
    # with themselves. Passages of one row of the sketch are not compared there, but their own squares are its trace.
    q = np.random.default_rng(seed).standard_normal((m, k)).astype(np.float32)
    mine = np.zeros((m, k), np.float32)
    back(mine, *own, q)
    between = (sketch @ sketch.T).astype(np.float64)
    trace = np.trace(between)
    np.fill_diagonal(between, 0)
    norm = np.sqrt((between**2).sum() * len(sketch) / (len(sketch) - 1) + trace)
    scale = max(1.0, float(norm) / max(float(np.linalg.norm(mine)) / np.sqrt(k), 1e-9))

    for _ in range(4):
        mine = np.zeros((m, k), np.float32)
        back(mine, *own, q)
        # Added up in place, and let go of before numpy makes the copies that it factors.
        mine = scale * mine
        mine += sketch.T @ (sketch @ q)
        del q
        q = np.linalg.qr(mine)[0].astype(np.float32)
    y, mine = sketch @ q, np.zeros((k, k), np.float32)
    gram(mine, *own, q)
    _, turn = np.linalg.eigh(y.T @ y + scale * mine)
    turned = q @ turn[:, ::-1]
    del sketch, q
    directions = np.linalg.qr(turned)[0][:, :rank].astype(np.float32)
    del turned
    return Basis(idf, parts, columns, directions)


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit a word of `a`."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for w in b:
        if m := masks.get(w):
            u = s & m
            s = (s + u) | (s - u)
    return len(a) - (s & full).bit_count()


def _found(bases: list[Basis], least: float, alone: float, with_answer: float) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("overlap", pa.float64()), ("answer", pa.bool_())]
        + [("first_word", pa.int64()), ("end_word", pa.int64())]
    )
    known = [[(x := w.tolist(), frozenset(x)) for w in basis.parts.words] for basis in bases]
    fewest = min(alone, with_answer)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = _Words(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            for basis, texts in zip(bases, known):
                parts = basis.parts
                for doc, begin, end, part, cosine in basis.near(words, least):
                    first, last = words.first[doc], words.first[doc + 1]
                    # The passage and as much around it as the part may reach out.
                    a, b = max(first, begin - STRIDE), min(last, end + STRIDE)
                    item, own = texts[part]
                    around = [w for w in words.hash[a:b].tolist() if w in own]
                    if len(around) < fewest * len(item):
                        continue
                    overlap = common(item, around) / len(item)
                    answer = parts.last[part] and common(item[-ANSWER:], around) >= 0.8 * len(item[-ANSWER:])
                    if overlap >= alone or (answer and overlap >= with_answer):
                        row = (overlap, cosine, answer, int(a - first), int(b - first))
                        key = (doc, parts.item[part])
                        best[key] = max(best.get(key, row), row)
            rows = [(ids[d], i, c, o, x, a, b) for (d, i), (o, c, x, a, b) in best.items()]
            columns = list(zip(*rows)) or [[]] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return find


_RESULT = "doc_id long, item_id long, cosine double, overlap double, answer boolean, first_word long, end_word long"


def _fitted_blocks(base: DataFrame, benchmark: DataFrame) -> Iterator[list[Basis]]:
    """The bases of each block of the benchmark; one block is on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    idf = None
    rows = ((r["item_id"], r["text"]) for r in items.orderBy("item_id", "text").toLocalIterator())
    for block in blocks(rows):
        if idf is None:
            idf = inverse_frequencies(base)
        yield [fitted(base, idf, parts) for parts in block]


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, alone: float = ALONE, with_answer: float = WITH_ANSWER) -> DataFrame:
    """Documents that hold benchmark items: doc_id, item_id, cosine, overlap, answer, and the words where to look.

    A passage is a candidate if its cosine with an item in the latent space is `least` or more, or the share of the item
    that it contains there is CONTAINED or more. It counts if the words that it shares with the item in order are `alone` of the item's, or `with_answer` of them and the item's last words
    stand there too. An item of more than 64 words is searched for in parts. NULL and empty texts hold nothing and items
    without a word are not found; items of equal text are each found; a row without doc_id is searched and reported
    with NULL; repeated rows give repeated results. Columns doc_id, text, item_id and text are read. The benchmark comes
    to the driver in blocks of PARTS_A_SCAN parts, each of which takes a scan for its basis and one for the search; documents
    do not.
    """
    out = None
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for bases in _fitted_blocks(base, benchmark):
        found = base.mapInArrow(_found(bases, least, alone, with_answer), _RESULT)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], _RESULT) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id has no leak; columns as in `docs`. Rows without doc_id all stay: see leak_free."""
    bad = leaks(docs, benchmark).select("doc_id").where("doc_id IS NOT NULL").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def _flagging(bases: list[Basis], flag: str) -> Callable:
    """Sets `flag` in the rows that hold an item of the bases; the other columns pass as they are."""
    find = _found(bases, LEAST, ALONE, WITH_ANSWER)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = pa.record_batch([pa.array(range(batch.num_rows), pa.int64()), batch.column("text")], names=["doc_id", "text"])
            hit = np.array(batch.column(flag).to_pylist(), bool)
            for found in find(iter([rows])):
                hit[found.column("doc_id").to_numpy()] = True
            at = batch.schema.get_field_index(flag)
            yield batch.set_column(at, batch.schema.field(at), pa.array(hit))

    return mark


def leak_free(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, each judged by its own text; columns as in `docs`."""
    flag = "leaks"
    while flag in docs.columns:
        flag += "_"
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.withColumn(flag, F.lit(False))
    for bases in _fitted_blocks(base, benchmark):
        out = out.mapInArrow(_flagging(bases, flag), out.schema)
    return out.where(~F.col(flag)).select(*docs.columns)


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """`leaks` of the whole benchmark in all documents."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text"))
