"""Exact token counts. Huge texts are encoded in overlapping chunks and spliced where both chunks agree for sure."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import settled, slices, text_of

#: Characters of a chunk, and of what two neighbours share at first; by how much both grow where that fails.
CHUNK, OVERLAP, WIDER = 32_768, 1_024, 4
#: Distinct pieces of text whose counts a worker remembers.
_REMEMBERED = 400_000
#: Signs before which a piece ends if a letter from A to Z stands there.
_SIGNS = b".,;:!?"
_IS_SIGN, _IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
_IS_SIGN[list(_SIGNS)] = True
_IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: White space in the sense of any of the tokenizers, with signs that some of them take for it; and where a text is cut.
_WHITE = re.compile("[\\s\u180e\u200b\ufeff]")
_CUT = re.compile(_WHITE.pattern + "|[A-Za-z][.,;:!?]")


def cuts_at_blanks(model: dict) -> bool:
    """Whether a vocabulary file (as JSON) begins a new piece at each blank and line end between two other characters.

    So it is with the byte-level pre-tokenizer that puts no blank in front, after no normalizer, where no added token
    holds a place where `piece_starts` cuts, or swallows white space.
    """
    before = model.get("pre_tokenizer") or {}
    added = model.get("added_tokens") or []
    return (
        before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and not model.get("normalizer")
        and not any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") or _CUT.search(x["content"]) for x in added)
    )


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Where a new piece certainly begins in UTF-8 bytes, unordered: at a blank or line end between two characters that
    are not white space, behind such a line end, and at a sign behind a letter."""
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    # Besides ASCII, white space is U+0085, U+00A0 and some of the characters that begin with E1, E2 or E3.
    second, third = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    white = (before <= 0x20) | (after <= 0x20) | ((second == 0xC2) & (before >= 0x80)) | (after == 0xC2)
    white |= (before >= 0x80) & (third >= 0xE1) & (third <= 0xE3)
    white |= (after >= 0xE1) & (after <= 0xE3)
    white |= (before == 0xEF) | (after == 0xEF) | ((before == 0xBF) & (third == 0xEF))
    at = at[~white]
    signs = np.flatnonzero(_IS_SIGN[data[1:]] & _IS_LETTER[data[:-1]]) + 1
    return np.concatenate([at, at[data[at] == 0x0A] + 1, signs])


class _Encoder:
    """The library for a vocabulary file, made once a task."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[str, int] = {}
        self.specials = max([0, *(len(x.content) for x in self.library.get_added_tokens_decoder().values())])
        end = self.library.encode("\n", add_special_tokens=False).ids
        self.line_end = end[0] if len(end) == 1 else None
        self.cuts = self.line_end is not None and cuts_at_blanks(json.loads(self.library.to_str()))

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def fresh(self, pieces: list[str]) -> list[int]:
        """Tokens of pieces (see piece_starts): those without further white space in one go, a line end between two."""
        out: list[int] = [0] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p and not _WHITE.search(p, 1) and (p[0] == " " or not _WHITE.match(p))]
        odd = sorted(set(range(len(pieces))) - set(plain))
        for at in range(0, len(plain), 2_048):
            part = plain[at : at + 2_048]
            ids = np.array(self.library.encode("\n".join([pieces[i] for i in part]), add_special_tokens=False).ids)
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
            if len(ends) != len(part):
                odd += part
                continue
            for i, n in zip(part, np.diff(ends, prepend=-1) - 1):
                out[i] = int(n)
        for i, n in zip(odd, self.lengths([pieces[i] for i in odd])):
            out[i] = n
        return out

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text as the library counts them.

        Pieces of a text that certainly begin at a border of pre-tokens are encoded independently of each other by the
        library, so a text is the sum of its pieces, and each distinct piece of the batch is encoded once.
        """
        if not self.cuts:
            return np.array(self.lengths(texts.to_pylist()), np.int64)
        texts = texts.cast(pa.string())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        if texts.buffers()[2] is None or offsets[0] == offsets[-1]:
            return np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets -= offsets[0]
        cut = np.zeros(len(data) + 1, bool)
        cut[piece_starts(data)] = True
        # Texts stand side by side here. A cut that a neighbouring text brings about is a right one for a text's end too.
        cut[offsets] = True
        starts = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.string(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        n = np.array([self.known.get(p, -1) for p in distinct], np.int64)
        new = np.flatnonzero(n < 0)
        if len(new):
            words = [distinct[i] for i in new]
            found = self.fresh(words)
            n[new] = found
            if len(self.known) < _REMEMBERED:
                self.known.update(zip(words, found))
        total = np.concatenate(([0], np.cumsum(n[coded.indices.to_numpy()])))
        return np.diff(total[np.searchsorted(starts, offsets)])

    def borders(self, text: str) -> tuple[list[int], list[int]]:
        """Characters at which a pre-token begins, and how many tokens lie before each; the end of the text is last."""
        e = self.library.encode(text, add_special_tokens=False)
        at, before, last = [], [], object()
        for i, (word, (start, _)) in enumerate(zip(e.word_ids, e.offsets)):
            if word != last:
                at.append(start)
                before.append(i)
                last = word
        return [*at, len(text)], [*before, len(e)]


_DOC = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64())]
_PIECE = [*_DOC, ("size", pa.int64()), ("start", pa.int64()), ("text", pa.string())]
_BORDER = [*_DOC, ("border", pa.int64()), ("left", pa.bool_()), ("at", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("tail", pa.int64())]


def _ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{name} {names[kind]}" for name, kind in fields)


def _last_start(size: int, chunk: int, overlap: int) -> int:
    """Where the last chunk begins: what it shares with the one before must reach beyond it."""
    return max(size - overlap - 1, 0) // chunk * chunk


def _first(path: str, chunk: int, overlap: int) -> Callable:
    """Counts texts of at most `chunk` characters; cuts the others."""
    fields = [*_PIECE, ("n_tokens", pa.int64())]
    schema = pa.schema(fields)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], schema=schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(path)
        for batch in slices(batches, "text"):
            sizes = pa.compute.utf8_length(batch.column("text"))
            short = pa.compute.less_equal(sizes, chunk)
            few = batch.filter(short)
            if few.num_rows:
                none = lambda t: pa.nulls(few.num_rows, t)
                n = encoder.counts(few.column("text"))
                yield pa.record_batch(
                    [few.column("row"), few.column("doc_id"), few.column("n_bytes"), none(pa.int64()), none(pa.int64()), none(pa.string()), pa.array(n)],
                    schema=schema,
                )
            for r in batch.filter(pa.compute.invert(short)).to_pylist():
                text, size, rows, held = r["text"], len(r["text"]), [], 0
                for start in range(0, _last_start(size, chunk, overlap) + 1, chunk):
                    part = text[start : start + chunk + overlap]
                    rows.append((r["row"], r["doc_id"], r["n_bytes"], size, start, part, None))
                    held += len(part)
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return first


def _borders(path: str, chunk: int, overlap: int) -> Callable:
    """Encodes chunks. Keeps what lies in the parts shared with the neighbours: a row for either border."""
    schema = pa.schema(_BORDER)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(path)
        for batch in slices(batches, "text"):
            rows = []
            for r in batch.to_pylist():
                doc, start, text = (r["row"], r["doc_id"], r["n_bytes"]), r["start"], r["text"]
                at, n = encoder.borders(text)
                # Next to a cut, a border may be false: a special string or a run may go on beyond it.
                begin = [(start + x, y) for x, y in zip(at, n) if encoder.specials < x <= overlap]
                end = [(start + x, y) for x, y in zip(at, n) if len(text) - overlap <= x < len(text) - encoder.specials]
                k, last = start // chunk, start == _last_start(r["size"], chunk, overlap)
                if start:
                    rows.append((*doc, k - 1, False, [x for x, _ in begin], [y for _, y in begin], n[-1] if last else 0))
                if not last:
                    rows.append((*doc, k, True, [x for x, _ in end], [y for _, y in end], 0))
                elif not start:
                    rows.append((*doc, -1, True, [], [], n[-1]))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * len(schema), schema)], schema=schema)

    return encode


def _spliced(agreeing: int) -> Callable:
    """What a border adds to its document: the tokens before a proven place by the chunk that ends there, without those
    that the next chunk has before that place; and all tokens of the last chunk. NULL where no place is proven."""
    schema = pa.schema([*_DOC, ("n_tokens", pa.int64())])

    def proven(a: dict, b: dict) -> int | None:
        one, two = dict(zip(a["at"], a["n"])), dict(zip(b["at"], b["n"]))
        met = sorted(one.keys() & two.keys())
        # From the first common border on, both scans run alike; the next ones prove it, tokens and all.
        for p, *more in zip(met, *(met[k:] for k in range(1, agreeing))):
            if (
                all(one[q] - one[p] == two[q] - two[p] for q in more)
                and sorted(x for x in one if p <= x <= more[-1]) == sorted(x for x in two if p <= x <= more[-1])
            ):
                return one[p] - two[p] + b["tail"]
        return None

    def splice(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: not r["left"])
        n = proven(*rows) if len(rows) == 2 else rows[0]["tail"]
        return pa.table([pa.array([v], t) for v, (_, t) in zip([*(rows[0][x] for x, _ in _DOC), n], [*_DOC, ("", pa.int64())])], schema=schema)

    return splice


def _joined(chunk: int, overlap: int) -> Callable:
    """One wider chunk from the narrower ones that begin in it or in what it shares with the next."""
    schema = pa.schema([*_PIECE])

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        begin, text = rows[0]["start"], ""
        for r in rows:
            text = text[: r["start"] - begin] + r["text"]
        r = rows[0]
        values = (r["row"], r["doc_id"], r["n_bytes"], r["size"], begin, text[: chunk + overlap])
        return pa.table([pa.array([v], t) for v, (_, t) in zip(values, _PIECE)], schema=schema)

    return join


def widened(pieces: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The same texts cut into chunks of `chunk` characters, a multiple of what they were cut into; no text is read again."""
    last = F.expr(f"greatest(size - {overlap} - 1, 0) div {chunk}")
    own = F.expr(f"start div {chunk}")
    shared = F.when((own > 0) & (F.col("start") - own * chunk < overlap), F.array(own - 1, own)).otherwise(F.array(own))
    each = pieces.withColumn("wide", F.explode(F.filter(shared, lambda k: k <= last)))
    return each.groupBy("row", "wide").applyInArrow(_dropping(_joined(chunk, overlap), "wide"), _ddl(_PIECE))


def _dropping(f: Callable, column: str) -> Callable:
    return lambda table: f(table.drop_columns([column]))


def counted(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """For each row of `docs`: doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens).

    `path` names a vocabulary file of the tokenizers library. Texts of more than `chunk` characters are cut into chunks
    which share `overlap` characters with the next and are encoded in tasks of their own. Two neighbours are spliced at
    a border of pre-tokens on which both agree, as they do on the three that follow. Texts in which some neighbours do
    not agree are cut anew from their chunks, four times as wide with four times the overlap, at last whole. One pass
    reads the documents. NULL text is empty and has no tokens; a row without doc_id is counted too; rows that repeat a
    doc_id are counted one by one. An empty table gives an empty result.
    """
    text = text_of()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    # Written at once, so that a row keeps its number.
    begun = settled(rows.mapInArrow(_first(path, chunk, overlap), _ddl([*_PIECE, ("n_tokens", pa.int64())])))
    result = begun.where("start IS NULL").select("doc_id", "n_bytes", "n_tokens")
    pieces = begun.where("start IS NOT NULL").drop("n_tokens")
    while not pieces.isEmpty():
        borders = pieces.mapInArrow(_borders(path, chunk, overlap), _ddl(_BORDER))
        spliced = borders.groupBy("row", "border").applyInArrow(_spliced(4), _ddl([*_DOC, ("n_tokens", pa.int64())]))
        sums = settled(spliced.groupBy("row", "doc_id", "n_bytes").agg(F.sum("n_tokens").alias("n_tokens"), F.every(F.col("n_tokens").isNotNull()).alias("proven")))
        result = result.unionByName(sums.where("proven").select("doc_id", "n_bytes", "n_tokens"))
        failed = sums.where("NOT proven").select("row")
        chunk, overlap = WIDER * chunk, WIDER * overlap
        pieces = settled(widened(pieces.join(failed, "row", "left_semi"), chunk, overlap)) if not failed.isEmpty() else failed
    return result.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """`counted` over all documents by byte_bpe_50k.json."""
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return counted(docs, public_tokenizers.path("byte_bpe_50k.json"))
