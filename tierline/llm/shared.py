"""Helpers of the operators: tables in the shared folder, words, hashes over Arrow columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words, and the pattern of a word, in Java's and Python's regular expressions.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a session on one machine gets a folder of its own, and one on a cluster is refused.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tierline-llm-")
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Spark's setting by which shuffle files go when the query that wrote them has ended.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again: its lineage ends there and survives lost executors.

    Nothing reads the shuffles behind it once it is written, so they are removed then rather than when the driver's
    next garbage collection finds them. The table itself stays, to be expired with the cluster's other checkpoints.
    """
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/tierline-llm/{uuid.uuid4().hex}"
    before = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.parquet(place)
    finally:
        if before is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(place)


def lanes(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text as an array; none for an empty text."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, each row followed by one space, and the first byte of each row.

    The first-byte array has one entry more than there are rows. NULL counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in rows], out=starts[1:])
    return np.frombuffer(b" ".join([*rows, b""]), np.uint8), starts


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal input, equal output on every machine."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class _Kept(dict):
    """What a process remembers. It does not travel: a copy sent to a worker is empty."""

    def __reduce__(self) -> tuple:
        return _Kept, ()


_KEPT = _Kept()  # powers by base


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling; kept up to two million entries a base."""
    if base in _KEPT and len(_KEPT[base]) >= n:
        return _KEPT[base][:n]
    wanted, n = n, n if n > 2_000_000 else max(n, 1_100_000)
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            step = min(done, n - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
    if n <= 2_000_000:
        _KEPT[base] = out
    return out[:wanted]


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def word_bounds(data: np.ndarray, is_space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; the data end with a space. is_space: 256 flags by byte."""
    space = is_space[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, from running sums over blocks of about `block` bytes."""
    out = np.empty(len(begin), np.uint64)
    base = pow(_BASE, 2 * seed + 1, 1 << 64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(begin):
            last = max(first + 1, int(np.searchsorted(end, begin[first] + block, "right")))
            at, to = begin[first], end[last - 1]
            power, back = _powers(base, to - at + 1), _powers(pow(base, -1, 1 << 64), to - at + 1)
            total = np.zeros(to - at + 1, np.uint64)
            np.cumsum(_BYTES[data[at:to]] * power[:-1], out=total[1:])
            b, e = begin[first:last] - at, end[first:last] - at
            raw = (total[e] - total[b]) * back[b]
            out[first:last] = splitmix(raw ^ splitmix((e - b).astype(np.uint64) + np.uint64(seed)))
            first = last
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` neighbours; the last size - 1 entries run off the end and are left out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out += words[i : i + n] * np.uint64(pow(_BASE, i + 1, 1 << 64))
    return splitmix(out)


def space_flags(spaces: bytes = SPACES) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(spaces)] = True
    return flags


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut between rows so that the texts of a piece take about `most` bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray([0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()])
        first, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += int(n) + 1
        yield batch.slice(first)
