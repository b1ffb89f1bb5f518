"""Whitening of embeddings from an exact scatter: each dimension's bits are sliced into planes over rows, and the
popcounts of planes ANDed with each other, weighted by their places, add up to the cross-products as integers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: An entry c counts as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries beyond this, scaled, have no long of their own.
_LARGEST = 2.0**60
#: Rows whose planes are held at once; a multiple of 64.
_BLOCK = 16_384
#: Sums travel as this many limbs of 40 bits, the last one signed.
_LIMBS = 5


def usable(vector: Column) -> Column:
    """Whether a vector is not NULL, not empty, and all its entries are finite and small enough for a long."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < _LARGEST / SCALE))
    return F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """x for each row and dimension."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values.reshape(-1, d) * SCALE).astype(np.int64) + OFFSET


def planes_of(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in which bit r of plane (dimension, place) is that bit of y[r, dimension]; with each plane's dimension and place."""
    n, d = y.shape
    padded = np.zeros((-n % 64 + n, d), np.int64)
    padded[:n] = y
    words, dims, places = [], [], []
    for i in range(d):
        column = padded[:, i]
        for b in range(int(column.max(initial=0)).bit_length()):
            bits = np.packbits((column >> b & 1).astype(np.uint8), bitorder="little")
            words.append(bits.view("<u8"))
            dims.append(i)
            places.append(b)
    return np.array(words, np.uint64).reshape(len(words), len(padded) // 64), np.array(dims, np.int64), np.array(places, np.int64)


def sliced_products(y: np.ndarray) -> np.ndarray:
    """sum over rows of y[r, i] * y[r, j], exact, as an upper triangle of Python integers or longs; y is not negative."""
    d = y.shape[1]
    words, dims, places = planes_of(y)
    wide = len(y) * int(y.max(initial=0)) ** 2 >= 1 << 62
    out = np.zeros((d, d), object if wide else np.int64)
    begin = np.searchsorted(dims, np.arange(d + 1))
    weight = np.array([1 << int(b) for b in places], out.dtype)
    for p in range(len(words)):
        i = dims[p]
        common = np.bitwise_count(words[begin[i] :] & words[p]).sum(axis=1, dtype=np.int64)
        # Planes of one dimension stand together: their weighted counts are summed dimension by dimension.
        terms = common.astype(out.dtype) * weight[begin[i] :]
        used = np.unique(dims[begin[i] :])
        out[i, used] += np.add.reduceat(terms, begin[used] - begin[i]) * weight[p]
    return out


def _limbs(value: int) -> list[int]:
    return [value >> 40 * k & (1 << 40) - 1 for k in range(_LIMBS - 1)] + [value >> 40 * (_LIMBS - 1)]


_PARTIAL = "i int, j int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))


def _scatter(d: int) -> Callable:
    """What a task adds: sums of x_i * x_j (i <= j), of x_j (i = -1), and the number of rows (i = j = -1)."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32())] + [(f"l{k}", pa.int64()) for k in range(_LIMBS)])

    def block(x: np.ndarray, total: np.ndarray, sums: np.ndarray) -> None:
        low = x.min(axis=0)
        y = x - low
        s = [sum(c.tolist()) for c in y.T] if len(y) * int(y.max()) >= 1 << 62 else y.sum(axis=0).tolist()
        s, low = np.array(s, object), low.astype(object)
        cross = np.outer(low, s)
        total += sliced_products(y).astype(object) + cross + cross.T + len(x) * np.outer(low, low)
        sums += s + len(x) * low

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, n, held, rows = np.zeros((d, d), object), np.zeros(d, object), 0, [], 0
        for batch in batches:
            held.append(_matrix(batch.column("vector"), d))
            rows += len(held[-1])
            if rows >= _BLOCK:
                every = np.concatenate(held)
                for at in range(0, rows - rows % _BLOCK, _BLOCK):
                    block(every[at : at + _BLOCK], total, sums)
                n += rows - rows % _BLOCK
                held, rows = [every[rows - rows % _BLOCK :]], rows % _BLOCK
        if rows:
            block(np.concatenate(held), total, sums)
            n += rows
        if n:
            out = [(-1, -1, n)] + [(-1, j, sums[j]) for j in range(d)] + [(i, j, total[i, j]) for i in range(d) for j in range(i, d)]
            columns = list(zip(*[(i, j, *_limbs(int(v))) for i, j, v in out]))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scatter


@dataclass
class Whitening:
    """What the fit list gives: n, sums S, eigenvalues and unit eigenvectors (rows) by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float


def components(n: int, sums: list[int], products: list[list[int]], most: int) -> Whitening:
    """Eigenvectors of the covariance (n * products - S S') / n^2, whose numerators are integers until the one division.

    Axes whose eigenvalue is not above the rounding error of the largest one have no direction of their own and are
    left out. An axis points to where its largest entry is positive.
    """
    d = len(sums)
    centred = [[n * products[min(i, j)][max(i, j)] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    v = np.array([[c / (n * n) for c in row] for row in centred])  # integer / integer is rounded once
    trace = sum(centred[i][i] for i in range(d)) / (n * n)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(values.max(), 0.0) * d * 4 * np.finfo(float).eps]
    axes = vectors.T[order]
    signs = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)]) if len(axes) else np.ones(0)
    return Whitening(n, sums, values[order], axes * signs[:, None], trace)


def fitted(vectors: DataFrame, d: int, most: int = 8) -> Whitening | None:
    """The whitening of a frame's column `vector`, every vector of d usable entries; None without rows.

    Each task sends d * (d + 3) / 2 + 1 sums, which Spark adds up; the driver gets that many in all.
    """
    parts = vectors.select("vector").mapInArrow(_scatter(d), _PARTIAL)
    total = parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)])
    found = {(r.i, r.j): sum(r[f"l{k}"] << 40 * k for k in range(_LIMBS)) for r in total.collect()}
    if not found:
        return None
    products = [[found.get((i, j), 0) for j in range(d)] for i in range(d)]
    return components(found[-1, -1], [found[-1, j] for j in range(d)], products, most)


_WHITE = "id long, deviation string, white array<double>"


def _project(fit: Whitening) -> Callable:
    n, d = fit.n, len(fit.sums)
    scaled = fit.axes.T / np.sqrt(fit.values)
    schema = pa.schema([("id", pa.int64()), ("deviation", pa.string()), ("white", pa.list_(pa.float64()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(fit.sums, object)
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                part = batch.slice(at, 1_024)
                x = _matrix(part.column("vector"), d)
                # n * x - S fits a long if it stays below the root of what d squares may add up to.
                reach = n * int(np.abs(x).max()) + max(map(abs, fit.sums))
                if reach < isqrt((1 << 63) // d):
                    off = n * x - np.array(fit.sums, np.int64)
                    deviation = [str(v) for v in (off * off).sum(axis=1).tolist()]
                    off = off / n
                else:
                    off = x.astype(object) * n - sums
                    deviation = [str(v) for v in (off * off).sum(axis=1)]
                    off = (off / n).astype(np.float64)
                white = off @ scaled
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))
                yield pa.record_batch([part.column("id"), pa.array(deviation), lists], schema=schema)

    return project


def whitened(frame: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = 8) -> DataFrame:
    """For each usable vector and component 1 to `most`: id, component, n, deviation, whitened, explained, identity_error.

    Not usable are vectors that are NULL or empty, that hold a NULL, NaN, infinite or (beyond 2^60 when scaled) too
    large entry, or that have another length than most usable ones (the longer at a tie); they are in neither fit nor
    result. Rows without id and rows that repeat an id or a vector count one by one. Fewer components come out where
    the vectors have fewer directions; none where all are equal, or in an empty table. deviation is a decimal, NULL
    beyond 38 digits. identity_error is measured on the whitened rows. Other columns of `frame` aren't read.

    Three passes read the vectors: the sums, the covariance of the result, and the result. No pass moves vectors.
    """
    rows = frame.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")).where(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    fit = fitted(rows.where(F.size("vector") == d), d, most) if d else None
    k = len(fit.values) if fit else 0
    if not k:
        empty = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return frame.sparkSession.createDataFrame([], empty)
    white = rows.where(F.size("vector") == d).mapInArrow(_project(fit), _WHITE)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    w = F.col("white")
    covariance = white.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()[0]
    error = max(abs(covariance[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
    return white.select(
        "id", F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"), F.posexplode("white").alias("at", "whitened")
    ).select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """`whitened` over all embeddings; deviation is NULL where the exact figure, in deviation_wide, is beyond a long."""
    rows = whitened(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"))
    return rows.select(
        F.col("id").alias("vec_id"),
        "component",
        "n",
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        F.col("deviation").alias("deviation_wide"),
    )
