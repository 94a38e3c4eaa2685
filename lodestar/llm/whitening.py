"""Embedding whitening from exact integer cross-products by bit-sliced counting.

An entry ``c`` becomes the integer ``x = floor(SCALE * c) + OFFSET``. The fit
list holds each distinct integer vector once.

1. A task takes its fit vectors in blocks of ``BLOCK_ROWS``, shifts each
   dimension by its smallest value in the block and packs every bit plane of the
   shifted values across the rows into 64-bit words.
2. ``sum(y_i * y_j)`` is the sum over planes a, b of ``2^(a+b)`` times the set
   bits of (plane a of i AND plane b of j). With the block's sums and shift this
   gives its exact cross-products around ``OFFSET``. Sums over blocks are exact
   decimals.
3. The covariance times ``n^2`` is ``n * S_ij - S_i * S_j``, centred in integers;
   only the quotient is rounded, before ``eigh``. One matrix of D x D reaches the
   driver, whatever the number of rows.

Rows whose vector is null, holds null or non-finite entries, or entries of
``MAX_ENTRY`` or more in size (no exact integer) are dropped, and so are vectors
of another length than the most frequent one (of two, the longer). Repeated
rows, also with equal vec_id, each get their result; a null vec_id is a value
like any other. Directions without variance (beyond the rank of the fit list)
are no components, so a table of one distinct vector, or an empty one, gives an
empty result. Only the id and the vector are read: further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries of this size or more don't become exact integers.
MAX_ENTRY = float(2**44)
BLOCK_ROWS = 1 << 16
#: Eigenvalues below this share of the largest count as none.
MIN_SHARE = 1e-12


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows with a whole vector of the usual length, as array<double> in ``_v``."""
    v = F.col("_v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= MAX_ENTRY))
    d = rows.withColumn("_v", F.col(vector).cast("array<double>")).where(v.isNotNull() & (F.size(v) > 0) & ~odd)
    lengths = d.groupBy(F.size("_v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.agg(F.max(F.struct("rows", "n")).alias("m")).select("m.n").first()
    return d.where(F.size("_v") == (usual[0] if usual and usual[0] is not None else 0))


def integers(v: Column) -> Column:
    return F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c).cast("long") + OFFSET)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def bit_planes(y: np.ndarray) -> list[np.ndarray]:
    """For each column of non-negative integers its bit planes, lowest first: rows packed into 64-bit words."""
    n, dim = y.shape
    words = -(-n // 64)
    out = []
    for d in range(dim):
        width = int(y[:, d].max(initial=0)).bit_length()
        bits = np.zeros((width, words * 64), dtype=np.uint8)
        for a in range(width):
            bits[a, :n] = (y[:, d] >> a) & 1
        out.append(np.packbits(bits, axis=1).view(np.uint64))
    return out


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cross-products) of the integer rows around OFFSET, as exact Python integers."""
    n, dim = x.shape
    low = x.min(axis=0)
    planes = bit_planes(x - low)
    widths = np.array([len(p) for p in planes])
    first = np.r_[0, np.cumsum(widths)]
    flat = np.concatenate([p for p in planes if len(p)]) if widths.any() else np.zeros((0, 1), dtype=np.uint64)
    weight = np.concatenate([np.arange(w) for w in widths]).astype(int) if widths.any() else np.zeros(0, dtype=int)
    held = np.zeros((dim, dim), dtype=object)
    for i in range(dim):
        for a in range(widths[i]):
            ones = np.bitwise_count(flat[first[i]:] & flat[first[i] + a]).sum(axis=1, dtype=np.int64)
            for j in range(i, dim):
                lo, hi = first[j] - first[i], first[j + 1] - first[i]
                held[i, j] += sum(int(c) << (a + int(w)) for c, w in zip(ones[lo:hi], weight[first[j]:first[j + 1]], strict=True))
    sums = [sum(int(np.bitwise_count(p[a]).sum()) << a for a in range(len(p))) for p in planes]
    base = [int(m) - OFFSET for m in low]
    for i in range(dim):
        for j in range(i, dim):
            held[i, j] += base[i] * sums[j] + base[j] * sums[i] + n * base[i] * base[j]
            held[j, i] = held[i, j]
    return np.array([s + n * b for s, b in zip(sums, base, strict=True)], dtype=object), held


@dataclass
class Whitening:
    """``n`` fit vectors, their sums of x by dimension, eigenvalues, unit eigenvectors in columns, and the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(distinct: DataFrame) -> Whitening | None:
    """The whitening of the fit list (``x`` array<long>, each vector once); None without variance."""

    def blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, total = [], 0, None
        def add():
            nonlocal total
            m = np.concatenate(held)
            s, c = scatter(m)
            total = (len(m), s, c) if total is None else (total[0] + len(m), total[1] + s, total[2] + c)
        for part in parts:
            if part.num_rows:
                held.append(_matrix(part.column("x")))
                rows += part.num_rows
            if rows >= BLOCK_ROWS:
                add()
                held, rows = [], 0
        if held:
            add()
        if total is not None:
            n, s, c = total
            dim = len(s)
            cells = [(-1, -1, n)] + [(i, -1, s[i]) for i in range(dim)] + [(i, j, c[i, j]) for i in range(dim) for j in range(i, dim)]
            i, j, v = zip(*cells, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(t)) for t in v], pa.decimal128(38, 0))], names=["i", "j", "v"])

    cells = distinct.mapInArrow(blocks, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = {(r["i"], r["j"]): int(r["v"]) for r in cells.collect()}  # D * (D + 3) / 2 + 1 numbers
    if not found:
        return None
    n = found[-1, -1]
    dim = sum(j == -1 for _, j in found) - 1
    s = [found[i, -1] for i in range(dim)]
    v = np.empty((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            v[i, j] = v[j, i] = (n * found[i, j] - s[i] * s[j]) / (n * n)  # integers up to the quotient
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(v))
    keep = values > MIN_SHARE * max(values[0], 0.0)
    if trace <= 0 or not keep.any():
        return None
    return Whitening(n, [t + n * OFFSET for t in s], values[keep], np.ascontiguousarray(vectors[:, keep]), trace)


def _centred(x: np.ndarray, w: Whitening) -> np.ndarray:
    """``n * x - S``, exact: 64-bit where it fits, else Python integers."""
    s = w.sums
    if w.n * int(np.abs(x).max(initial=0)) < 2**61 and max(map(abs, s)) < 2**61:
        return x * np.int64(w.n) - np.array(s, dtype=np.int64)
    return x.astype(object) * w.n - np.array(s, dtype=object)


def whitened(x: np.ndarray, w: Whitening, k: int) -> np.ndarray:
    """Rows projected on the first ``k`` components, with unit variance."""
    y = _centred(x, w).astype(np.float64) / w.n
    return (y @ w.vectors[:, :k]) / np.sqrt(w.values[:k])


def deviations(x: np.ndarray, w: Whitening) -> list[int]:
    y = _centred(x, w)
    if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 2**62:
        return (y * y).sum(axis=1).tolist()
    return [sum(int(t) ** 2 for t in row) for row in y]


def identity_error(distinct: DataFrame, w: Whitening, k: int) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity; two passes, centred first."""

    def summed(of) -> np.ndarray:
        def run(parts):
            total = None
            for part in parts:
                if part.num_rows:
                    t = of(whitened(_matrix(part.column("x")), w, k))
                    total = t if total is None else total + t
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])
        rows = distinct.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # at most k * k numbers
        return np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])])

    mean = summed(lambda t: t.sum(axis=0)) / w.n
    cov = summed(lambda t: ((t - mean).T @ (t - mean)).ravel()).reshape(k, k) / w.n
    return float(np.abs(cov - np.eye(k)).max())


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation decimal, whitened, explained, identity_error), one row per usable row and component."""
    spark = rows.sparkSession
    checkpoint_dir(spark)
    d = usable(rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("_e")), "_e").select("vec_id", integers(F.col("_v")).alias("x")).checkpoint()
    distinct = d.select("x").groupBy("x").agg(F.count(F.lit(1)).alias("rows")).select("x").checkpoint()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    w = fit(distinct)
    if w is None:
        return spark.createDataFrame([], schema)
    k = min(components, len(w.values))
    error = identity_error(distinct, w, k)
    share = w.values[:k] / w.trace

    def project(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n = part.num_rows
            if not n:
                continue
            x = _matrix(part.column("x"))
            each = np.repeat(np.arange(n), k)
            deviation = pa.array([Decimal(t) for t in deviations(x, w)], pa.decimal128(38, 0)).take(pa.array(each))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, w.n, dtype=np.int64)), deviation,
                pa.array(whitened(x, w, k).ravel()), pa.array(np.tile(share, n)), pa.array(np.full(n * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return d.mapInArrow(project, schema)
