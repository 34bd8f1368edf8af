"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Every entry c becomes x = floor(64 * c) + 1000000. The fit list is each distinct x vector once: n vectors, sums S. Its
centred rows X = (n * x - S) / n are packed once into blocks of doubles. Each step of the bidiagonalisation alternates
two distributed products over the blocks: X v, made orthogonal to all earlier left vectors, and X'u, made orthogonal to
all earlier right vectors. A left vector is as long as the table, so it isn't stored: it is X c for a short c that is kept
instead, and each block makes its part of it anew. So a step sends a few short vectors out and sums of a few
short vectors back, and a lost executor costs one block's products. The singular value decomposition of the small
bidiagonal matrix yields the components (right vectors) and deviations.

The steps end when the leading components have converged and what is left of the trace is less than the last one's share, so
that none is missed, or with the last dimension. Where a step breaks down (an invariant subspace, as with repeated
eigenvalues), it starts again from a direction orthogonal to all before.

Defined results: rows whose vector is null, empty, holds null or non-finite entries, or has another length than most (the longer
of ties) take no part, nor do those with an entry of 2**46 or more. Rows with null ids and repeated rows each get a result. Directions without
variance have no component, so a table of equal vectors gives rows without components. A deviation over a long is null.
An empty table gives no rows. Other columns stay as they are; those named like an output give way to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
#: entries stay under this, so that scaled ones are exact in a double
LARGEST = float(1 << 46)
#: rows that are packed into a block: 8 bytes an entry
BLOCK_ROWS = 2048
#: relative to the norm of all rows: a product this small is rounding, and a residual this small is convergence
TINY = 1e-13
CONVERGED = 1e-15
#: left vectors whose inner product with an earlier one is over this are orthogonalised once more
ORTHOGONAL = 1e-14
SEED = 11


def scaled(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows that take part, with ``_x``: the scaled vector."""
    v = F.col(column)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST))
    have = rows.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))
    lengths = have.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    have = have.where(F.size(v) == (lengths["d"] if lengths else 0))
    return have.withColumn("_x", F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT))


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists of longs as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _blocks(rows: DataFrame) -> DataFrame:
    """(m, data): m vectors back to back."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(at, BLOCK_ROWS))
                yield pa.RecordBatch.from_pydict({"m": pa.array([len(x)], pa.int64()), "data": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())})

    return rows.mapInArrow(pack, "m long, data binary")


def _each(batches: Iterator[pa.RecordBatch], kind) -> Iterator[np.ndarray]:
    for batch in batches:
        for m, data in zip(batch.column("m").to_pylist(), batch.column("data"), strict=True):
            yield np.frombuffer(data.as_buffer(), kind).reshape(m, -1)


def _sums(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``part`` over all blocks; a task sends its own sum, and Spark adds those up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for z in _each(batches, np.float64):
            total += part(z)
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size), pa.int32()), "v": pa.array(total)})

    got = blocks.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[got.column("i").to_numpy()] = got.column("v").to_numpy()
    return out


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S; Python integers where a long would overflow."""
    largest = int(np.abs(x).max(initial=0))
    if n * largest + max((abs(s) for s in sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return np.array([[n * int(a) - s for a, s in zip(r, sums, strict=True)] for r in x], object).reshape(x.shape)


def squared(dev: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, null beyond a long."""
    largest = int(np.abs(dev).max(initial=0))
    if largest * largest * max(dev.shape[1], 1) < 1 << 63:
        return np.einsum("ij,ij->i", dev, dev).tolist()
    return [s if s < 1 << 63 else None for s in (sum(int(a) * int(a) for a in r) for r in dev)]


@dataclass
class Products:
    """The distributed products with the centred rows X."""

    blocks: DataFrame
    dims: int

    def left(self, v: np.ndarray, coeffs: np.ndarray) -> np.ndarray:
        """U'(X v) for the left vectors U = X coeffs; ``v`` may be several, as columns."""
        shape = (coeffs.shape[1], *v.shape[1:])
        return _sums(self.blocks, lambda z: ((z @ coeffs).T @ (z @ v)).ravel(), int(np.prod(shape))).reshape(shape)

    def right(self, c: np.ndarray, coeffs: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """For u = X c: X'u, its squared norm, and U'u."""

        def part(z: np.ndarray) -> np.ndarray:
            u = z @ c
            return np.concatenate((z.T @ u, [u @ u], (z @ coeffs).T @ u))

        got = _sums(self.blocks, part, self.dims + 1 + coeffs.shape[1])
        return got[:self.dims], float(got[self.dims]), got[self.dims + 1:]


def _orthogonal(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        w = w - basis @ (basis.T @ w)
    return w


def bidiagonalise(x, total: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(right vectors, singular values) of the ``k`` leading components with a singular value over rounding.

    ``x`` has the products; ``total`` is the squared Frobenius norm of X.
    """
    d, norm, rng = x.dims, float(np.sqrt(total)), np.random.default_rng(SEED)
    if norm == 0.0:
        return np.zeros((d, 0)), np.zeros(0)
    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    basis, coeffs, b = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, d))
    for j in range(d):
        basis = np.column_stack((basis, v))
        h = x.left(v, coeffs) if j else np.zeros(0)
        c = v - coeffs @ h
        r, uu, slant = x.right(c, coeffs)
        while slant.size and uu > (TINY * norm) ** 2 and np.abs(slant).max() > ORTHOGONAL * norm * np.sqrt(uu):
            c = c - coeffs @ slant
            before = uu
            r, uu, slant = x.right(c, coeffs)
            if uu > 0.5 * before:  # twice is enough
                break
        alpha = float(np.sqrt(uu))
        if j:
            b[j - 1, j] = h[j - 1]
        if alpha <= TINY * norm:  # X v is in the span of the left vectors
            alpha, w = 0.0, np.zeros(d)
            coeffs = np.column_stack((coeffs, np.zeros(d)))
        else:
            coeffs = np.column_stack((coeffs, c / alpha))
            w = _orthogonal(r / alpha - alpha * v, basis)
        b[j, j] = alpha
        beta = float(np.linalg.norm(w))
        p, s, qt = np.linalg.svd(b[:j + 1, :j + 1])
        if j + 1 >= k:
            rest = total - float((b[:j + 1, :j + 1] ** 2).sum())
            if beta * np.abs(p[j, :k]).max() <= CONVERGED * s[0] and rest < 0.5 * s[k - 1] ** 2:
                break
        if j + 1 == d:
            break
        if beta <= TINY * norm:  # an invariant subspace: go on outside of it
            w = _orthogonal(rng.standard_normal(d), basis)
            beta = float(np.linalg.norm(w))
        v = _orthogonal(w / beta, basis)
        v /= np.linalg.norm(v)
    keep = min(k, int((s > max(d, 16) * TINY * s[0]).sum()))
    right, s = basis @ qt[:keep].T, s[:keep]
    # where coefficients are long, X c is rounded by more than its last bits: the inner products of what the right vectors
    # make tell how far that has gone, and set vectors and values right within their span
    far = right / s
    turn = np.linalg.cholesky(x.left(far, far)).T * s
    _, s, qt = np.linalg.svd(turn)
    qt[np.diag(qt) < 0] *= -1  # a vector keeps its sign
    return right @ qt.T, s


@dataclass
class Whitening:
    """A fitted whitening: n vectors, exact sums, unit components (columns), their variances, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    def __call__(self, rows: DataFrame, column: str = "embedding") -> DataFrame:
        """The rows that take part, with ``deviation`` (long: squared distance from the mean, times n squared) and ``whitened`` (array of doubles)."""
        return self._apply(scaled(rows, column))

    def _apply(self, have: DataFrame) -> DataFrame:
        n, sums, out = self.n, self.sums, self.components / np.sqrt(self.variances)
        keep = [c for c in have.columns if c not in ("_x", "deviation", "whitened")]
        k = out.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(at, BLOCK_ROWS)
                    dev = exact_deviation(_matrix(part.column("_x")), n, sums)
                    white = (dev.astype(np.float64) / n) @ out
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(dev) + 1) * k, pa.int32()), pa.array(white.ravel()))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(squared(dev), pa.int64()), lists], [*keep, "deviation", "whitened"])

        schema = T.StructType([have.schema[c] for c in keep] + [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType(), False))])
        return have.select(*keep, "_x").mapInArrow(run, schema)


def fit(rows: DataFrame, k: int = COMPONENTS, column: str = "embedding") -> Whitening:
    """Fit the whitening to the distinct scaled vectors of ``rows``."""
    return _fit(scaled(rows, column), k)


def _fit(have: DataFrame, k: int) -> Whitening:
    packed = stored(_blocks(have.select("_x").distinct()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for x in _each(batches, np.int64):
            n += len(x)
            small = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
            total = total + (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, len(total)), pa.int32()), "v": pa.array([str(int(t)) for t in (n, *total)])})

    got = packed.mapInArrow(add, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).orderBy("i").collect()
    if not got:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    n, sums = int(got[0]["v"]), [int(r["v"]) for r in got[1:]]
    d = len(sums)

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _each(batches, np.int64):
            z = exact_deviation(x, n, sums).astype(np.float64) / n
            yield pa.RecordBatch.from_pydict({"m": pa.array([len(z)], pa.int64()), "data": pa.array([z.tobytes()], pa.binary())})

    blocks = stored(packed.mapInArrow(centre, "m long, data binary"))
    total = float(_sums(blocks, lambda z: np.array([np.einsum("ij,ij->", z, z)]), 1)[0])
    components, s = bidiagonalise(Products(blocks, d), total, min(k, d))
    variances = s * s / n
    out = components / np.sqrt(variances)
    k = len(s)

    def moments(z: np.ndarray) -> np.ndarray:
        w = z @ out
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    got = _sums(blocks, moments, k + k * k) / n
    error = np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max(initial=0.0)
    return Whitening(n, sums, components, variances, total / n, float(error))


def whiten(rows: DataFrame, k: int = COMPONENTS, column: str = "embedding") -> tuple[DataFrame, Whitening]:
    """The rows that take part with ``deviation`` and ``whitened``, by the whitening fitted to them, and that whitening."""
    have = scaled(rows, column)
    model = _fit(have, k)
    return model._apply(have), model
