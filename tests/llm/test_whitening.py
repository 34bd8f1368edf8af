"""Embedding whitening against an eigendecomposition of the exact covariance."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from poolwright.llm import whitening as wh

from . import data

SCHEMA = "vec_id long, embedding array<float>, label int"


class Local:
    """The products over a matrix in memory."""

    def __init__(self, x):
        self.x, self.dims, self.steps = x, x.shape[1], 0

    def left(self, v, coeffs):
        return (self.x @ coeffs).T @ (self.x @ v)

    def right(self, c, coeffs):
        self.steps += 1
        u = self.x @ c
        return self.x.T @ u, float(u @ u), (self.x @ coeffs).T @ u


def same_up_to_sign(a, b, tol):
    assert a.shape == b.shape
    for k in range(a.shape[1]):
        sign = np.sign(a[:, k] @ b[:, k])
        assert np.abs(a[:, k] - sign * b[:, k]).max() <= tol


def brute(rows, k=16):
    """(n, {row: deviation}, whitened, explained) by exact sums and numpy's eigendecomposition."""
    xs = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for _, v in rows]
    fit = sorted(set(map(tuple, xs)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    e, vec = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-e)[:k]
    mine = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in xs])
    return n, [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in xs], mine @ vec[:, order] / np.sqrt(e[order]), e[order] / e.sum()


@pytest.mark.parametrize("spectrum", ["flat", "steep", "repeated", "deficient", "steps"])
def test_bidiagonalisation(spectrum):
    rng = np.random.default_rng(4)
    d = 40
    s = {"flat": np.linspace(1, 1.3, d), "steep": 10.0 ** -np.linspace(0, 7, d), "repeated": np.repeat([3.0, 2.0], d // 2),
         "deficient": np.r_[np.linspace(1, 2, 9), np.zeros(d - 9)], "steps": np.r_[np.linspace(50, 90, 18), np.full(d - 18, 0.01)]}[spectrum]
    u, v = np.linalg.qr(rng.standard_normal((300, d)))[0], np.linalg.qr(rng.standard_normal((d, d)))[0]
    x = Local((u * s) @ v.T)
    got, sigma = wh.bidiagonalise(x, float((x.x ** 2).sum()), 16)
    want = np.sort(s)[::-1][:16]
    want = want[want > 0]
    assert len(sigma) == len(want) and np.abs(sigma - want).max() < 1e-12 * want[0]
    assert np.abs(got.T @ got - np.eye(len(want))).max() < 1e-13
    assert np.abs(x.x.T @ (x.x @ got) - got * sigma ** 2).max() < 1e-12 * want[0] ** 2
    if spectrum == "steps":
        assert x.steps < d  # it ends once what is left can't hold a leading component


@pytest.mark.parametrize("seed", range(0, 24, 4))
def test_rows_of_low_rank_keep_full_precision(seed):
    """Left vectors have long coefficients here; the values were off by up to 4e-12 of the largest, by seed and kind of processor."""
    rng, d = np.random.default_rng(seed), 40
    for s in (np.linspace(1, 2, 9), np.r_[np.linspace(1, 2, 5), np.linspace(0.1, 0.2, 6)]):
        u, v = np.linalg.qr(rng.standard_normal((300, len(s))))[0], np.linalg.qr(rng.standard_normal((d, len(s))))[0]
        x = Local((u * s) @ v.T)
        got, sigma = wh.bidiagonalise(x, float((x.x ** 2).sum()), 16)
        assert len(sigma) == len(s) and np.abs(sigma - np.sort(s)[::-1]).max() < 2e-14
        assert np.abs(got.T @ got - np.eye(len(s))).max() < 1e-13 and np.abs(x.x.T @ (x.x @ got) - got * sigma ** 2).max() < 1e-13


def odd_rows():
    rng = np.random.default_rng(9)
    rows = [(k, rng.standard_normal(24).astype(np.float32).tolist(), k % 3) for k in range(150)]
    rows += [(1000 + k, rows[3][1], 0) for k in range(80)] + [(3, rows[3][1], 1), (None, rows[5][1], 1)]
    bad = [(-1, None, 0), (-2, [], 0), (-3, [None] * 24, 1), (-4, [float("nan")] + [0.0] * 23, 1), (-5, [float("inf")] + [0.0] * 23, 1), (-6, [1.0] * 23, 1), (-7, [1e30] + [0.0] * 23, 1)]
    return rows, bad


def test_odd_rows(spark):
    rows, bad = odd_rows()
    frame = spark.createDataFrame(rows + bad, SCHEMA).repartition(4).withColumns({c: F.lit("own") for c in ("deviation", "whitened", "_x", "n", "m", "data", "i", "v")})
    got, model = wh.whiten(frame)
    n, dev, white, explained = brute([r[:2] for r in rows])
    assert model.n == n == 150 and np.abs(model.variances / model.trace - explained).max() < 1e-12 and model.identity_error < 1e-10
    have = sorted(((r.vec_id is not None, r.vec_id or 0, r.label), r.deviation, r.whitened, r.n) for r in got.collect())
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][2]))
    assert [h[0] for h in have] == [(rows[i][0] is not None, rows[i][0] or 0, rows[i][2]) for i in order]
    assert [h[1] for h in have] == [dev[i] for i in order] and {h[3] for h in have} == {"own"}
    same_up_to_sign(np.array([h[2] for h in have]), white[order], 1e-9)


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert wh.whiten(empty)[0].collect() == []
    one = wh.whiten(spark.createDataFrame([(1, [0.5, 0.25], 0)] * 3, SCHEMA))[0].collect()
    assert [(r.deviation, r.whitened) for r in one] == [(0, [])] * 3
    two, model = wh.whiten(spark.createDataFrame([(1, [0.5, 0.25, 0.0], 0), (2, [1.5, 0.25, 0.0], 0)], SCHEMA))
    assert [len(r.whitened) for r in two.collect()] == [1, 1] and sorted(round(r.whitened[0], 9) for r in two.collect()) == [-1.0, 1.0]
    assert np.abs(np.abs(model.components[:, 0]) - [1.0, 0.0, 0.0]).max() < 1e-15


def test_deviation_beyond_a_long():
    dev = wh.exact_deviation(np.array([[1 << 45, 5], [0, 5]]), 1 << 20, [7, 5 << 20])
    assert dev.tolist() == [[(1 << 65) - 7, 0], [-7, 0]] and wh.squared(dev) == [None, 49]


def test_query(spark):
    from poolwright.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data.SF}/embeddings.parquet").collect()]
    got = QUERIES["op11_embedding_whitening"][0](spark, data.SF)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    n, dev, white, explained = brute(rows)
    have = sorted(map(tuple, got.collect()))
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    assert [h[:4] for h in have] == [(rows[i][0], c + 1, n, dev[i]) for i in order for c in range(16)]
    same_up_to_sign(np.array([h[4] for h in have]).reshape(len(rows), 16), white[order], 1e-9)
    assert np.abs(np.array([h[5] for h in have[:16]]) / explained - 1).max() < 1e-10 and have[0][6] < 1e-10
