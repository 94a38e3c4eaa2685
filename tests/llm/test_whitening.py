"""Whitening against exact fractions and plain numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from lodestar.llm import whitening


def vectors(n: int = 300, dim: int = 20) -> list[tuple]:
    rng = np.random.default_rng(5)
    m = (rng.normal(size=(n, dim)) @ np.diag(np.linspace(0.05, 1.5, dim))).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    hot = rows[3][1]
    rows += [(1000 + k, hot) for k in range(150)] + [(3, hot), (None, rows[4][1])]
    bad = [None, [], hot[:5], [*hot[:-1], None], [*hot[:-1], float("nan")], [*hot[:-1], float("inf")], [*hot[:-1], 1e30]]
    return rows + [(2000 + k, v) for k, v in enumerate(bad)]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, v, 0, "x", 1.5) for i, v in vectors()]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, x string, n double").repartition(4)


def brute():
    usable = [(i, v) for i, v in vectors() if v and len(v) == 20 and all(x is not None and math.isfinite(x) and abs(x) < 1e12 for x in v)]
    rows = [(i, tuple(math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in usable]
    return rows, sorted({x for _, x in rows})


def test_against_exact_fractions(table):
    rows, distinct = brute()
    n, dim = len(distinct), 20
    sums = [sum(x[d] for x in distinct) for d in range(dim)]
    cov = np.array([[float(sum(Fraction(x[i] * n - sums[i], n) * Fraction(x[j] * n - sums[j], n) for x in distinct) / n) for j in range(dim)] for i in range(dim)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    got = whitening.whiten(table).collect()
    assert len(got) == 16 * len(rows) and {r["n"] for r in got} == {n}
    deviation = {(i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in rows}
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == deviation
    for k in range(16):
        part = [r for r in got if r["component"] == k + 1]
        assert all(abs(r["explained"] - values[k] / np.trace(cov)) < 1e-9 for r in part)
        want = {i: (np.array([float(Fraction(c * n - s, n)) for c, s in zip(x, sums, strict=True)]) @ axes[:, k]) / math.sqrt(values[k]) for i, x in rows}
        signs = {round(r["whitened"] / want[r["vec_id"]]) for r in part if abs(want[r["vec_id"]]) > 0.1}
        assert len(signs) == 1 and signs <= {1, -1}
        assert max(abs(r["whitened"] - signs.copy().pop() * want[r["vec_id"]]) for r in part) < 1e-6
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("spread", [1, 2, 90, 2**40])
def test_scatter_is_exact(spread):
    rng = np.random.default_rng(spread)
    x = rng.integers(-spread, spread, size=(131, 6), endpoint=True) + whitening.OFFSET
    x[:, 2] = whitening.OFFSET + 7  # no variance: no bit planes
    sums, cross = whitening.scatter(x)
    y = (x - whitening.OFFSET).astype(object)
    assert sums.tolist() == y.sum(axis=0).tolist() and (cross == y.T @ y).all()


def test_blocks_add_up(spark, monkeypatch):
    rng = np.random.default_rng(2)
    m = rng.integers(-50, 50, size=(500, 4))
    d = spark.createDataFrame([([int(c) + whitening.OFFSET for c in r],) for r in m], "x array<long>").distinct().repartition(3)
    one = whitening.fit(d)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    many = whitening.fit(d)
    assert one.sums == many.sums and one.n == many.n and np.array_equal(one.values, many.values)


def test_wide_values_stay_exact():
    w = whitening.Whitening(10**10, [10**10 * 5, -(10**10)], np.ones(2), np.eye(2), 2.0)
    x = np.array([[2**50, -(2**50)], [5, -1]])
    assert whitening.deviations(x, w) == [(10**10 * (2**50 - 5)) ** 2 + (10**10 * (1 - 2**50)) ** 2, 0]


def test_without_variance_or_rows(spark, table):
    assert whitening.whiten(table.where("false")).count() == 0
    same = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0
    line = spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.5, 0.25])], "vec_id long, embedding array<double>")
    got = whitening.whiten(line).collect()  # one direction only
    assert [(r["component"], r["explained"]) for r in got] == [(1, 1.0), (1, 1.0)] and sorted(r["whitened"] for r in got) == [-1.0, 1.0]
