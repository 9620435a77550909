import math

import numpy as np
import pytest

from learnsilver.llm import davidson_whitening as whitening
from learnsilver.llm.queries import op11_davidson_whitening
from learnsilver.llm.shared import read

NAN, INF = math.nan, math.inf
SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, x array<int>"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", "n", [1]) for i, v in rows], SCHEMA)


def check(rows, found, components=16):
    """``found`` against a dense eigensolver over (id, vector) rows that take part."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(components, int((values > 1e-10 * values[0]).sum()))
    keys = sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in found)
    assert keys == sorted((i is None, i or 0, c) for i, _ in rows for c in range(1, count + 1))
    deviation = ((n * x - sums) ** 2).sum(1)
    by_id = {i: (x[k], deviation[k]) for k, (i, _) in enumerate(rows)}
    for c in range(1, count + 1):
        own = [r for r in found if r.component == c]
        projected = np.array([(by_id[r.vec_id][0] - sums / n) @ axes[:, c - 1] / math.sqrt(values[c - 1]) for r in own])
        got = np.array([r.whitened for r in own])
        sign = 1 if got @ projected > 0 else -1
        assert np.abs(sign * got - projected).max() < 1e-9
        assert all(r.deviation == by_id[r.vec_id][1] and r.n == n for r in own)
        assert all(abs(r.explained - values[c - 1] / covariance.trace()) < 1e-12 for r in own)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whole_query_against_a_dense_solver(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in read(spark, folder, "embeddings").collect()]
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    check(good, op11_davidson_whitening(spark, folder).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(5).astype(np.float32).tolist()) for i in range(40)]
    rows += [(3, rows[3][1]), (41, rows[3][1]), (None, rows[4][1]), (42, [0.0] * 5)]
    odd = [(50, None), (51, []), (52, [1.0, None, 0.0, 0.0, 0.0]), (53, [NAN] * 5), (54, [INF] * 5), (55, [1.0, 2.0]), (56, [1e30] * 5)]
    found = whitening.whiten(frame(spark, rows + odd)).collect()
    check(rows, found)
    assert len(found) == 44 * 5


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]])
def test_no_variance(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []


def test_fewer_directions_than_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, np.repeat(rng.integers(-50, 50, 3), 4).astype(float).tolist()) for i in range(100)]
    found = whitening.whiten(frame(spark, rows), 8).collect()
    assert len(found) == 300
    check(rows, found, 8)


@pytest.mark.parametrize("size, kind", [(64, "plain"), (300, "plain"), (500, "falling"), (80, "clustered"), (200, "equal"), (3, "plain")])
def test_eigenpairs(size, kind):
    rng = np.random.default_rng(size)
    spectrum = {
        "plain": rng.uniform(1, 2, size), "falling": 1 / np.arange(1, size + 1),
        "clustered": np.r_[[5.0] * 10, 5 - 1e-6 * np.arange(1, 11), rng.uniform(0, 4, max(0, size - 20))], "equal": np.ones(size),
    }[kind]
    axes = np.linalg.qr(rng.standard_normal((size, size)))[0]
    matrix = axes * spectrum @ axes.T
    passes = []

    def product(columns):
        passes.append(columns.shape[1])
        return matrix @ columns

    values, found = whitening.jacobi_davidson(product, size, 16)
    k = min(16, size)
    assert np.allclose(values, np.sort(spectrum)[::-1][:k], rtol=0, atol=1e-13 * size)
    assert np.abs(matrix @ found - found * values).max() < 1e-12
    assert np.abs(found.T @ found - np.eye(k)).max() < 1e-13
    assert len(passes) < 250 and max(passes) <= whitening.SUBSPACE


def test_minres_solves_the_projected_equations():
    rng = np.random.default_rng(6)
    matrix = rng.standard_normal((40, 40))
    matrix = matrix + matrix.T
    away = np.linalg.qr(rng.standard_normal((40, 3)))[0]
    right = rng.standard_normal((40, 4))
    shifts = np.array([30.0, 25.0, 0.3, -28.0])
    x = whitening.minres(lambda c: matrix @ c, shifts, right, away, 1e-13, 120)
    apart = np.eye(40) - away @ away.T
    left = apart @ (matrix @ x - x * shifts) - apart @ right
    assert np.abs(left).max() < 1e-8 and np.abs(away.T @ x).max() < 1e-12


def test_deviations_are_exact():
    x = np.array([[2**40, 5], [0, 7]])
    sums = np.array([2**40, 12], object)
    assert whitening.deviations(np.array([[3, 5], [1, 7]]), 2, np.array([4, 12], object)).tolist() == [8, 8]
    with pytest.raises(OverflowError):
        whitening.deviations(x, 2, sums)
