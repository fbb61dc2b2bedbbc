"""Whitening: against a full decomposition of the covariance in one process."""

from collections import defaultdict

import numpy as np
import pytest

from labelmill.llm.queries import op12_whitening
from labelmill.llm.whitening import fit_list, fit_whitening, leading_pairs, minres, whiten

KIND = "vec_id long, embedding array<float>, label int"


def reference(vectors, components=16):
    """n, sums, fit covariance's falling eigenvalues and vectors, from lists of floats."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1][:components], columns[:, ::-1][:, :components], values.sum()


def usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]


def check(out, rows, components=16):
    x, n, sums, values, columns, trace = reference([r[1] for r in rows], components)
    values = values[values > 1e-12 * values[0]]
    k = len(values)
    assert len(out) == len(rows) * k
    away = n * x - sums
    expected = defaultdict(list)
    for r, d, z in zip(rows, (away**2).sum(axis=1), (away / n).astype(float) @ columns[:, :k] / np.sqrt(values)):
        expected[r[0]].append((int(d), z))
    for r in out:
        d, z = expected[r.vec_id][0]
        assert (r.n, int(r.deviation)) == (n, d)
        assert abs(r.explained - values[r.component - 1] / trace) <= 1e-10
        assert r.identity_error < 1e-10
        assert abs(abs(r.whitened) - abs(z[r.component - 1])) < 1e-6
    signs = defaultdict(set)
    for r in out:
        z = expected[r.vec_id][0][1][r.component - 1]
        if abs(z) > 1e-3:
            signs[r.component].add(np.sign(z * r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_query_on_the_given_vectors(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(op12_whitening(spark, sf_dir).collect(), usable(rows))


def test_residuals_are_of_double_precision(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").repartition(7)
    found = fit_whitening(table)
    assert len(found.values) == 16 and (np.diff(found.values) <= 0).all()
    assert (found.residuals <= 2e-14 * found.values[0]).all()
    assert np.abs(found.vectors.T @ found.vectors - np.eye(16)).max() < 1e-13
    _, _, _, values, columns, _ = reference([r[1] for r in usable([tuple(r) for r in table.collect()])])
    assert np.abs(found.values / values - 1).max() < 1e-12


@pytest.mark.parametrize("size, wanted", [(1, 1), (5, 16), (64, 16), (300, 16), (400, 3)])
@pytest.mark.parametrize("kind", ["flat", "falling", "equal", "rank"])
def test_pairs_of_matrices(size, wanted, kind):
    rng = np.random.default_rng(size + wanted)
    values = {
        "flat": 1 + 0.1 * rng.random(size), "falling": 0.8 ** np.arange(size) + 1e-3,
        "equal": np.where(np.arange(size) < size // 2, 2.0, 1.0), "rank": np.where(np.arange(size) < 4, 4.0 - np.arange(size), 0.0),
    }[kind]
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    calls = []
    got, vectors, residuals = leading_pairs(lambda w: calls.append(1) or matrix @ w, size, wanted)
    expected = np.sort(values)[::-1][: len(got)]
    assert len(got) == min(size, wanted)
    assert np.abs(got - expected).max() < 1e-12 * expected[0]
    assert np.linalg.norm(matrix @ vectors - vectors * got, axis=0).max() < 1e-13 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert len(calls) < 400


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a = a @ a.T
    q = np.linalg.qr(rng.standard_normal((30, 4)))[0]
    p = np.eye(30) - q @ q.T
    right = p @ rng.standard_normal((30, 3))
    theta = np.array([1.0, 50.0, 80.0])
    t = minres(lambda w: a @ w, theta, q, right, 60)
    for j in range(3):
        assert np.linalg.norm(p @ (a - theta[j] * np.eye(30)) @ p @ t[:, j] - right[:, j]) < 2e-4 * np.linalg.norm(right[:, j])


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.standard_normal(6) * [4, 2, 1, 1, 0.5, 0]], 1) for i in range(200)]
    rows += [rows[0], (None, rows[1][1], None), (300, rows[2][1], 0)]
    odd = [(401, None, 1), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (403, [float("nan")] * 6, 1), (404, [float("inf")] + [0.0] * 5, 1)]
    other = [(405, [], 1), (406, [1.0, 2.0], 1)]
    kind = KIND + ", Embedding2 string, component string, EMBEDDING string, n long"
    table = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows + odd + other], kind).repartition(5)
    out = whiten(table).collect()
    assert {r.component for r in out} == {1, 2, 3, 4, 5}
    check(out, [(r[0], r[1]) for r in rows])
    assert len([r for r in out if r.vec_id == 0]) == 10 and len([r for r in out if r.vec_id is None]) == 5


def test_tables_without_components(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 3, [(1, [], 1)]):
        out = whiten(spark.createDataFrame(rows, KIND))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_numbers_beyond_the_bounds(spark):
    rows = [(i, [1e30 if i % 2 else -1e30, float(i)], 1) for i in range(8)]
    table = spark.createDataFrame(rows, KIND)
    fitted = fit_list(table)
    assert fitted.n == 8 and fitted.sums[1] == 64 * 28
    out = whiten(table).collect()
    # sqrt(n) x is far beyond a long's square root: the deviation is exact all the same
    assert {int(r.deviation) for r in out} == {(8 * (1 << 40)) ** 2 + (8 * 64 * i - 64 * 28) ** 2 for i in range(8)}
