import math
import random

import numpy as np
import pytest

from priceloom.llm import queries, whitening
from priceloom.session import settle

VECTORS = "vec_id long, embedding array<double>, label int, x string, key string, component string, n int"


def test_cholesky_of_any_rank():
    rng = np.random.default_rng(1)
    for size, rank in [(1, 1), (5, 5), (8, 3), (20, 19), (6, 0)]:
        basis = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-3, 3, size=rank)
        scatter = basis @ basis.T
        factor, order = whitening.pivoted_cholesky(scatter)
        assert factor.shape[1] == rank
        assert np.allclose(factor @ factor.T, scatter[np.ix_(order, order)], rtol=1e-12, atol=1e-12 * abs(scatter).max(initial=1))
        assert np.allclose(np.triu(factor[: factor.shape[1]], 1), 0)


@pytest.mark.parametrize("size", [1, 2, 7, 16, 33])
def test_eigen_against_lapack(size):
    rng = np.random.default_rng(size)
    basis = rng.normal(size=(size, size + 5)) * 10.0 ** rng.uniform(-3, 3, size=(size, 1))
    scatter = basis @ basis.T
    values, vectors = whitening.eigen(scatter)
    want = np.linalg.eigvalsh(scatter)[::-1]
    assert np.allclose(values, want, rtol=1e-9, atol=1e-14 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-12)
    assert np.allclose(scatter @ vectors, vectors * values, atol=1e-12 * want[0])


def test_small_eigenvalues_keep_their_digits():
    """A graded matrix: eleven orders of magnitude beside each other."""
    scale = 10.0 ** (-0.8 * np.arange(8))
    core = np.full((8, 8), 0.3) + 0.7 * np.eye(8)
    values, _ = whitening.eigen(core * np.outer(scale, scale))
    from fractions import Fraction

    exact = [[Fraction(float(v)) for v in row] for row in core * np.outer(scale, scale)]
    determinant = Fraction(1)
    for k in range(8):  # exact elimination
        determinant *= exact[k][k]
        for i in range(k + 1, 8):
            f = exact[i][k] / exact[k][k]
            exact[i] = [a - f * b for a, b in zip(exact[i], exact[k], strict=True)]
    assert math.isclose(math.prod(values), float(determinant), rel_tol=1e-10)


def test_equal_eigenvalues():
    values, vectors = whitening.eigen(np.eye(9) * 4)
    assert np.allclose(values, 4) and np.allclose(vectors.T @ vectors, np.eye(9))


def brute(rows, components=16):
    """{vec_id: (n, deviation)}, covariance, distinct x - mean, from all rows at once."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: tuple(math.floor(64 * c) + 1_000_000 for c in v) for i, v in good}
    distinct = sorted(set(x.values()))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}
    centred = lambda v: np.array([(n * a - s) / n for a, s in zip(v, sums, strict=True)])
    fit = np.array([centred(v) for v in distinct])
    return n, deviation, fit.T @ fit / n, {i: centred(v) for i, v in x.items()}


def vectors(spark, dims=20, count=120):
    rng = random.Random(7)
    scale = [10 ** (1 - d / 8) for d in range(dims)]
    rows = [(i, [rng.gauss(0, s) for s in scale]) for i in range(count)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(60)]  # a third are copies
    rows += [(2000, None), (2001, [None] * dims), (2002, [float("nan")] * dims), (2003, [0.0] * (dims - 1) + [float("inf")]), (2004, [])]
    rows += [(2005, [0.0] * dims), (2006, [-0.0] * dims)]
    return rows, spark.createDataFrame([(*r, 1, "x", "k", "c", 5) for r in rows], VECTORS)


def check(rows, got, dims):
    n, deviation, covariance, centred = brute(rows)
    k = min(16, dims)
    assert len(got) == len(deviation) * k
    values = np.linalg.eigvalsh(covariance)[::-1]
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got)
    for (i, c), r in by.items():
        assert (r["n"], int(r["deviation"])) == (n, deviation[i])
        assert math.isclose(r["explained"], values[c - 1] / covariance.trace(), rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
    whole = np.array([[by[i, c]["whitened"] for c in range(1, k + 1)] for i in deviation])
    _, eigenvectors = np.linalg.eigh(covariance)
    want = np.array([centred[i] for i in deviation]) @ eigenvectors[:, ::-1][:, :k] / np.sqrt(values[:k])
    for c in range(k):
        sign = np.sign(whole[:, c] @ want[:, c])
        assert np.allclose(whole[:, c], sign * want[:, c], atol=1e-8)


def test_query(spark, tmp_path):
    rows, table = vectors(spark)
    table.repartition(7).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.op13_whitening(spark, str(tmp_path))
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(rows, found.collect(), 20)


def test_no_order_of_rows_matters(spark):
    _, table = vectors(spark)
    key = lambda df: sorted(tuple(r) for r in whitening.whiten(df).collect())
    once = settle(table.repartition(3), "a")
    assert key(once) == key(once)


def test_few_dimensions_and_vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.random(), rng.random(), 3.0]) for i in range(30)]  # the third never varies
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-9
    two = spark.createDataFrame([(1, [0.0, 5.0]), (2, [1.0, 5.0]), (3, [1.0, 5.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in whitening.whiten(two).collect())
    assert [(r[0], r[1], r[2], int(r[3])) for r in got] == [(1, 1, 2, 64**2), (2, 1, 2, 64**2), (3, 1, 2, 64**2)]
    assert [abs(round(r[4], 9)) for r in got] == [1, 1, 1]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0]), (2, [1.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.collect() == [] and found.columns[0] == "vec_id"


def test_lengths_and_sizes_are_refused(spark):
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whiten(mixed)
    huge = spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(huge).collect()


def test_large_entries_stay_exact(spark):
    """Entries whose squares no 64-bit integer holds."""
    rows = [(i, [float(i * 2**40), float(i % 3)]) for i in range(9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    n, deviation, _, _ = brute(rows)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(table).collect()}
    assert got == deviation and max(deviation.values()) > 2**63
