"""Exact spectrum and whitening."""

from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import spectrum as S
from ledgerloom.llm import whitening as T

SCHEMA = "vec_id long, embedding array<float>, label int"


def polynomial(matrix):
    primes = S.primes_for(int(np.trace(matrix)), len(matrix))
    return S.remaindered(primes, [S.characteristic_mod((matrix % p).astype(np.int64), p) for p in primes])


def by_minors(matrix):
    """Coefficients of det(t - matrix) by Faddeev and LeVerrier in fractions."""
    n = len(matrix)
    a = [[Fraction(int(v)) for v in row] for row in matrix]
    m, out = [[Fraction(0)] * n for _ in range(n)], [Fraction(1)]
    for k in range(1, n + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(n)) + (out[-1] if i == j else 0) for j in range(n)] for i in range(n)]
        out.append(-sum(sum(a[i][x] * m[x][i] for x in range(n)) for i in range(n)) / k)
    return [int(v) for v in reversed(out)]


@pytest.mark.parametrize("size", [1, 2, 3, 6, 9])
def test_characteristic_polynomial(size):
    rng = np.random.default_rng(size)
    given = rng.integers(-(10**6), 10**6, (size, size + 1)).astype(object)
    matrix = given @ given.T
    assert polynomial(matrix) == by_minors(matrix)
    zeros = np.zeros((size, size), object)
    zeros[0, 0] = 3  # Hessenberg form with zeros below the diagonal.
    assert polynomial(zeros) == by_minors(zeros)


def test_repeated_and_close_roots():
    matrix = np.diag([5, 5, 5, 2, 0]).astype(object)
    roots, bits = S.largest_roots(polynomial(matrix), 17, 8)
    assert [(round(float(S.root_value(p, bits)), 12), t) for p, t in roots] == [(5.0, 3), (2.0, 1)]
    vectors = S.null_vectors(matrix, roots[0][0], bits, 3)
    assert np.allclose(vectors @ vectors.T, np.eye(3), atol=1e-15) and np.abs(vectors[:, 3:]).max() < 1e-30
    # Eigenvalues 10**30 and 10**30 + 1 are beyond doubles, and their vectors too.
    big = 10**30
    close = np.array([[2 * big + 1, 1], [1, 2 * big + 1]], object)
    roots, bits = S.largest_roots(polynomial(close), 4 * big + 2, 8)
    assert [t for _, t in roots] == [1, 1]
    first = S.null_vectors(close, roots[0][0], bits, 1)[0]
    assert np.allclose(np.abs(first), np.sqrt(0.5), atol=1e-15) and first[0] * first[1] > 0


def brute(vectors, most=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums).astype(object)
    values, found = np.linalg.eigh((centred.T @ centred).astype(np.float64) / n**3)
    values, found = values[::-1][:most], found[:, ::-1][:, :most]
    return (centred * centred).sum(axis=1), (centred / n).astype(np.float64) @ found / np.sqrt(values), values


def check(frame, vectors, ids, most=8):
    rows = frame.toPandas()
    exact, expected, values = brute(vectors, most)
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((got * expected).sum(axis=0))
    assert np.allclose(got * sign, expected, atol=1e-8)
    deviation = rows[rows.component == 1].set_index("vec_id").deviation.loc[ids]
    assert deviation.tolist() == exact.tolist()
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] <= 1e-10
    assert (rows.n == len(vectors)).all()
    assert np.allclose(rows.groupby("component").explained.first()[:3] / rows.explained.max(), values[:3] / values[0], rtol=1e-9)


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(500, 12)) * np.linspace(1, 3, 12)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    check(T.op12_whitening(spark.createDataFrame(rows, SCHEMA).repartition(5)), vectors, range(500))


def test_left_out_and_few_dimensions(spark):
    good = [[0.5, 1.0], [0.25, -1.0], [0.5, 0.0], [-3.0, 2.0]]
    bad = [None, [None, 1.0], [float("nan"), 1.0], [1.0, float("inf")], [1.0], [], [1.0, 2.0, 3.0]]
    rows = [(i, v, 0) for i, v in enumerate(good + bad)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("label", "component")
    check(T.op12_whitening(frame), good, range(4), 2)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 0)], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)]):
        assert T.op12_whitening(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_repeated_rows_and_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [0.0, 1.0], 0), (2, [0.0, 2.0], 0)]
    got = T.op12_whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 8 and {r.n for r in got} == {4}


def test_entries_beyond_exact_doubles(spark):
    """Large entries take the limb products and decimals beyond 64 bits."""
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(40, 3)) * 1e9).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    got = T.op12_whitening(spark.createDataFrame(rows, SCHEMA)).toPandas()
    exact, expected, _ = brute(vectors)
    first = got[got.component == 1].set_index("vec_id")
    assert [int(v) for v in first.deviation_exact.loc[range(40)]] == exact.tolist()
    assert first.deviation.isna().all()
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(np.abs(w), np.abs(expected), atol=1e-8)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    given = table.select("vec_id", "embedding").collect()
    check(T.op12_whitening(table), [r.embedding for r in given], [r.vec_id for r in given])
