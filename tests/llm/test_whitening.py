import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import whitening
from parley.llm.queries import QUERIES


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 30):
        for _ in range(40):
            a = rng.normal(size=(n, n)) * (rng.random((n, n)) < 0.7)
            a = a + a.T
            shift = rng.normal()
            values = np.linalg.eigvalsh(a)
            if np.abs(values - shift).min() > 1e-9:
                assert whitening.count_above(a, shift) == (values > shift).sum()
    # zero diagonals need blocks of two
    assert whitening.negative_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, False)
    assert whitening.negative_pivots(np.zeros((3, 3))) == (0, True)


@pytest.mark.parametrize("kind", ["plain", "equal", "close", "low rank", "diagonal", "one"])
def test_leading_eigenpairs(kind):
    rng = np.random.default_rng(5)
    n = 1 if kind == "one" else 40
    basis = np.linalg.qr(rng.normal(size=(n, n)))[0]
    values = np.sort(rng.random(n) * 9 + 1)[::-1]
    if kind == "equal":
        values[:12] = [20, 20, 20, 15, 15, 12, 12, 12, 12, 11.5, 11, 11]
    if kind == "close":
        values[:6] = 20 + np.array([5e-9, 4e-9, 3e-9, 1e-12, 5e-13, 0])
    if kind == "low rank":
        values[5:] = 0
    if kind == "diagonal":
        basis = np.eye(n)
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading_eigenpairs(matrix, 16)
    want = values[:16] if kind != "low rank" else values[:5]
    assert np.allclose(got, want[:n], rtol=1e-13, atol=1e-12 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-12 * values[0]
    assert len(whitening.leading_eigenpairs(np.zeros((4, 4)), 3)[0]) == 0


def plain_whitening(vectors, most=16):
    """By Fractions up to the covariance, then numpy's eigenvectors."""
    good = {i: v for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v) and len(v)}
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in good.items()}
    fit = sorted({tuple(v) for v in x.values()})
    n, dim = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(dim)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in fit])
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    return n, deviation, values[::-1][:most], basis[:, ::-1][:, :most], {i: np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums)]) for i, v in x.items()}, np.trace(cov)


def test_whiten(spark):
    rng = np.random.default_rng(9)
    vectors = {i: [float(np.float32(c)) for c in rng.normal(size=6) * [9, 7, 5, 3, 2, 1]] for i in range(60)}
    vectors |= {100: vectors[3], 101: vectors[3], 102: None, 103: [1.0, None, 0.0, 0.0, 0.0, 0.0], 104: [float("nan")] * 6, 105: [float("inf")] + [0.0] * 5, 106: [], 107: [1.0, 2.0]}
    rows = [(i, v, "label", 7) for i, v in vectors.items()] + [(3, vectors[3], "again", 8), (None, vectors[5], None, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, x int")
    want_n, deviation, values, basis, centred, trace = plain_whitening({i: v for i, v in vectors.items() if i not in (106, 107)})
    got = whitening.whiten(df).collect()
    assert len(got) == 64 and sum(r["vec_id"] is None for r in got) == 1
    for r in got:
        i = 5 if r["vec_id"] is None else r["vec_id"]
        assert r["n"] == want_n == 60 and r["deviation"] == deviation[i]
        assert np.allclose(r["explained"], values / trace, rtol=1e-9) and r["identity_error"] < 1e-9
        signs = np.sign((np.array(r["whitened"]) * (centred[i] @ basis / np.sqrt(values))))
        assert np.allclose(np.abs(r["whitened"]), np.abs(centred[i] @ basis / np.sqrt(values)), atol=1e-8)
        assert set(signs) <= {-1, 0, 1}
    # one sign for all rows
    white = np.array([r["whitened"] for r in got])
    plain = np.array([centred[5 if r["vec_id"] is None else r["vec_id"]] @ basis / np.sqrt(values) for r in got])
    assert np.allclose(white, plain * np.sign((white * plain).sum(axis=0)), atol=1e-8)


def test_whiten_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in one] == [(1, 0, [])] * 2
    # a flat dimension leaves fewer components; entries beyond 64-bit products stay exact
    flat = [(i, [float(i % 3), 5.0, float(i * i)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(flat, schema)).collect()
    assert all(len(r["whitened"]) == 2 and r["identity_error"] < 1e-9 for r in got)
    large = {i: [float(i) * 2**40, float(-i) ** 3] for i in range(9)}
    got = whitening.whiten(spark.createDataFrame(list(large.items()), "vec_id long, embedding array<double>")).collect()
    _, deviation, *_ = plain_whitening(large)
    assert {r["vec_id"]: r["deviation"] for r in got} == deviation


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = QUERIES["op12_whitening"](spark, sf)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert found.count() == 16 * rows == found.filter("identity_error < 1e-4 AND deviation > 0").count()
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
    }
    assert found.agg(F.max("component")).first()[0] == 16
