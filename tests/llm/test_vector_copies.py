import numpy as np
import pytest

from parley.llm import vector_copies
from test_duplicates import plain_components


def made(n, dim, seed=1, hub=0):
    """Random directions, some with copies at many cosines around the threshold, a hub of near copies, and odd rows."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        v = rng.normal(size=dim)
        v /= np.linalg.norm(v)
        rows.append(v * rng.choice([1, 0.5, 7]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            other = rng.normal(size=dim)
            other -= other @ v * v
            cosine = rng.choice([0.9, 0.94, 0.9499, 0.9501, 0.96, 0.99, 1.0])
            rows.append(cosine * v + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other))
    centre = rng.normal(size=dim)
    rows += [centre + rng.normal(size=dim) * rng.choice([0.05, 0.2]) for _ in range(hub)]
    out = [[float(np.float32(c)) for c in v] for v in rows]
    out += [out[0], out[0], out[5], [-c for c in out[0]], [2 * c for c in out[7]]]
    return out + [None, [], [0.0] * dim, [None] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [1.0] * (dim + 1), [1.0] * (dim + 1)]


def check(got, vectors, threshold=0.95):
    good = [i for i, v in enumerate(vectors) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    pairs = []
    for dim in {len(vectors[i]) for i in good}:
        ids = [i for i in good if len(vectors[i]) == dim]
        x = np.array([vectors[i] for i in ids], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        pairs += [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1)))]
    want = plain_components(range(len(vectors)), pairs)
    links = np.bincount(np.array(pairs, int).ravel(), minlength=len(vectors)) if pairs else np.zeros(len(vectors))
    assert len(got) == len(vectors)
    for r in got:
        i = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], want[i], want[i] == i), i


@pytest.mark.parametrize("dim, limits", [(64, {}), (5, {"rows_per_list": 1}), (16, {"rows_per_list": 4, "list_rows": 7, "query_rows": 9})])
def test_near_copies(spark, dim, limits):
    vectors = made(250, dim, seed=dim, hub=60)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(vectors)], "vec_id int, embedding array<float>, rep string, n int")
    check(vector_copies.near_copies(df, **limits).collect(), vectors)


def test_other_threshold(spark):
    vectors = made(120, 8, seed=3)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<float>")
    check(vector_copies.near_copies(df, threshold=0.7, rows_per_list=2).collect(), vectors, 0.7)


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert vector_copies.near_copies(spark.createDataFrame([], schema)).count() == 0
    got = vector_copies.near_copies(spark.createDataFrame([(4, None), (None, [])], schema)).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {(4, 0, 4, True), (None, 0, None, True)}
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.01]), (9, [0.0, 1.0]), (None, [-1.0, 0.0])]
    got = vector_copies.near_copies(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r["vec_id"] or -1), r["n_links"], r["component_id"], r["kept"]) for r in got if r["component_id"]) == [
        (-1, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (9, 0, 9, True),
    ]


def test_a_list_of_one_vector(spark):
    """Half of all rows are one vector, and a third lies close around another."""
    rng = np.random.default_rng(2)
    vectors = [[1.0, 2.0, 3.0, 4.0]] * 150 + [[float(c) for c in [4.0, 1.0, 0.0, 2.0] + rng.normal(size=4) * 0.3] for _ in range(100)]
    vectors += [[float(c) for c in rng.normal(size=4)] for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    check(vector_copies.near_copies(df, list_rows=10, query_rows=10).collect(), vectors)


def test_forest():
    rng = np.random.default_rng(3)
    for n in (2, 30, 200):
        a, b = rng.integers(0, n, (2, 3 * n // 2))
        kept = vector_copies.forest(a, b, n)
        assert plain_components(range(n), zip(a.tolist(), b.tolist())) == plain_components(range(n), zip(a[kept].tolist(), b[kept].tolist()))
        parts = len(set(plain_components(range(n), zip(a.tolist(), b.tolist())).values()))
        assert len(kept) == n - parts
