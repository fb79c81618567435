"""Whitening against a dense eigensolver, and its factorisation, counts and exact sums on awkward rows."""

import numpy as np
import pytest

from tidewright.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, component string, n int, whitened string"


def test_pivots_count_eigenvalues():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 20):
        for _ in range(20):
            a = draw.standard_normal((n, n))
            a = a + a.T
            if n > 2:
                a[0, 0] = a[1, 1] = 0
            assert whitening.positive_pivots(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert whitening.positive_pivots(np.zeros((3, 3))) == 0
    assert whitening.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


@pytest.mark.parametrize("spectrum", [
    [9, 5, 4, 3, 2, 1, 0.5, 0.2, 0.1, 0.05], [4, 4, 4, 4, 1, 1, 1, 1, 1, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.3, 0.2, 0.1, 0, 0, 0, 0], [1e6, 1, 1e-3, 1e-6, 0, 0, 0, 0, 0, 0], [0] * 10,
])
def test_leading_vectors(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((10, 10)))
    v = q * np.array(spectrum, float) @ q.T
    v = (v + v.T) / 2
    values, vectors = whitening.leading(v, 6)
    assert np.allclose(values, sorted(spectrum, reverse=True)[:6], atol=1e-13 * max(1, max(spectrum)))
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12)
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-12 * max(1, max(spectrum))


def expected(vectors, k=8):
    """Deviations, eigenvalues, shares and whitened rows up to their sign, by numpy in one go."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(int) + 100000
    n, total = len(x), x.sum(0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    y = x - total / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, deviation, e / np.trace(y.T @ y / n), y @ u / np.sqrt(e)


def test_query_equals_dense_solver(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, share, whitened = expected([r["embedding"] for r in rows])
    place = {r["vec_id"]: i for i, r in enumerate(rows)}
    got = queries.op11_whiten(spark, FOLDER).collect()
    assert len(got) == 8 * n and len({(r["vec_id"], r["component"]) for r in got}) == 8 * n
    found = np.zeros_like(whitened)
    for r in got:
        i, c = place[r["vec_id"]], r["component"] - 1
        found[i, c] = r["whitened"]
        assert (r["n"], r["deviation"]) == (n, deviation[i])
        assert abs(r["explained"] / share[c] - 1) < 1e-9 and r["identity_error"] < 1e-9
    sign = np.sign((found * whitened).sum(0))
    assert np.abs(found * sign - whitened).max() < 1e-8


def test_rows_that_take_no_part(spark, rows):
    nan, inf = float("nan"), float("inf")
    data = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [2.0, -1.0]), (3, [-0.25, 0.125]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, []), (9, [1.0, 2.0, 3.0]), (10, [0.0, 4.0])]
    df = spark.createDataFrame([(k, v, "x", 7, None) for k, v in data], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    kept = [(k, v) for k, v in data if k in (1, None, 3, 10)]
    n, deviation, share, whitened = expected([v for _, v in kept], 2)
    assert sorted((r["vec_id"] or 0, r["component"], int(r["deviation"])) for r in got) == sorted((k or 0, c, d) for (k, _), d in zip(kept, deviation, strict=True) for c in (1, 2))
    for c in (0, 1):
        found = sorted((abs(r["whitened"]) for r in got if r["component"] == c + 1))
        assert np.allclose(found, sorted(np.abs(whitened[:, c])), atol=1e-9)
    assert {r["n"] for r in got} == {n}


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], None, None, None) for i in range(5)], SCHEMA)
    got = whitening.whiten(same).collect()
    assert len(got) == 15 and {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in got} == {(None, None, None, 0)}
    one = whitening.whiten(spark.createDataFrame([(i, [float(i % 2), 0.0], None, None, None) for i in range(6)], SCHEMA)).collect()
    assert {r["whitened"] for r in one if r["component"] == 2} == {None}
    assert {round(abs(r["whitened"]), 9) for r in one if r["component"] == 1} == {1.0}
    assert whitening.whiten(same.limit(0)).collect() == []


def test_exact_sums_of_large_entries(spark):
    vectors = [[3.0e15, 1.0], [-3.0e15, 2.0], [1.5e15, -7.25]]
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).where("component = 1").collect()
    x = [[min(int(np.floor(1024 * a)), whitening.LIMIT) if a > 0 else max(int(np.floor(1024 * a)), -whitening.LIMIT) for a in v] for v in vectors]
    total = [sum(c) + 300000 for c in zip(*x)]
    for r in got:
        value = sum((3 * (a + 100000) - s) ** 2 for a, s in zip(x[r["vec_id"]], total))
        assert r["deviation"] == (value if value < 10**38 else None)
