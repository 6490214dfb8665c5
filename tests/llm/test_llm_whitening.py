"""Whitening against numpy's dense eigenvectors."""

import numpy as np

from eventsieve.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x int"


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if c is None else float(c) for c in v], 0, 0, 0) for k, v in rows], SCHEMA)


def dense(vectors):
    """n, S, eigenvalues and vectors of the distinct whole vectors."""
    x = np.unique(np.floor(np.asarray(vectors, np.float32).astype(float) * 256).astype(np.int64), axis=0)
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    return x, values[::-1], turn[:, ::-1]


def check(rows, vectors, k):
    x, values, turn = dense([v for _, v in vectors])
    n, sums = len(x), x.sum(axis=0)
    by = {}
    for r in rows:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    sign = {}
    for key in {v for v, _ in vectors}:
        own = [np.floor(np.asarray(v, np.float32).astype(float) * 256).astype(np.int64) for i, v in vectors if i == key]
        for c in range(1, k + 1):
            got = sorted((r["deviation"], r["whitened"]) for r in by[key, c])
            assert [d for d, _ in got] == sorted(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, sums)) for v in own)
            for v in own:
                want = (v - sums / n) @ turn[:, c - 1] / np.sqrt(values[c - 1])
                near = min((r["whitened"] for r in by[key, c]), key=lambda g: min(abs(g - want), abs(g + want)))
                assert min(abs(near - want), abs(near + want)) < 1e-9 * max(1, abs(want))
                if abs(want) > 1e-6:
                    assert sign.setdefault(c, np.sign(near * want)) == np.sign(near * want)
    for r in rows:
        assert r["n"] == n and abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-10 and r["identity_error"] < 1e-9


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(900, 24)) * np.linspace(1, 2, 24)) @ rng.normal(size=(24, 24)) / 5
    v[300:600] = v[0]  # a third of all rows is one vector
    vectors = list(enumerate(v.astype(np.float32).tolist()))
    rows = whitening.whiten(frame(spark, vectors).repartition(5)).collect()
    assert len(rows) == 4 * 900
    check(rows, vectors, 4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1, 2, 0]), (1, [-0.001, 1, 5]), (1, [-0.001, 1, 5]), (None, [3, -1, 2]), (7, [0.5, 0.25, 8]), (8, [-0.0, 0.0, -2])]
    bad = [(2, None), (3, []), (4, [1, None, 2]), (5, [nan, 1, 1]), (6, [inf, 1, 1]), (9, [1, 2]), (10, [1e30, 0, 0])]
    rows = whitening.whiten(frame(spark, good + bad)).collect()
    assert len(rows) == 3 * len(good) and {r["component"] for r in rows} == {1, 2, 3}
    check(rows, good, 3)


def test_no_variance_and_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1, 2]), (2, [1, 2])])).collect() == []
    line = [(i, [i, 2 * i, 0]) for i in range(9)]
    rows = whitening.whiten(frame(spark, line)).collect()
    assert {r["component"] for r in rows} == {1}  # the others have no variance
    check(rows, line, 1)


def test_large_values_stay_exact():
    x, n = np.array([[2**39, 5], [-3, 7]]), 10**6
    sums = np.array([11, -13])
    want = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums)) for row in x]
    assert whitening.deviations(x, n, sums) == [None, want[1]] and want[0] >= 2**63


def test_jacobi_davidson_reaches_double_precision():
    rng = np.random.default_rng(1)
    for dim, wanted, spread in ((1, 4, 1), (2, 1, 1), (30, 4, 0.01), (150, 4, 1), (150, 6, 30)):
        q = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        values = np.sort(1 + spread * rng.random(dim))[::-1]
        v = (q * values) @ q.T
        got, vectors, residuals = whitening.jacobi_davidson(lambda w: v @ w, dim, wanted)
        k = min(dim, wanted)
        assert np.abs(got - values[:k]).max() < 1e-13 * values[0]
        assert np.linalg.norm(v @ vectors - vectors * got, axis=0).max() < 1e-12 * values[0]
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    shifts, b = np.array([0.3, -2.0, 5.0]), rng.normal(size=(20, 3))
    x = whitening.minres(lambda t: a @ t - t * shifts, b, 60)
    assert np.abs(a @ x - x * shifts - b).max() < 1e-7
