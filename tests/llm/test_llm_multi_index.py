import numpy as np
from pyspark.sql import functions as F

from eventsieve.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, score double, i int"


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], 0, 0.0, 0) for k, v in rows], SCHEMA)


def brute(x, q, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u[q]
    s[q] = -np.inf
    return list(np.lexsort((np.arange(len(x)), -np.round(s, 12)))[:k]), s


def test_recall_ties_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 32)).astype(np.float32).astype(float)
    x[500:1500] = x[0]  # a third of all rows is one vector
    x[1500:1700] = x[1500:1501] + rng.normal(size=(200, 32)) * 0.05
    x = x.astype(np.float32).astype(float)
    out = multi_index.search(frame(spark, enumerate(x)), F.col("vec_id") % 50 == 0).collect()
    hits = total = 0
    for q in range(0, 3000, 50):
        mine = sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        want, s = brute(x, q)
        hits += len(set(want) & {r["vec_id"] for r in mine})
        total += 5
        assert all(abs(r["score"] - s[r["vec_id"]]) < 1e-12 for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
    assert hits / total >= 0.95
    assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == 0] == [500, 501, 502, 503, 504]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0, 0, 0]), (1, [1, 1, 0, 0]), (2, None), (3, [0, 0, 0, 0]), (4, [1, None, 0, 0]), (5, [nan, 1, 0, 0]), (6, [inf, 0, 0, 0]),
            (7, [1, 2]), (None, [1, 0, 0, 0]), (50, [2, 0, 0, 0]), (50, [2, 0, 0, 0]), (100, [0, 0, 0, 0]), (8, [-1, 0, 0, 0])]
    out = multi_index.search(frame(spark, rows), F.col("vec_id") % 50 == 0)
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in out.orderBy("query_id", "rank").collect()]
    half = round(0.5**0.5, 9)
    assert got == [(0, 1, 50, 1.0), (0, 2, 50, 1.0), (0, 3, 1, half), (0, 4, 8, -1.0), (50, 1, 0, 1.0), (50, 2, 1, half), (50, 3, 8, -1.0)]
    assert multi_index.search(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_heap_walk_passes_pairs_in_order():
    rng = np.random.default_rng(1)
    a, b, size = rng.random(7), rng.random(5), rng.integers(0, 4, (7, 5))
    sums = np.sort((a[:, None] + b).ravel())
    order = np.argsort((a[:, None] + b).ravel(), kind="stable")
    for enough in (1, 10, size.sum()):
        assert multi_index.walk(a, b, size, enough) == sums[np.searchsorted(np.cumsum(size.ravel()[order]), enough)]
    assert multi_index.walk(a, b, size, size.sum() + 1) == float("inf")
