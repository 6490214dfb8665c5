"""Approximate nearest neighbours by cosine with an inverted multi-index.

Vectors are scaled to length one and cut in halves; each half has its own codebook (k-means on a
bounded sample of all rows), so a cell is a pair of centroids. A query walks the pairs by summed
distance with a heap until the cells passed hold a share of all rows; the distance reached is its
radius. Cells are stored by their first centroid, dealt to blocks of about ``BLOCK`` rows; a query
goes to the blocks of the first centroids within its radius, and only cells within it are searched.
What is found is reranked by the exact cosine in double precision.

The share is calibrated: on the sample, how many rows must be passed to meet a share of
``RECALL`` of the true neighbours. Tight data need few cells, data without structure many. Every
row is indexed; a very full cell only makes more blocks.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id; a query that is repeated under one id
counts once (its least vector) and rows of its own id are no candidates; ties go to the smaller id;
fewer candidates than asked for are all returned; an empty table gives an empty result. Other
columns are left alone.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

CENTROIDS, SAMPLE, RECALL, BLOCK, NEAREST = 64, 8192, 0.98, 8192, 5
CLOSE = 1e-9


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2) if len(x) * centroids.size < 1 << 22 else np.vstack(
        [distances(p, centroids) for p in np.array_split(x, len(x) * centroids.size // (1 << 21) + 1)])


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = distances(x, c).argmin(axis=1)
        count = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
    return c


def walk(first: np.ndarray, second: np.ndarray, size: np.ndarray, enough: float) -> float:
    """Radius of a query: summed distance of the centroid pair at which the cells passed hold
    ``enough`` rows. Pairs come off a heap in order of their sum."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, held, radius = [(first[a[0]] + second[b[0]], 0, 0)], 0, 0.0
    while heap:
        radius, i, j = heapq.heappop(heap)
        held += size[a[i], b[j]]
        if held >= enough:
            return radius
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return float("inf")


@dataclass
class Codebook:
    dims: int
    first: np.ndarray
    second: np.ndarray
    share: float

    def halves(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.dims // 2
        return distances(u[:, :h], self.first), distances(u[:, h:], self.second)


def fit(rows: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, recall: float = RECALL,
        nearest: int = NEAREST, seed: int = 11) -> Codebook | None:
    """Codebooks and the calibrated share, from the ``sample`` rows of least hash."""
    n = rows.count()
    h = F.xxhash64(F.lit(seed), "vec_id", "embedding")
    few = rows.select(h.alias("_h"), "vec_id", "embedding")
    if n > 4 * sample:  # only cheapens the order
        few = few.filter(F.col("_h") < int(-(2**63) + 2**64 * 2 * sample / n))
    got = [r["embedding"] for r in few.orderBy("_h", "vec_id").limit(sample).collect()]
    if not got:
        return None
    dims = Counter(map(len, got)).most_common(1)[0][0]
    x = unit(np.array([v for v in got if len(v) == dims], float))
    rng = np.random.default_rng(seed)
    book = Codebook(dims, kmeans(x[:, : dims // 2], centroids, rng), kmeans(x[:, dims // 2 :], centroids, rng), 1.0)
    first, second = book.halves(x)
    i, j = first.argmin(axis=1), second.argmin(axis=1)
    size = np.zeros((len(book.first), len(book.second)), np.int64)
    np.add.at(size, (i, j), 1)
    need = []
    for q in range(min(len(x), 256)):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.argsort(-s, kind="stable")[: min(nearest, len(x) - 1)]
        summed = first[q][:, None] + second[q][None, :]
        order = np.argsort(summed, axis=None)
        passed = np.empty(summed.size)
        passed[order] = np.cumsum(size.ravel()[order])
        need += list(passed.reshape(summed.shape)[i[best], j[best]] / len(x))
    book.share = float(np.quantile(need, recall)) if need else 1.0
    return book


def index(rows: DataFrame, book: Codebook) -> DataFrame:
    """(vec_id, vector, i, j): every row with its cell."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                first, second = book.halves(unit(np.array(list(b["embedding"]), float)))
                yield pd.DataFrame({"vec_id": b["vec_id"], "vector": b["embedding"],
                                    "i": first.argmin(axis=1), "j": second.argmin(axis=1)})

    rows = rows.filter(F.size("embedding") == book.dims).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInPandas(run, "vec_id long, vector array<double>, i int, j int")


def _routes(book: Codebook, size: np.ndarray, enough: float):
    """Queries to (query, first centroid) for every first centroid within the radius."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            first, second = book.halves(unit(np.array(list(b["vector"]), float)))
            radius = np.array([walk(f, s, size, enough) for f, s in zip(first, second)])
            q, i = np.nonzero(first + second.min(axis=1)[:, None] <= radius[:, None] + CLOSE)
            yield pd.DataFrame({"vec_id": b["vec_id"].to_numpy()[q], "vector": b["vector"].to_numpy()[q], "i": i, "radius": radius[q]})

    return run


def _search(book: Codebook, nearest: int):
    """Streams of a block's rows followed by its queries to each query's nearest in the block."""
    def nearest_of(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        x, q = np.array(list(rows["vector"]), float), np.array(list(queries["vector"]), float)
        ux, uq = unit(x), unit(q)
        ids, own, j = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy(), rows["j"].to_numpy()
        first, second = book.halves(uq)
        reach = first[:, rows["i"].iloc[0], None] + second <= queries["radius"].to_numpy()[:, None] + CLOSE
        s = np.full((len(q), len(x)), -np.inf)
        order = np.argsort(j, kind="stable")
        cuts = np.flatnonzero(np.diff(j[order], prepend=-1, append=1 << 30))
        for a, b in zip(cuts, cuts[1:]):
            asks = np.flatnonzero(reach[:, j[order[a]]])
            if len(asks):
                s[np.ix_(asks, order[a:b])] = uq[asks] @ ux[order[a:b]].T
        s[own[:, None] == ids[None, :]] = -np.inf
        k = min(nearest, len(x))
        least = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        out = []
        for n in range(len(q)):
            some = np.flatnonzero((s[n] >= least[n] - CLOSE) & (s[n] > -np.inf))
            # rerank on the original vectors; equal vectors get equal scores, whatever their place
            c = np.array([_cosine(q[n], x[m]) for m in some])
            for m in np.lexsort((ids[some], -c))[:k]:
                out.append((own[n], ids[some[m]], c[m]))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, rows = None, [], None
        for batch in batches:
            for key, part in batch.groupby(["i", "sub"], sort=False):
                if key != at:
                    at, held, rows = key, [], None
                new, asked = part[part["radius"].isna()], part[part["radius"].notna()]
                if len(new):
                    held.append(new)
                if len(asked) and held:
                    rows = pd.concat(held) if rows is None else rows
                    for a in range(0, len(asked), 512):
                        yield nearest_of(rows, asked.iloc[a : a + 512])

    return run


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    big = max(np.abs(a).max(), np.abs(b).max())
    if not 1e-100 < big < 1e100 or min(np.abs(a).max(), np.abs(b).max()) < 1e-100:
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


RESULT = "query_id long, rank int, vec_id long, score double"


def search(embeddings: DataFrame, is_query: Column, nearest: int = NEAREST, centroids: int = CENTROIDS,
           sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows found for every row where ``is_query`` holds."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    book = fit(rows, centroids, sample, recall, nearest)
    if book is None:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    cells = staged(index(rows, book), "vector-cells")
    size = np.zeros((len(book.first), len(book.second)), np.int64)
    for r in cells.groupBy("i", "j").count().collect():  # one row per cell, at most centroids ** 2
        size[r["i"], r["j"]] = r["count"]
    blocks = np.maximum(1, -(-size.sum(axis=1) // BLOCK))
    enough = max(book.share * size.sum(), nearest + 1)

    subs = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("i") + 1)
    stored = cells.withColumn("sub", F.pmod(F.xxhash64("vec_id", "vector"), subs).cast("int"))
    stored = stored.select("i", "sub", F.lit(None).cast("double").alias("radius"), "vec_id", "vector", "j")
    queries = cells.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = queries.mapInPandas(_routes(book, size, enough), "vec_id long, vector array<double>, i int, radius double")
    asked = asked.withColumn("sub", F.explode(F.sequence(F.lit(0), subs - 1)))
    asked = asked.select("i", "sub", "radius", "vec_id", "vector", F.lit(-1).alias("j"))
    both = stored.union(asked).repartition("i", "sub").sortWithinPartitions("i", "sub", F.col("radius").isNotNull())
    found = both.mapInPandas(_search(book, nearest), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return found.select("query_id", "rank", "vec_id", "score")
