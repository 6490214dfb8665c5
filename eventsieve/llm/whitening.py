"""Embedding whitening: leading eigenvectors of a covariance by a Jacobi-Davidson method.

The entries of a vector are made whole numbers x = floor(256 * c). The covariance V is that of the
fit list, the distinct x vectors, and is never formed: a product V W is one Spark job in which every
partition centres its rows, multiplies them and their transpose with the few columns of W, and sends
one small sum. The method keeps a subspace of a few directions on the driver:

* Rayleigh-Ritz: the eigenpairs of V projected to the subspace are the approximations; those whose
  residual |V u - e u| has reached double precision are locked and never left again;
* correction: for each of the others, MINRES solves (I - Q Q')(V - e I)(I - Q Q') t = -r, where Q
  holds the locked vectors and the approximation itself. The equations of all open approximations
  run in step, so one job serves an iteration of each of them;
* the corrections join the subspace; when it is full it starts anew from its best approximations.

Defined results: vectors that are null, empty or hold null, non-finite or larger entries than 2**31
take no part, nor do vectors whose length isn't the commonest one (of equally common lengths the
least); repeated rows each get their results and count once in the fit list; components without
variance are left out, equal eigenvalues may give any basis of their space; a deviation that a long
can't hold is null; an empty table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

COMPONENTS, SCALE, LARGEST = 4, 256, 2**31
#: Rows of x in one written block of the fit list.
BLOCK_ROWS = 4096
#: A residual of so many units in the last place of the largest eigenvalue counts as double precision.
RESIDUAL_ULPS = 64
INNER_STEPS, OUTER_STEPS = 6, 60
#: Approximations behind the wanted ones that are corrected too (a product takes all columns at once), and
#: directions of a full subspace for each wanted one.
SPARE, FULL = 8, 16

Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Whitening:
    """n, sums S of the fit list, eigenvalues (falling) and unit eigenvectors (columns)."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x (array<long>) of the rows that take part."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall("_c", lambda v: F.coalesce(F.abs(v) <= LARGEST, F.lit(False)) & ~F.isnan(v))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("_c")).filter(F.col("_c").isNotNull() & (F.size("_c") > 0) & fine)
    common = rows.groupBy(F.size("_c").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = common[0]["dim"] if common else 0
    x = F.transform("_c", lambda v: F.floor(v * SCALE).cast("long"))
    return rows.filter(F.size("_c") == dim).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one length without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_blocks(rows: DataFrame) -> DataFrame:
    """The distinct x vectors as written blocks of int64 matrices (dim, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column("x").slice(a, BLOCK_ROWS)).astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["dim", "x"])

    return staged(rows.select("x").distinct().mapInArrow(run, "dim int, x binary"), "fit-blocks")


def _summed(blocks: DataFrame, each: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum of ``each(x)`` over all blocks: a partition adds its own, Spark adds the partitions'."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for dim, x in zip(batch["dim"], batch["x"]):
                got = each(np.frombuffer(x, "<i8").reshape(-1, dim)).ravel()
                total = got if total is None else total + got
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

    parts = blocks.mapInPandas(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v"))
    return np.array([r["v"] for r in sorted(parts.collect())])  # as many as the sum has entries


def minres(apply: Product, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of one symmetric (indefinite) system per column, all in step.

    ``apply`` multiplies every column with its own system. Lanczos vectors v with a QR factorisation
    of the tridiagonal matrix by Givens rotations (c, s); a column whose Krylov space is exhausted stops."""
    x = np.zeros_like(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    tiny = np.maximum(beta, 1e-300) * 1e-14
    alive = beta > 0
    v_old, v = np.zeros_like(rhs), np.divide(rhs, beta, out=np.zeros_like(rhs), where=alive)
    d_old, d_older = np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_old = np.ones(rhs.shape[1])
    s = s_old = np.zeros(rhs.shape[1])
    rest, beta = beta.copy(), np.zeros(rhs.shape[1])
    for _ in range(steps):
        if not alive.any():
            break
        w = apply(v) - beta * v_old
        alpha = (v * w).sum(axis=0)
        w -= alpha * v
        after = np.linalg.norm(w, axis=0)
        # the new column (beta, alpha, after) of the tridiagonal matrix, turned by the last two rotations
        upper2, mid = s_old * beta, c_old * beta
        upper1, diagonal = c * mid + s * alpha, c * alpha - s * mid
        length = np.hypot(diagonal, after)
        alive &= length > tiny
        safe = np.where(alive, length, 1.0)
        c_old, s_old, c, s = c, s, np.where(alive, diagonal / safe, 1.0), np.where(alive, after / safe, 0.0)
        d = (v - upper1 * d_old - upper2 * d_older) / safe
        x = np.where(alive, x + c * rest * d, x)
        rest = np.where(alive, -s * rest, rest)
        alive &= (after > tiny) & (np.abs(rest) > tiny)
        d_older, d_old = d_old, d
        v_old, v, beta = v, np.divide(w, after, out=np.zeros_like(w), where=alive), after
    return x


def _joined(basis: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The directions of ``more`` that are new to the orthonormal ``basis``, orthonormal."""
    new = []
    for column in more.T:
        norm = np.linalg.norm(column)
        if not norm > 0:
            continue
        column = column / norm
        for _ in range(3):
            for q in (basis, np.array(new).T if new else basis[:, :0]):
                column = column - q @ (q.T @ column)
            norm = np.linalg.norm(column)
            if norm < 1e-10:
                break
            column = column / norm
        else:
            new.append(column)
    return np.array(new).T.reshape(len(basis), -1)


def jacobi_davidson(product: Product, dim: int, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling), their unit vectors and residual norms of the
    symmetric positive semidefinite ``product``. Raises if they don't reach double precision."""
    wanted = min(wanted, dim)
    keep, full = min(dim, wanted + 2 * SPARE), min(dim, FULL * wanted)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, keep)))[0]
    image = product(basis)
    best = np.inf
    for _ in range(OUTER_STEPS):
        values, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        turn = turn[:, ::-1]
        near = min(basis.shape[1], wanted + SPARE)
        values, vectors, images = values[::-1][:near], basis @ turn, image @ turn
        residual = images[:, :near] - values * vectors[:, :near]
        norms = np.linalg.norm(residual[:, :wanted], axis=0)
        limit = RESIDUAL_ULPS * np.finfo(float).eps * max(abs(values[0]), np.finfo(float).tiny)
        # locked from the largest on: an approximation counts only if all larger ones do
        locked = int(np.argmin(np.append(norms <= limit, False)))
        if locked == wanted or basis.shape[1] == dim and norms.max() >= best:
            break
        best = min(best, norms.max())
        if basis.shape[1] + near - locked > full and basis.shape[1] > keep:
            basis, image = vectors[:, :keep], images[:, :keep]
        open_values, q = values[locked:], [np.column_stack([vectors[:, :locked], vectors[:, j]]) for j in range(locked, near)]

        def off(t: np.ndarray) -> np.ndarray:
            return np.column_stack([c - p @ (p.T @ c) for p, c in zip(q, t.T)])

        correction = minres(lambda t: off(product(t) - open_values * t), off(-residual[:, locked:]), INNER_STEPS)
        fresh = _joined(basis, off(correction))
        if fresh.shape[1] == 0:  # no new direction: leave the space by a random one
            fresh = _joined(basis, np.random.default_rng(seed + basis.shape[1]).normal(size=(dim, 1)))
        if fresh.shape[1] == 0:
            break
        basis, image = np.column_stack([basis, fresh]), np.column_stack([image, product(fresh)])
    if norms.max() > 64 * limit:
        raise ArithmeticError(f"residuals {norms} above {limit}")
    vectors = vectors[:, :wanted] / np.linalg.norm(vectors[:, :wanted], axis=0)
    return values[:wanted], vectors, norms


def fit(blocks: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fit list; ``None`` if it is empty."""
    def count_and_sums(x: np.ndarray) -> np.ndarray:
        return np.append(x.sum(axis=0), len(x))

    *sums, n = _summed(blocks, count_and_sums, "long") if not blocks.isEmpty() else [0]
    if not n:
        return None
    sums = np.array(sums, np.int64)
    mean, dim = sums / n, len(sums)
    trace = float(_summed(blocks, lambda x: np.array([((x - mean) ** 2).sum()]), "double")[0]) / n

    def product(w: np.ndarray) -> np.ndarray:
        def each(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ w)

        return _summed(blocks, each, "double").reshape(w.shape) / n

    if not trace > 0:
        return Whitening(int(n), sums, np.zeros(0), np.zeros((dim, 0)), trace, np.zeros(0))
    values, vectors, residuals = jacobi_davidson(product, dim, components)
    some = values > trace * 1e-12
    return Whitening(int(n), sums, values[some], vectors[:, some], trace, residuals[some])


def identity_error(blocks: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, mean, turn = len(w.values), w.mean, w.vectors / np.sqrt(w.values)

    def each(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ turn
        return np.append((z.T @ z).ravel(), z.sum(axis=0))

    total = _summed(blocks, each, "double") / w.n
    centre = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(centre, centre) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n * x - S) ** 2 of every row, exact; ``None`` beyond a long."""
    largest = (np.abs(n * x.astype(float)) + np.abs(sums.astype(float))).max(initial=0.0)
    if largest**2 * x.shape[1] < 2**62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(row, sums.tolist())) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    rows = staged(whole_vectors(embeddings), "whole-vectors")
    blocks = fit_blocks(rows)
    w = fit(blocks, components)
    if w is None or not len(w.values):
        return rows.sparkSession.createDataFrame([], OUT)
    error, k, turn = identity_error(blocks, w), len(w.values), w.vectors / np.sqrt(w.values)
    explained = w.values / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(m), k)  # a vector's components follow each other
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                 pa.array(deviations(x, w.n, w.sums), pa.int64()).take(pa.array(each)), pa.array(((x - w.mean) @ turn).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, OUT)
