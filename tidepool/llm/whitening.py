"""Embedding whitening (operator 11).

The components of the covariance come from spectral divide and conquer: the polar
factor of ``A - s I`` (QDWH iteration) has eigenvalues 1 and -1, so ``(U + I) / 2``
projects on the eigenvectors of ``A`` above ``s``; a basis of either side splits ``A``
in two, and both go on until one dimension is left.  The matrix is ``d x d`` for
vectors of ``d`` entries, so this part runs on the driver; the corpus is only passed by
tasks, which hand over sums, and the components go back to them with the task.

Entries become ``x = floor(256 c)``.  The fit list holds each distinct x vector once
(equal vectors are reduced before the shuffle, so a frequent one weighs nothing).  Its
sums are exact; its covariance is taken from centred entries, divisor n.

Rows whose vector is null or holds null or non-finite entries, or one whose x is no
64-bit number, take no part, nor do rows of another length than the most frequent one
(ties: the longer) and empty vectors.  Null ids are kept, repeated rows give repeated
rows; other columns are not read.  A component of no variance (its eigenvalue is 0 up
to rounding) whitens to null and is left out of the identity error; ``explained`` is
null where nothing varies.  ``deviation`` beyond 64 bits is null.  Fewer than ``k``
dimensions give fewer components; empty tables give empty results.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import scratch, stored

_EPS = float(np.finfo(float).eps)
#: Vectors that a task takes at once.
ROWS = 4096


# -- spectral divide and conquer, on a d x d matrix ---------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QR-based dynamically
    weighted Halley iterations."""
    d = len(a)
    x = a / np.linalg.norm(a)
    # A lower bound of the smallest singular value; one too small costs an iteration.
    low = max(1.0 / (np.linalg.norm(np.linalg.pinv(x)) or 1.0), _EPS)
    for _ in range(60):
        t = np.cbrt(4 * (1 - low**2) / low**4) if low < 1 else 0.0
        wide = np.sqrt(1 + t)
        w_a = wide + 0.5 * np.sqrt(8 - 4 * t + 8 * (2 - low**2) / (low**2 * wide))
        w_b = (w_a - 1) ** 2 / 4
        w_c = w_a + w_b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(w_c) * x, np.eye(d)]))
        new = w_b / w_c * x + (w_a - w_b / w_c) / np.sqrt(w_c) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (w_a + w_b * low**2) / (1 + w_c * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if moved <= np.cbrt(_EPS) and low > 1 - 1e-6:
            return x
    return x


def _basis(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of the rest: its most independent
    columns first, then one step of subspace iteration."""
    d = len(projector)
    rest, chosen = projector.copy(), []
    for _ in range(rank):
        j = int(np.argmax((rest**2).sum(axis=0)))
        chosen.append(j)
        v = rest[:, j] / np.linalg.norm(rest[:, j])
        rest -= np.outer(v, v @ rest)
    q, _ = np.linalg.qr(projector @ np.linalg.qr(projector[:, chosen])[0])
    whole, _ = np.linalg.qr(np.hstack([q, np.eye(d) - q @ q.T]))
    return q, whole[:, rank:d]


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of ``a``, greater eigenvalues first; None where
    ``a`` is a multiple of the identity up to rounding."""
    d = len(a)
    spread = np.linalg.norm(a - np.trace(a) / d * np.eye(d))
    if spread <= 4 * d * _EPS * np.linalg.norm(a):
        return None
    for shift in (np.median(np.diag(a)), np.trace(a) / d, *(np.trace(a) / d + spread / np.sqrt(d) * f for f in (0.25, -0.25, 0.5, -0.5, 0.1, -0.1))):
        shifted = a - shift * np.eye(d)
        if np.linalg.norm(shifted) == 0:
            continue
        projector = (polar(shifted) + np.eye(d)) / 2
        rank = int(round(float(np.trace(projector))))
        if 0 < rank < d:
            high, low = _basis(projector, rank)
            # A shift too near an eigenvalue leaves the sides coupled: take another one.
            if np.linalg.norm(high.T @ a @ low) <= 1e3 * d * _EPS * np.linalg.norm(a):
                return high, low
    values, vectors = np.linalg.eigh(a)
    return vectors[:, d // 2 :], vectors[:, : d // 2]


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns."""
    a = (a + a.T) / 2
    d = len(a)
    halves = _split(a) if d > 1 else None
    if halves is None:
        return np.diag(a).copy(), np.eye(d)
    found = [(q, *components(q.T @ a @ q)) for q in halves]
    vectors = np.hstack([q @ v for q, _, v in found])
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# -- passes over the vectors ---------------------------------------------------


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)`` of the rows that take part, ``x`` as 64-bit numbers."""
    wide = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    scaled = F.transform("v", lambda c: c * 256.0)
    good = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (c >= -(2.0**63)) & (c < 2.0**63))
    kept = wide.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(good)
    return kept.select("id", F.transform("v", lambda c: F.floor(c * 256.0)).alias("x"))


def _matrices(batches, d: int):
    """The x vectors of a task as integer matrices of bounded height."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = part.column(part.num_columns - 1)
            yield part, x.flatten().to_numpy().reshape(len(x), d)


def _exact_sums(fit: DataFrame, d: int) -> list[int]:
    def run(batches):
        total = [0] * d
        for _, x in _matrices(batches, d):
            # Halves of 32 bits cannot overflow within a batch.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, high, low)]
        yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "s"])

    rows = fit.select("x").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    return [int(r["s"]) for r in rows.orderBy("i").collect()]


def _second_moments(fit: DataFrame, d: int, mean: np.ndarray, onto: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of the outer products of centred vectors (projected first
    where ``onto`` is given): one matrix a task, added up by Spark row by row."""
    k = d if onto is None else onto.shape[1]

    def run(batches):
        total = np.zeros((k, k))
        for _, x in _matrices(batches, d):
            centred = x - mean
            centred = centred if onto is None else centred @ onto
            total += centred.T @ centred
        yield pa.record_batch([pa.array(np.repeat(np.arange(k), k), pa.int32()), pa.array(np.tile(np.arange(k), k), pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

    rows = fit.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((k, k))
    for r in rows:
        out[r["i"], r["j"]] = r["s"]
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
    s = np.array(sums, object)
    reach = n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + max(abs(t) for t in sums)
    if reach * reach * len(sums) < 1 << 63:
        return ((n * x - s.astype(np.int64)) ** 2).sum(axis=1).tolist()
    return [t if t < 1 << 63 else None for t in (int(((n * row.astype(object) - s) ** 2).sum()) for row in x)]


def whitened(vectors: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` of every
    row that takes part and every one of the first ``k`` components."""
    spark = vectors.sparkSession
    names = f"{id_col} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = quantised(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], names)
    d = lengths["d"]
    rows = rows.filter(F.size("x") == d)
    fit = stored(rows.select("x").distinct(), scratch(spark, "whitening-fit"))
    n = fit.count()
    sums = _exact_sums(fit, d)
    mean = np.array([t / n for t in sums])
    covariance = _second_moments(fit, d, mean) / n
    values, basis = components(covariance)
    k = min(k, d)
    values, basis = values[:k], basis[:, :k]
    trace = float(np.trace(covariance))
    varies = values > 64 * d * _EPS * max(trace, 0.0)
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    onto = basis * scale
    error = None
    if varies.any():
        spread = _second_moments(fit, d, mean, onto) / n
        error = float(np.abs((spread - np.eye(k))[np.ix_(varies, varies)]).max())
    explained = [float(v / trace) if trace > 0 else None for v in values]

    def run(batches):
        for part, x in _matrices(batches, d):
            m = len(x)
            out = (x - mean) @ onto
            out = pa.array(out.ravel(), mask=np.tile(~varies, m))
            yield pa.record_batch(
                [
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    out,
                    pa.array(explained * m, pa.float64()),
                    pa.array([error] * (m * k), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    plain = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, plain).withColumnRenamed("vec_id", id_col)
