"""Operator 11: embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V is never formed.  A pass over the stored rows gives V Q for a narrow
matrix Q: every task adds up its part of the centred X'XQ, and the driver gets
a bounded number of d x block sums.  A round applies a Chebyshev polynomial of V to the block by
its three-term recurrence, one pass a degree.  On [0, a], where a is the block's smallest
Ritz value, the polynomial stays within [-1, 1], and it grows fast above, so the
unwanted part of the spectrum is damped against the wanted one.  QR and a
Rayleigh-Ritz step on the block follow, and rounds go on until the wanted pairs are certified:
each residual |V q - e q| is at most ``tol`` times the largest eigenvalue, or rounding
lets it fall no further.

Rows are integers and centred as n*x - S in integers before any floating-point step, so the
common offset costs no digits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.vectors import common_length, int_matrix, packed, summed

SCALE = 64
COMPONENTS = 32
TOL = 1e-14
ROUNDS = 100
#: eigenvalues below this share of the largest count as zero: no component
RANK = 1e-12
#: the filter may raise the largest wanted direction over the rest of the block by so much in a round
GROWTH = 1e7


@dataclass
class Whitening:
    """A fitted whitening: eigenvalues (falling) and unit eigenvectors in columns."""

    dim: int
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int
    identity_error: float | None = None

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.values]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact (as Python integers where 64 bits might not do)."""
    if len(x) and n * int(np.abs(x).max()) + max(map(abs, sums), default=0) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, object)
    return x * np.int64(n) - np.array(sums, np.int64)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return centred(x, n, sums).astype(np.float64) / n


def _ritz(q: np.ndarray, vq: np.ndarray):
    """Ritz values (falling), the block and V times it, turned to the Ritz vectors."""
    h = q.T @ vq
    e, w = np.linalg.eigh((h + h.T) / 2)
    w = w[:, ::-1]
    return e[::-1], q @ w, vq @ w


def leading_pairs(multiply, dim: int, wanted: int, block: int, tol: float = TOL, rounds: int = ROUNDS, seed: int = 3):
    """(values, vectors, residual, passes) of the ``wanted`` largest eigenpairs of a symmetric PSD operator."""
    block = min(block, dim)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, block)))[0]
    e, q, vq = _ritz(q, multiply(q))
    passes, last = 1, math.inf
    for _ in range(rounds):
        top = max(float(e[0]), 0.0)
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * e[:wanted], axis=0).max())
        if block == dim or residual <= tol * top or (residual <= 1e4 * tol * top and residual > 0.5 * last):
            break
        last = residual
        half = max(float(e[-1]), 1e-14 * top) / 2  # the damped interval is [0, 2 * half]
        degree = int(np.clip(math.log(GROWTH) / math.acosh(max(top / half - 1, 1.01)), 2, 16))
        # T_0 = Q and T_1 = (V/half - I) Q, then T_{j+1} = 2 (V/half - I) T_j - T_{j-1}
        before, now = q, vq / half - q
        for _ in range(degree - 1):
            before, now = now, 2 * (multiply(now) / half - now) - before
            size = np.linalg.norm(now, axis=0)
            before, now = before / size, now / size
        q = np.linalg.qr(now)[0]
        q = np.linalg.qr(q)[0]
        e, q, vq = _ritz(q, multiply(q))
        passes += degree
    residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * e[:wanted], axis=0).max())
    return e[:wanted], q[:, :wanted], residual, passes


def fit(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
        tol: float = TOL) -> Whitening | None:
    """Fit on all rows that take part (see ``vectors.int_matrix``); None without such rows.

    An entry c counts as the integer floor(scale * c); the covariance has divisor n.  At most
    ``components`` pairs are kept, and only those above RANK of the largest eigenvalue, so rows
    that are all equal give none.
    """
    dim = common_length(df, vec_col)
    if not dim:
        return None
    chunks = packed(df, vec_col, dim, scale)
    parts = chunks.rdd.getNumPartitions()
    counted = summed(chunks, parts, dim, lambda x: np.array([len(x), *x.astype(object).sum(0)], object))
    if counted is None:
        return None
    n, sums = int(counted[0]), [int(s) for s in counted[1:]]
    squares = summed(chunks, parts, dim, lambda x: np.square(_scaled(x, n, sums)).sum())
    trace = float(squares) / n

    def multiply(q: np.ndarray) -> np.ndarray:
        def part(x):
            z = _scaled(x, n, sums)
            return z.T @ (z @ q)
        return summed(chunks, parts, dim, part) / n

    wanted = min(components, dim)
    e, q, residual, passes = leading_pairs(multiply, dim, wanted, wanted + wanted // 2, tol)
    held = e > max(RANK * float(e[0]), 0.0)
    model = Whitening(dim, n, sums, trace, e[held], q[:, held], residual, passes)
    if held.any():
        turn = model.vectors / np.sqrt(model.values)

        def moments(x):
            w = _scaled(x, n, sums) @ turn
            return np.vstack([w.T @ w, w.sum(0)])
        got = summed(chunks, parts, dim, moments) / n
        cov = got[:-1] - np.outer(got[-1], got[-1])
        model.identity_error = float(np.abs(cov - np.eye(len(cov))).max())
    return model


def whiten(df: DataFrame, model: Whitening | None, vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """All columns of the rows that take part, with ``deviation`` (long) and ``whitened`` (array<double>).

    deviation: sum over dimensions of (n*x - S)^2, exact; null where it does not fit a long.
    whitened: x - S/n projected on each component, over the root of its eigenvalue.  Columns
    of ``df`` with these names are replaced.  Rows whose vector is null, holds null, non-finite or
    excessive entries, or has another length than most are left out; repeated rows
    each count.  Without a model (no rows) the result is empty.
    """
    kept = [c for c in df.columns if c not in ("deviation", "whitened")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in kept)
    schema = fields + ", deviation long, whitened array<double>"
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, n, sums = model.dim, model.n, model.sums
    turn = model.vectors / np.sqrt(model.values)
    at_vec = kept.index(vec_col)

    def run(batches):
        for batch in batches:
            at, x = int_matrix(batch.column(at_vec), dim, scale)
            d = centred(x, n, sums)
            z = d.astype(np.float64)
            if d.dtype == object or (np.square(z).sum(1) >= 9e18).any():
                d = d.astype(object)
            dev = [int(s) if s < 1 << 63 else None for s in (d * d).sum(1).tolist()]
            w = (z / n) @ turn
            take = pa.array(at)
            offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(take) for i in range(batch.num_columns)] + [
                    pa.array(dev, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))],
                names=[*kept, "deviation", "whitened"])

    return df.select(*kept).mapInArrow(run, schema)
