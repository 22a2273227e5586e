"""Embedding columns as integer matrices over Arrow batches, and sums over all of them."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

#: entries of which scale * entry lies at or beyond this count as not finite
LIMIT = 2.0 ** 50
CHUNK_ROWS = 1024
#: so many partial sums go to the driver at most
FAN = 64


def common_length(df: DataFrame, vec_col: str) -> int:
    """The most frequent vector length (of equally frequent ones the greatest); 0 without any."""
    got = df.select(F.size(vec_col).alias("d")).where("d > 0").groupBy("d").agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), F.desc("d")).first()
    return got["d"] if got else 0


def int_matrix(col: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, matrix): floor(scale * entry) as int64 of the rows that take part.

    A row takes no part if its vector is null, has not ``dim`` entries, or holds a null,
    non-finite or excessive (see LIMIT) entry.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = col.offsets.to_numpy().astype(np.int64)
    values = col.values.cast(pa.float64()).to_numpy(zero_copy_only=False) * scale
    valid = col.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(valid & (np.diff(off) == dim))
    rows = values[off[at][:, None] + np.arange(dim)]
    fine = (np.abs(rows) < LIMIT).all(1)  # false for NaN, which a null entry is too
    return at[fine], np.floor(rows[fine]).astype(np.int64)


def packed(df: DataFrame, vec_col: str, dim: int, scale: int) -> DataFrame:
    """The rows that take part as a stored table of (data, width): chunks of CHUNK_ROWS rows, ``width`` bytes an entry."""

    def run(batches):
        for batch in batches:
            _, x = int_matrix(batch.column(0), dim, scale)
            data, width = [], []
            for i in range(0, len(x), CHUNK_ROWS):
                part = x[i: i + CHUNK_ROWS]
                lo, hi = int(part.min()), int(part.max())
                kind = next(t for t in (np.int8, np.int16, np.int32, np.int64)
                            if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max)
                data.append(part.astype(kind).tobytes())
                width.append(np.dtype(kind).itemsize)
            if data:
                yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()), pa.array(width, pa.int32())],
                                                 names=["data", "width"])

    return cut_lineage(df.select(vec_col).mapInArrow(run, "data binary, width int"))


def _added(parts) -> np.ndarray | None:
    total = None
    for p in parts:
        total = p if total is None else total + p
    return total


def summed(chunks: DataFrame, parts: int, dim: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``of(rows)`` over all chunks of ``packed``; None without rows.

    A task adds up its chunks; beyond FAN tasks the partial sums are added in further
    rounds of tasks, so that a bounded number of them reaches the driver.
    """

    def first(batches):
        total = None
        for batch in batches:
            for data, width in zip(batch.column(0), batch.column(1).to_pylist()):
                rows = np.frombuffer(data.as_buffer(), f"<i{width}").reshape(-1, dim).astype(np.int64)
                part = of(rows)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["part"])

    def again(batches):
        total = _added(pickle.loads(p) for batch in batches for p in batch.column(0).to_pylist())
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["part"])

    sums = chunks.mapInArrow(first, "part binary")
    while parts > FAN:
        parts = -(-parts // FAN)
        sums = sums.repartition(parts).mapInArrow(again, "part binary")
    return _added(pickle.loads(r["part"]) for r in sums.collect())
