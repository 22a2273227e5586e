"""Ids as a fixed-width binary column (T5, Q1, Q2, Q4): four little-endian bytes an id.

Truncating, padding and shifting are byte copies inside generated code, with no element objects; a
batch becomes arrays at the sink only, by reading its buffer as integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import PAD_ID
from quarry.functions.encode import BpeModel, byte_level_ids, encode

WIDTH = 4


def _packed(col: pa.Array) -> pa.Array:
    """Binary column of a list<int32> column."""
    ids = col.flatten()
    sizes = np.diff(col.offsets.to_numpy()) * col.is_valid().to_numpy(zero_copy_only=False)
    offsets = pa.py_buffer((np.concatenate([[0], np.cumsum(sizes)]) * WIDTH).astype(np.int32).tobytes())
    data = pa.py_buffer(ids.to_numpy(zero_copy_only=False).astype("<i4", copy=False).tobytes())
    out = pa.Array.from_buffers(pa.binary(), len(col), [None, offsets, data])
    return out if not col.null_count else pa.compute.if_else(col.is_valid(), out, None)


@F.arrow_udf(T.BinaryType())
def _encode_udf(col: pa.Array) -> pa.Array:
    return _packed(byte_level_ids(col, False))


@F.arrow_udf(T.BinaryType())
def _encode_nfkc_udf(col: pa.Array) -> pa.Array:
    return _packed(byte_level_ids(col, True))


@F.arrow_udf(T.BinaryType())
def pack_ids(ids: pa.Array) -> pa.Array:
    """array<int> -> binary."""
    return _packed(ids)


def int_lists(col: pa.Array) -> pa.Array:
    """list<int32> column of a binary column, its data read in place."""
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    ids = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]].view("<i4") if data is not None else np.zeros(0, np.int32)
    gone = np.r_[col.is_null().to_numpy(zero_copy_only=False), False] if col.null_count else None
    return pa.ListArray.from_arrays(pa.array((offsets - offsets[0]) // WIDTH, pa.int32(), mask=gone), pa.array(ids, pa.int32()))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def unpack_ids(ids: pa.Array) -> pa.Array:
    """binary -> array<int>."""
    return int_lists(ids)


def encode_packed(col: Column, model: BpeModel | None = None, normalize: bool = True) -> Column:
    """K4 as a binary column."""
    if model is None or not model.merges:
        return (_encode_nfkc_udf if normalize else _encode_udf)(col)
    return pack_ids(encode(col, model, normalize))


def id_bytes(i: int) -> bytes:
    return i.to_bytes(WIDTH, "little")


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / WIDTH).cast("int")


def prepend(i: int, ids: Column) -> Column:
    return F.concat(F.lit(id_bytes(i)), ids)


def truncate(ids: Column, n: int) -> Column:
    """Q1."""
    return F.substring(ids, 1, n * WIDTH)


def pad_right(ids: Column, n: int, pad: int = PAD_ID) -> Column:
    """Q2 (and Q1: longer ones are cut)."""
    return F.rpad(ids, F.lit(n * WIDTH), F.lit(id_bytes(pad)))


def shift_x(ids: Column, n: int) -> Column:
    """Q4 of a padded column of width ``n``."""
    return F.substring(ids, 1, (n - 1) * WIDTH)


def shift_y(ids: Column, n: int) -> Column:
    """Q4 of a padded column of width ``n``."""
    return F.substring(ids, 1 + WIDTH, (n - 1) * WIDTH)
