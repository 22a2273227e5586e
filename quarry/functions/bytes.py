"""Byte-level alphabet (T5): every UTF-8 byte is one symbol of the base vocabulary.

The byte -> symbol map is the public GPT-2 rule: printable Latin-1 bytes map to
themselves, the other 68 bytes are shifted above 255 in byte order.  The base
vocabulary then lists the 256 symbols in code-point order, after the special
tokens, so a byte's id follows from the rule below instead of a typed table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import SPECIAL_TOKENS

PRINTABLE_RANGES = [(33, 126), (161, 172), (174, 255)]  # inclusive byte ranges kept as-is


def _symbols() -> tuple[int, ...]:
    keep = {b for lo, hi in PRINTABLE_RANGES for b in range(lo, hi + 1)}
    out, shifted = [], 0
    for b in range(256):
        if b in keep:
            out.append(b)
        else:
            out.append(256 + shifted)
            shifted += 1
    return tuple(out)


def _ids(sym: tuple[int, ...]) -> tuple[int, ...]:
    order = sorted(range(256), key=lambda b: sym[b])
    ids = [0] * 256
    for rank, b in enumerate(order):
        ids[b] = len(SPECIAL_TOKENS) + rank
    return tuple(ids)


# computed once at import; plain constants travel with pickled task code
_BYTE_TO_SYMBOL = _symbols()
_BYTE_TO_ID = _ids(_BYTE_TO_SYMBOL)


def byte_to_symbol() -> tuple[int, ...]:
    """Code point that represents each byte 0..255 (GPT-2 byte-level rule)."""
    return _BYTE_TO_SYMBOL


def byte_to_id() -> tuple[int, ...]:
    """Token id of each byte: specials first, then symbols in code-point order."""
    return _BYTE_TO_ID


def id_to_byte() -> dict[int, int]:
    return {i: b for b, i in enumerate(_BYTE_TO_ID)}


FIRST_MERGE_ID = len(SPECIAL_TOKENS) + 256  # 261


_ID_OF_BYTE = np.array(_BYTE_TO_ID, np.int32)


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets (from 0) of a string column; null counts as empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, offsets, data = col.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


SLICE_BYTES = 1 << 20


def text_slices(col: pa.Array, most: int = SLICE_BYTES) -> list[pa.Array]:
    """The string column cut into runs of rows of about ``most`` bytes, one row at least; one empty run if there are no rows."""
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(col)]
    return [col.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def id_lists(ids: np.ndarray, offsets: np.ndarray, like: pa.Array) -> pa.Array:
    """Lists of ids, null where ``like`` is."""
    gone = np.r_[like.is_null().to_numpy(zero_copy_only=False), False]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=gone if gone.any() else None), pa.array(ids, pa.int32()))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_ids_udf(col: pa.Array) -> pa.Array:
    data, offsets = string_bytes(col)
    return id_lists(_ID_OF_BYTE[data], offsets, col)


def byte_ids(col: Column) -> Column:
    """T5: array<int> of base-vocabulary ids (5..260) of a string's UTF-8 bytes.

    One table look-up over the bytes of a whole Arrow batch.
    """
    return _byte_ids_udf(col)
