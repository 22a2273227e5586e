"""Row identity and held-out folds shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(id_col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id: fold of the empty text)."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def row_key(*cols: str) -> list[Column]:
    """Two 64-bit hashes that identify a row by the given columns (nulls included).

    A row without a unique id (null or repeated ids) is still told from rows with
    other values; rows equal in all given columns share a key.
    """
    null_marks = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(null_marks, *cols).alias("_k1"), F.xxhash64(F.lit(1), null_marks, *reversed(cols)).alias("_k2")]
