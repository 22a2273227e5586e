"""Split texts into consecutive fixed-size chunks, one row per chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.constants import CHUNK_SIZE
from quarry.functions.text import chunk_array


def split_text(df: DataFrame, text_col: str = "text", n: int = CHUNK_SIZE,
               keep: list[str] | None = None, out_col: str = "text") -> DataFrame:
    """Rows (keep..., chunk_idx, out_col).  Narrow: no shuffle; empty text -> no rows."""
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    return df.select(*keep, F.posexplode(chunk_array(F.col(text_col), n)).alias("chunk_idx", out_col))
