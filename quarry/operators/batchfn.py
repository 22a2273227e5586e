"""User batch functions over exact batches of rows.

``fn`` maps a dict of column lists to a dict of column lists (the row count
may change), like a batched dataset map.  With exact batches the rows are
numbered in order (S8) and each batch of ``batch_size`` consecutive rows —
restarting in each of ``num_proc`` contiguous shards — is one group of a
grouped-map Arrow UDF, so a group is bounded by the batch size.  When ``fn``
does not depend on batch boundaries, ``exact=False`` runs it per Arrow batch
with ``mapInPandas`` and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.index import with_row_index
from quarry.operators.sequences import shard_of


def map_batches(df: DataFrame, fn: Callable[[dict], dict], schema: str, order_cols: list | None = None,
                batch_size: int = 1000, num_proc: int = 1, exact: bool = True,
                remove_columns: list[str] | None = None) -> DataFrame:
    """Apply ``fn`` per batch, like a batched dataset map.

    ``fn`` gets all columns of ``df`` (with exact batches also _shard and _batch) and returns
    the columns that the DDL text ``schema`` declares.  The output has the other columns of
    ``df`` as they are, less ``remove_columns``, then the declared ones (which replace
    columns of the same name).  A ``fn`` that changes the number of rows must have
    all other columns removed, else it raises.
    """
    declared = T.StructType.fromDDL(schema)
    gone = {*(remove_columns or []), *declared.names}
    kept = [f for f in df.schema.fields if f.name not in gone]
    names, through = declared.names, [f.name for f in kept]
    result = T.StructType(kept + declared.fields)
    columns = df.columns

    def call(pdf: pd.DataFrame, extra: list[str]) -> pd.DataFrame:
        res = fn({c: pdf[c].tolist() for c in columns + extra})
        size = len(res[names[0]]) if names else len(pdf)
        if through and size != len(pdf):
            raise ValueError(f"{size} rows from a batch of {len(pdf)}: remove the columns {through}")
        data = {c: pdf[c].reset_index(drop=True) for c in through} | {c: pd.Series(res[c], dtype=object) for c in names}
        return pd.DataFrame(data, columns=through + names)

    if not exact:
        def per_arrow_batch(it):
            for pdf in it:
                yield call(pdf, [])
        return df.mapInPandas(per_arrow_batch, result)
    idx = with_row_index(df, order_cols, "_idx")
    n = idx.count() if num_proc > 1 else 0
    shard, local = shard_of(F.col("_idx"), n, num_proc)
    keyed = idx.withColumn("_shard", shard).withColumn("_batch", F.floor(local / batch_size).cast("long"))

    def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
        return call(pdf.sort_values("_idx"), ["_shard", "_batch"])

    return keyed.groupBy("_shard", "_batch").applyInPandas(per_group, result)
