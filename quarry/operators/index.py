"""Stable positions and prefix sums without a single-partition window.

Rows are range-partitioned on the order key and sorted; each row's partition and its
place in it are then written, with the row, to the checkpoint folder.  Both passes that
follow (rows per partition, and the rows themselves) read those files, so they agree
whatever happens to caches or executors in between.  The offset table has one row
per partition, or per (group, partition) pair; a hot group is spread over many range
partitions, so no task ever holds a whole group.

Prefix sums carry only the order key and the summed numbers; texts and id arrays are
joined back by the caller where they are wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage

_LOCAL_BITS = 33
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _ranged(df: DataFrame, order: list, num_partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions with each row's partition (_pid) and place in it (_loc), stored."""
    parts = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return cut_lineage(parts.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
                       .withColumn("_pid", F.shiftrightunsigned("_mid", _LOCAL_BITS))
                       .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK))).drop("_mid"))


def with_row_index(df: DataFrame, order_cols: list, name: str = "idx",
                   group_cols: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (within ``group_cols``).

    The order columns must make the order total (unique), as with any stable index.
    """
    group_cols = group_cols or []
    tagged = _ranged(df, _cols(group_cols) + _cols(order_cols), num_partitions)
    # rows of one group in one partition are contiguous (sorted by group first)
    counts = tagged.groupBy(*group_cols, "_pid").agg(F.count("*").alias("_n"), F.min("_loc").alias("_first"))
    w = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(g).alias(f"_g_{i}") for i, g in enumerate(group_cols)]
    offsets = counts.select(*keys, F.col("_pid").alias("_p"), "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # null groups count as a group of their own; AQE broadcasts the offsets when they are small
    on = F.col("_pid") == F.col("_p")
    for i, g in enumerate(group_cols):
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{i}"))
    out = tagged.join(offsets, on)
    return out.withColumn(name, F.col("_off") + F.col("_loc") - F.col("_first")).select(*df.columns, name)


def rows_at(indexed: DataFrame, positions: DataFrame, name: str = "idx") -> DataFrame:
    """S8 lookup: the rows whose position occurs in the one-column table ``positions`` (a semi-join)."""
    return indexed.join(positions.toDF(name), name, "left_semi")


def head_records(df: DataFrame, order_cols: list, n: int, name: str = "idx") -> DataFrame:
    """The first ``n`` records in order, numbered from 0.

    The cut is a distributed top-n; the survivors are numbered by range partitions (S8).
    """
    return with_row_index(df.orderBy(*_cols(order_cols)).limit(n), order_cols, name)


def prefix_sums(df: DataFrame, order_cols: list[str], sums: dict[str, str]) -> DataFrame:
    """(order columns, summed columns, prefix columns): exclusive running sums in order.

    ``sums`` maps each new column to the column it sums (nulls count as 0).  The order must
    be total.  Other columns of ``df`` are left out; join on the order columns to
    get them back.
    """
    slim = df.select(*order_cols, *dict.fromkeys(sums.values()))
    ranged = _ranged(slim, _cols(order_cols))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = ranged.groupBy("_pid").agg(*[F.sum(v).alias(f"_t_{o}") for o, v in sums.items()])
    offsets = totals.select(F.col("_pid").alias("_p"), *[
        F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums])
    inside = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_l_{o}") for o, v in sums.items()])
    out = local.join(offsets, F.col("_pid") == F.col("_p"))
    return out.select(*slim.columns, *[(F.col(f"_o_{o}") + F.col(f"_l_{o}")).cast("long").alias(o) for o in sums])


def record_offsets(lines: DataFrame, order_cols: list[str], line_col: str = "line") -> DataFrame:
    """(order columns, byte_start, byte_end) of each line in a newline-joined file.

    ``byte_start`` = sum of (UTF-8 length + 1) of earlier lines; ``byte_end`` =
    ``byte_start`` + own length + 1; the n+1 offsets are byte_start of every row
    plus the last byte_end.  Only keys and lengths are moved.
    """
    sized = lines.select(*order_cols, (F.octet_length(line_col) + 1).cast("long").alias("_len"))
    out = prefix_sums(sized, order_cols, {"byte_start": "_len"})
    return out.withColumn("byte_end", F.col("byte_start") + F.coalesce("_len", F.lit(0))).drop("_len")
