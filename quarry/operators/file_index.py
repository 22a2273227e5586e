"""Random access to records: line offsets of files taken in their scan (S9), and a stored index whose look-up
reads only the files that hold the positions (S8)."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.index import with_row_index
from quarry.session import cut_lineage


def file_line_offsets(spark: SparkSession, paths) -> DataFrame:
    """S9 for text files: (file, line, byte_start, byte_end) of every line, lines numbered from 0 in their file.

    One pass over the texts.  A task reads its splits in file order and keeps running sums from each split's
    start, so nothing is sorted; only four numbers a line are stored.  The sums of whole splits, one row
    each, then give every split its place in its file.  Lines end at ``\\n`` alone (a ``\\r`` before it is part of
    the line), bytes count as they are in the file, and a last line without ``\\n`` ends with the file.
    Offsets in compressed files are those of the text in them.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    slim = lines.select(F.xxhash64("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                        (F.octet_length("value") + 1).cast("long").alias("_len"), F.col("_metadata.file_size").alias("_size"))

    def run(batches):
        last, end, lines_before = None, 0, 0  # of the split read last
        for batch in batches:
            f, b, size = (batch.column(i).to_numpy() for i in range(3))
            if not len(f):
                continue
            new = np.r_[(f[0], b[0]) != last, (f[1:] != f[:-1]) | (b[1:] != b[:-1])]
            split = np.cumsum(new)
            ends, number = np.cumsum(size), np.arange(len(f))
            # what stands before the split of each row; the first split may go on from the batch before
            base, first = np.r_[-end, (ends - size)[new]], np.r_[-lines_before, number[new]]
            start, line = ends - size - base[split], number - first[split]
            last, end, lines_before = (f[-1], b[-1]), int(start[-1] + size[-1]), int(line[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(line), pa.array(start), batch.column(2),
                                              batch.column(3)], names=["_f", "_b", "_line", "_start", "_len", "_size"])

    rows = cut_lineage(slim.mapInArrow(run, "_f long, _b long, _line long, _start long, _len long, _size long"))
    splits = rows.groupBy("_f", "_b").agg(F.sum("_len").alias("_n"), F.count("*").alias("_lines"))
    whole = Window.partitionBy("_f")
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    splits = splits.select(F.col("_f").alias("_g"), F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"),
                           F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_first"), F.sum("_n").over(whole).alias("_all"))
    # names by file, not by line; this source opens no file unless its content is asked for
    names = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file")) \
        .withColumn("_h", F.xxhash64("file"))
    start = F.col("_at") + F.col("_start")
    end = start + F.col("_len")
    open_end = (F.col("_all") == F.col("_size") + 1) & (end == F.col("_all"))
    return rows.join(splits, (F.col("_f") == F.col("_g")) & (F.col("_b") == F.col("_c"))).join(names, F.col("_f") == F.col("_h")) \
        .select("file", (F.col("_first") + F.col("_line")).alias("line"), start.alias("byte_start"),
                F.when(open_end, end - 1).otherwise(end).alias("byte_end"))


@dataclass(frozen=True)
class StoredIndex:
    """A table stored with the position of each row, in folders of ``rows_per_part`` consecutive positions.

    ``schema``: the stored columns, as ``write`` returns them; without it they are read from the files.
    """

    path: str
    name: str = "idx"
    rows_per_part: int = 1_000_000
    schema: T.StructType | None = None

    def write(self, df: DataFrame, order_cols: list) -> StoredIndex:
        """Number the rows in ``order_cols`` order (S8) and store them, sorted by position, replacing what is there.

        The numbering leaves every task a run of positions, so a folder gets few files without another shuffle.
        """
        part = F.floor(F.col(self.name) / self.rows_per_part).cast("long")
        out = with_row_index(df, order_cols, self.name).withColumn("_part", part)
        out.sortWithinPartitions("_part", self.name).write.mode("overwrite").partitionBy("_part").parquet(self.path)
        return replace(self, schema=out.schema)

    def _stored(self, spark: SparkSession) -> DataFrame:
        return (spark.read.schema(self.schema) if self.schema else spark.read).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark).drop("_part")

    def at(self, positions: DataFrame) -> DataFrame:
        """The rows at the positions in a one-column table, each once; absent positions give no rows.

        The folders that hold them (their numbers, at most one a folder, come to the driver) are the only ones listed
        and read, and the least and greatest position prune row groups inside.
        """
        spark = positions.sparkSession
        wanted = positions.toDF(self.name)
        part = F.floor(F.col(self.name) / self.rows_per_part).cast("long").alias("_part")
        parts = wanted.where(F.col(self.name) >= 0).groupBy(part).agg(F.min(self.name).alias("lo"), F.max(self.name).alias("hi")).collect()
        rows = self._stored(spark).where(F.col("_part").isin([r["_part"] for r in parts]))
        if parts:
            rows = rows.where(F.col(self.name).between(min(r["lo"] for r in parts), max(r["hi"] for r in parts)))
        return rows.join(wanted, self.name, "left_semi").drop("_part")
