"""Q8 packing (+ Q9 labels, U2 shards): concatenate ids per batch of rows, cut into blocks.

Per batch of ``batch_size`` consecutive rows (consecutive in the order key, and
restarting in each of ``num_proc`` contiguous shards) all id columns are
concatenated and cut into ``block_size`` blocks; the remainder is dropped,
unless the whole batch is shorter than one block, which then yields one short
block.  Every column is cut alike; labels are a copy of input ids.

Spark plan: a distributed prefix-sum pass over (key, size) gives each row its global
index and global id offset -> a partial aggregate per batch gives the batch start
and total -> the kept blocks of each row are worked out on that slim table -> one join
by key brings in the ids, cut into fragments -> group by (batch, block) and
concatenate fragments in row order.  A group holds one block's worth of ids,
never a whole batch, so even a single huge batch (a stream micro-batch) is
spread over all tasks.

A stream micro-batch is packed from its texts (``text``): the texts are stored with
the number of their ids, and ids are made where blocks are cut.  Runs of rows that lie
together in a task are cut there, slice by slice; only the blocks in which runs meet
are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import BLOCK_SIZE, PACK_BATCH_SIZE
from quarry.functions.bytes import text_slices
from quarry.functions.encode import byte_level_counts, byte_level_ids, encode
from quarry.operators.index import prefix_sums
from quarry.session import cut_lineage

ONE_BATCH = 1 << 40  # a batch size beyond any number of rows


def _field(name: str):
    return lambda s: s[name]


def shard_of(idx: Column, n: int, num_proc: int) -> tuple[Column, Column]:
    """Contiguous shard of row ``idx`` among ``num_proc`` shards of n rows
    (the first n % num_proc shards hold one extra row) and the row's index in it."""
    if num_proc <= 1:
        return F.lit(0).cast("long"), idx
    div, mod = divmod(n, num_proc)
    big = mod * (div + 1)
    shard = F.when(idx < big, F.floor(idx / (div + 1))).otherwise(
        F.lit(mod) + F.floor((idx - big) / max(div, 1))).cast("long")
    start = shard * div + F.least(shard, F.lit(mod))
    return shard, idx - start


def pack_blocks(df: DataFrame, order_cols: list[str], columns: list[str] | tuple = ("input_ids", "attention_mask"),
                block_size: int = BLOCK_SIZE, batch_size: int = PACK_BATCH_SIZE, num_proc: int = 1,
                labels_from: str | None = "input_ids", ones: list[str] | tuple = (), text: str | None = None) -> DataFrame:
    """Rows (shard, batch, block, <columns>..., <ones>..., labels).

    ``order_cols`` identify a row.  ``ones``: columns that are 1 for every id (an attention
    mask before padding); they are made from the blocks' lengths instead of being moved.
    ``df`` is read twice, for the sizes and for the ids, and nothing is cached.

    ``text``: the one id column is not in ``df`` but is ``encode`` of this column; all rows are
    one batch (``ONE_BATCH``).  The last of ``order_cols`` must then be
    ``monotonically_increasing_id`` of ``df``; ``df`` is read once and stored.
    """
    columns = list(columns)
    if text is not None:
        if len(columns) > 1 or num_proc > 1 or batch_size < ONE_BATCH:
            raise ValueError("texts are packed into one column, as one batch")
        out = _blocks_of_texts(df, order_cols, text, columns[0], block_size).select(
            F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("batch"), "block", *columns)
        return _with_derived(out, columns[0], labels_from, ones)
    src = df.select(*order_cols, *columns, F.size(columns[0]).cast("long").alias("_sz"), F.lit(1).cast("long").alias("_one"))
    places = cut_lineage(prefix_sums(src, order_cols, {"_idx": "_one", "_gpos": "_sz"}))
    n = places.count()
    shard, local = shard_of(F.col("_idx"), n, num_proc)
    places = places.withColumn("shard", shard).withColumn("batch", F.floor(local / batch_size).cast("long"))
    stats = places.groupBy("shard", "batch").agg(F.min("_gpos").alias("_bstart"), F.sum("_sz").alias("_total"))
    # the cut points of every row, on the slim table; ids are joined once
    rows = places.where(F.col("_sz") > 0).join(stats, ["shard", "batch"]) \
        .withColumn("_off", F.col("_gpos") - F.col("_bstart"))
    nblocks = F.when(F.col("_total") >= block_size, F.floor(F.col("_total") / block_size)).otherwise(1)
    first = F.floor(F.col("_off") / block_size)
    last = F.least(F.floor((F.col("_off") + F.col("_sz") - 1) / block_size), nblocks - 1)
    cut = rows.where(first <= last).select(*[F.col(c).alias(f"_k_{i}") for i, c in enumerate(order_cols)], "shard", "batch",
                                           "_idx", "_off", "_total", first.alias("_first"), last.alias("_last"))
    on = [F.col(c).eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(order_cols)]
    blocks = src.join(cut, on).withColumn("block", F.explode(F.sequence("_first", "_last")))
    lo = F.greatest(F.col("block") * block_size, F.col("_off"))
    hi = F.least((F.col("block") + 1) * block_size, F.col("_off") + F.col("_sz"))
    frags = [F.slice(F.col(c), (lo - F.col("_off") + 1).cast("int"), (hi - lo).cast("int")).alias(c) for c in columns]
    pieces = blocks.select("shard", "batch", F.col("block").cast("long").alias("block"), "_idx", *frags)
    agg = pieces.groupBy("shard", "batch", "block").agg(
        F.sort_array(F.collect_list(F.struct("_idx", *columns))).alias("_f"))
    out = agg.select("shard", "batch", "block",
                     *[F.flatten(F.transform("_f", _field(c))).alias(c) for c in columns])
    return _with_derived(out, columns[0], labels_from, ones)


def _with_derived(blocks: DataFrame, ids: str, labels_from: str | None, ones: list[str] | tuple) -> DataFrame:
    out = blocks.withColumns({c: F.array_repeat(F.lit(1), F.size(ids)) for c in ones})
    if labels_from:
        out = out.withColumn("labels", F.col(labels_from))
    return out


def _blocks_of_texts(df: DataFrame, order_cols: list[str], text: str, name: str, block_size: int) -> DataFrame:
    """(block, ids) of all texts in ``order_cols`` order.

    A run is what a partition holds of equal order columns but the last, which rises in it.  So a run
    has one place in the whole order, and a text's place follows from its run's start and the ids before
    it in the run.  The table of the runs (one row per file split in a stream) is broadcast.
    """
    *place, pos = order_cols
    run = [*place, "_part"]  # the upper bits of a monotonic id are its partition
    rows = cut_lineage(df.select(*place, F.shiftrightunsigned(pos, 33).alias("_part"), text,
                                 _counts_in_run(F.struct(F.lit(0), *place), text).alias("_n"))
                       .select(*run, text, "_n.*"), cache=False)
    runs = cut_lineage(prefix_sums(rows.groupBy(*run).agg(F.sum("_size").alias("_ids")), run, {"_start": "_ids"}))
    total = runs.agg(F.sum("_ids")).first()[0] or 0
    starts = F.broadcast(runs.select(*[F.col(c).alias(f"_r_{i}") for i, c in enumerate(run)], "_start", "_ids"))
    same = [F.col(c).eqNullSafe(F.col(f"_r_{i}")) for i, c in enumerate(run)]
    at, start, end = F.col("_at"), F.col("_start"), F.col("_start") + F.col("_ids")
    placed = rows.where(F.col("_size") > 0).join(starts, same) \
        .select("_start", end.alias("_end"), (start + F.col("_before")).alias("_at"), "_size", text)
    whole = placed.select("_start", "_at", F.col(text).alias("_text")) \
        .mapInArrow(_whole_blocks(name, block_size), f"block long, `{name}` array<int>")
    # blocks in which a run begins or ends, and the rows that reach into them
    first, last = F.floor(start / block_size), F.floor((F.col("_end") - 1) / block_size)
    edges = F.array_distinct(F.array_compact(F.array(F.when(start % block_size != 0, first),
                                                     F.when(F.col("_end") % block_size != 0, last))))
    after = at + F.col("_size")
    met = placed.withColumn("_edges", F.filter(edges, lambda b: (b < max(total // block_size, 1)) & (b * block_size < after)
                                               & ((b + 1) * block_size > at)))
    lo, hi = F.greatest(F.col("block") * block_size, at), F.least((F.col("block") + 1) * block_size, after)
    pieces = met.where(F.size("_edges") > 0).withColumn("_ids", encode(F.col(text))).withColumn("block", F.explode("_edges")) \
        .select("block", lo.alias("_lo"), F.slice("_ids", (lo - at + 1).cast("int"), (hi - lo).cast("int")).alias("_ids"))
    joined = pieces.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("_lo", "_ids"))).alias("_f")) \
        .select("block", F.flatten(F.transform("_f", _field("_ids"))).alias(name))
    return whole.unionByName(joined)


@F.arrow_udf(T.StructType([T.StructField("_size", T.LongType()), T.StructField("_before", T.LongType())]))
def _counts_in_run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Number of ids of each text, and of the texts before it in its run; ``run`` is a struct."""
    seen: dict = {}
    for runs, texts in batches:
        sizes = pc.fill_null(byte_level_counts(texts, True), 0).cast(pa.int64())
        before = []
        for key, n in zip(zip(*[c.to_pylist() for c in runs.flatten()]), sizes.to_pylist()):
            before.append(seen.get(key, 0))
            seen[key] = before[-1] + n
        yield pa.StructArray.from_arrays([sizes, pa.array(before, pa.int64())], ["_size", "_before"])


def _whole_blocks(name: str, block_size: int):
    """Texts with their run and the place of their first id -> the blocks that lie whole in a run.

    Holds the ids of a slice of texts, and of each run of the task those after its last whole block.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            row = 0
            for texts in text_slices(batch.column("_text")):
                part = batch.slice(row, len(texts))
                row += len(texts)
                numbers, blocks = [], []
                for start, at, ids in _stretches(part, byte_level_ids(texts, True)):
                    kept = held.pop(start, None)
                    if kept is None:  # what comes before the run's first whole block is left to the edges
                        skipped = -at % block_size
                        at, ids = at + skipped, ids[skipped:]
                    else:
                        if at % block_size != len(kept):
                            raise ValueError(f"ids at {at} do not follow those before in their run")
                        at, ids = at - len(kept), np.concatenate([kept, ids])
                    n = len(ids) // block_size
                    numbers.append(at // block_size + np.arange(n))
                    blocks.append(ids[: n * block_size])
                    if len(ids) > n * block_size:
                        held[start] = ids[n * block_size:].copy()
                if numbers:
                    block = pa.array(np.concatenate(numbers), pa.int64())
                    offsets = pa.array(np.arange(len(block) + 1) * block_size, pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(blocks), pa.int32()))
                    yield pa.RecordBatch.from_arrays([block, lists], ["block", name])

    return cut


def _stretches(rows: pa.RecordBatch, ids: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start of the run, place of the first id, ids) of neighbouring rows of one run."""
    starts, at = rows.column("_start").to_numpy(), rows.column("_at").to_numpy()
    flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
    cuts = np.flatnonzero(np.diff(starts)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)]):
        if b > a:
            yield int(starts[a]), int(at[a]), flat[offsets[a]: offsets[b]]
