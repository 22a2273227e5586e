"""Aggregations and scoring (A1-A5)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.constants import LOSS_IGNORE_ID, MAX_LENGTH
from quarry.session import cut_lineage


def mask_ones(mask: Column) -> Column:
    """Number of 1s in a 0/1 mask, without a lambda (``array_remove`` is not a higher-order function)."""
    return F.size(F.array_remove(mask, 0)).cast("long")


def masked_mean(df: DataFrame, group_cols: list[str], loss_col: str = "loss", mask_col: str = "mask",
                out_col: str = "loss") -> DataFrame:
    """A1: token-weighted mean sum(loss*mask) / sum(mask) per group; NULL when nothing is masked in."""
    return df.groupBy(*group_cols).agg(
        F.try_divide(F.sum(F.col(loss_col) * F.col(mask_col)), F.sum(mask_col).cast("double")).alias(out_col))


def ignore_index(loss: Column, y: Column, ignore_id: int = LOSS_IGNORE_ID) -> Column:
    """A2: loss is 0 where the target is the ignored id (it stays in the denominator)."""
    return F.when(y == ignore_id, F.lit(0.0)).otherwise(loss)


def mask_accounting(seqs: DataFrame, group_cols: list[str], max_length: int = MAX_LENGTH,
                    mask_col: str = "loss_mask") -> DataFrame:
    """A3: loss-bearing and padding share of positions, truncated rows, per group."""
    loss = mask_ones(F.col(mask_col))
    agg = seqs.groupBy(*group_cols).agg(
        F.count("*").alias("n_seq"),
        F.sum(F.size(mask_col)).cast("long").alias("n_positions"),
        F.sum(loss).cast("long").alias("loss_positions"),
        F.count_if(F.col("n_tokens") > max_length).alias("truncated"))
    return agg.select(*group_cols, "n_seq", "n_positions", "loss_positions",
                      (F.col("n_positions") - F.col("loss_positions")).alias("pad_positions"), "truncated",
                      F.round(F.try_divide(F.col("loss_positions"), F.col("n_positions").cast("double")), 6)
                      .alias("loss_share"))


def _positions(seqs: DataFrame, keep: list[str]) -> DataFrame:
    z = F.arrays_zip(F.col("x").alias("x"), F.col("y").alias("y"), F.col("loss_mask").alias("m"))
    return seqs.select(*keep, F.inline(z))


def bigram_counts(seqs: DataFrame) -> DataFrame:
    """A5 input: (x, y, n) over the loss-bearing training pairs (partial + final aggregate)."""
    return _positions(seqs, []).where(F.col("m") == 1).groupBy("x", "y").agg(F.count("*").alias("n"))


def next_token_table(seqs: DataFrame) -> DataFrame:
    """A5: candidate next tokens per context with ln(count) as logit."""
    return bigram_counts(seqs).select(F.col("x").alias("ctx"), F.col("y").alias("token"), "n",
                                      F.ln(F.col("n")).alias("logit"))


DENSE_CELLS = 1 << 22


def dense_bigram_model(seqs: DataFrame, vocab_size: int) -> np.ndarray | None:
    """V x V array of -ln p(y|x), p = (c(x,y) + 1) / (c(x) + V) over loss-bearing pairs.

    A task counts its pairs in one array and emits the cells it saw.  At most V^2 cells reach the driver, so
    V^2 must be at most DENSE_CELLS; None beyond, and for ids outside the vocabulary.
    """
    if vocab_size * vocab_size > DENSE_CELLS:
        return None

    def count(batches):
        cells, strange = np.zeros(vocab_size * vocab_size, np.int64), 0
        for batch in _parts(batches):
            x, y, m = _flat(batch, 0)
            known = (x >= 0) & (x < vocab_size) & (y >= 0) & (y < vocab_size)
            strange += int(((m == 1) & ~known).sum())
            at = (m == 1) & known
            cells += np.bincount(x[at] * vocab_size + y[at], minlength=len(cells))
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[cells[at], strange])], names=["cell", "n"])

    rows = seqs.select("x", "y", "loss_mask").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(vocab_size * vocab_size)
    for r in rows:
        if r["cell"] >= 0:
            n[r["cell"]] = r["n"]
        elif r["n"]:
            return None
    n = n.reshape(vocab_size, vocab_size)
    return -np.log((n + 1) / (n.sum(1, keepdims=True) + vocab_size))


PART_ROWS = 256


def _parts(batches):
    """The batches a few rows at a time: what is worked out of their positions is several times their size."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def _flat(batch: pa.RecordBatch, first: int) -> list[np.ndarray]:
    """x, y and mask of all positions of a batch, from column ``first`` on."""
    return [batch.column(first + i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]


def row_losses(seqs: DataFrame, keep: list[str], model: np.ndarray, ignore_id: int = LOSS_IGNORE_ID) -> DataFrame:
    """(keep..., _num, _den): each row's masked loss under a dense model, and its loss positions (A1, A2).

    Positions are looked up inside their row; only two numbers a row leave the task.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in seqs.select(*keep).schema.fields)
    table = model.copy()
    if 0 <= ignore_id < len(table):
        table[:, ignore_id] = 0.0

    def run(batches):
        for batch in _parts(batches):
            x, y, m = _flat(batch, len(keep))
            on = m == 1
            loss = np.zeros(len(x))
            loss[on] = table[x[on], y[on]]
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(len(keep))), 0).to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            num, den = (np.concatenate([[0], np.cumsum(v)]) for v in (loss, on.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(num[ends] - num[starts]), pa.array(den[ends] - den[starts])],
                                             names=[*keep, "_num", "_den"])

    return seqs.select(*keep, "x", "y", "loss_mask").mapInArrow(run, f"{fields}{', ' if fields else ''}_num double, _den long")


def ngram_nll(seqs: DataFrame, group_cols: list[str], vocab_size: int,
              ignore_id: int = LOSS_IGNORE_ID) -> DataFrame:
    """A4 (+A1, A2): add-one bigram NLL of each group's training positions.

    p(y|x) = (c(x,y) + 1) / (c(x) + V) over loss-bearing pairs.  A model of up to DENSE_CELLS cells is a dense
    array, and rows are scored in place: the shuffle carries two numbers a row, pre-summed.  Beyond, the
    positions are pre-aggregated to (group, x, y, loss weight) and joined with the model's table.
    Every group is kept: one without loss positions gets a NULL mean (A1).
    """
    model = dense_bigram_model(seqs, vocab_size)
    if model is not None:
        scored = row_losses(seqs, group_cols, model, ignore_id)
    else:
        scored = _joined_losses(seqs, group_cols, vocab_size, ignore_id)
    agg = scored.groupBy(*group_cols).agg(F.sum("_num").alias("_num"), F.sum("_den").alias("_den"))
    mean = F.try_divide(F.col("_num"), F.col("_den").cast("double"))
    return agg.select(*group_cols, F.col("_den").cast("long").alias("loss_tokens"),
                      F.round(mean, 6).alias("mean_nll"), F.round(F.exp(mean), 6).alias("perplexity"))


def _joined_losses(seqs: DataFrame, group_cols: list[str], vocab_size: int, ignore_id: int) -> DataFrame:
    """(group..., _num, _den) by joins, for vocabularies of any size."""
    pos = cut_lineage(_positions(seqs, group_cols).groupBy(*group_cols, "x", "y").agg(F.sum("m").alias("m")))
    pairs = pos.groupBy("x", "y").agg(F.sum("m").alias("n")).where(F.col("n") > 0)
    ctx = pairs.groupBy("x").agg(F.sum("n").alias("cx"))
    model = pairs.join(ctx, "x").select("x", "y", (-F.ln((F.col("n") + 1) / (F.col("cx") + vocab_size))).alias("nll"))
    unseen = -F.ln(1.0 / (F.coalesce(F.col("cx"), F.lit(0)) + vocab_size))
    scored = pos.join(model, ["x", "y"], "left").join(ctx, "x", "left") \
        .select(*group_cols, "y", "m", F.coalesce(F.col("nll"), unseen).alias("nll"))
    loss = ignore_index(F.col("nll"), F.col("y"), ignore_id)
    return scored.select(*group_cols, (loss * F.col("m")).alias("_num"), F.col("m").alias("_den"))
