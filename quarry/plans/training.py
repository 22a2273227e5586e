"""The training plan — epochs, seeded shuffle, batches, devices, accumulation,
learning rate and event flags, with token counts per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.constants import ACCUMULATION_STEPS, BATCH_SIZE, LEARNING_RATE, SEED
from quarry.functions.schedule import event_flags, lr_at
from quarry.operators.batching import (assign_batches, batch_lengths, device_shards, replicate_epochs,
                                       seeded_shuffle, update_groups)
from quarry.operators.scoring import mask_ones
from quarry.session import cut_lineage


def plan_rows(seqs: DataFrame, key_col: str, epochs: int = 1, batch_size: int = BATCH_SIZE,
              devices: int = 1, seed: int = SEED) -> tuple[DataFrame, int]:
    """Per (row, epoch): pos, step, slot, device.  Returns the rows and n."""
    n = seqs.count()
    rows = seeded_shuffle(replicate_epochs(seqs, epochs), key_col, seed)
    rows = assign_batches(rows, batch_size)
    return device_shards(rows, devices, n, batch_size), n


def training_plan(seqs: DataFrame, key_col: str, epochs: int = 1, batch_size: int = BATCH_SIZE,
                  devices: int = 1, accum: int = ACCUMULATION_STEPS, base_lr: float = LEARNING_RATE,
                  warmup: int = 0, seed: int = SEED, mask_col: str = "loss_mask") -> DataFrame:
    """Rows per (epoch, step): n_rows, loss_tokens, global_step, lr, update and event flags."""
    # only the row's loss-token count travels through the shuffles, not its arrays
    slim = cut_lineage(seqs.select(key_col, mask_ones(F.col(mask_col)).alias("_lt")))
    rows, n = plan_rows(slim, key_col, epochs, batch_size, devices, seed)
    steps, _ = batch_lengths(n, batch_size)
    per_step = rows.groupBy("epoch", "step").agg(F.count("*").alias("n_rows"),
                                                 F.sum("_lt").cast("long").alias("loss_tokens"))
    gs = (F.col("epoch") * steps + F.col("step")).cast("long")
    per_step = update_groups(per_step.withColumn("global_step", gs), accum)
    return per_step.select("epoch", "step", "global_step", "n_rows", "loss_tokens",
                           F.round(lr_at(F.col("global_step"), F.lit(epochs * steps), base_lr, warmup), 12).alias("lr"),
                           "is_update", "update_group", *event_flags(F.col("step")))
