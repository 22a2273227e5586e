"""Ordering, batching and plan tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.constants import ACCUMULATION_STEPS, BATCH_SIZE, SEED
from quarry.functions.schedule import is_update_step
from quarry.operators.index import with_row_index


def replicate_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Each row once per epoch (narrow explode, no join)."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))) \
             .withColumn("epoch", F.col("epoch").cast("int"))


def shuffle_key(key: Column, epoch: Column, seed: int = SEED) -> Column:
    """B1 sort key: md5 of 'key:epoch:seed' (same hex in DuckDB)."""
    return F.md5(F.concat_ws(":", key.cast("string"), epoch.cast("string"), F.lit(str(seed))))


def seeded_shuffle(df: DataFrame, key_col: str, seed: int = SEED, epoch_col: str = "epoch",
                   name: str = "pos") -> DataFrame:
    """B1: a full, reproducible shuffle per epoch: ``pos`` is the row's place in its epoch.

    Range-partitioned sort on the md5 key (no single-partition window).
    """
    if epoch_col not in df.columns:
        df = df.withColumn(epoch_col, F.lit(0))
    keyed = df.withColumn("_sk", shuffle_key(F.col(key_col), F.col(epoch_col), seed))
    return with_row_index(keyed, ["_sk", key_col], name, group_cols=[epoch_col]).drop("_sk")


def assign_batches(df: DataFrame, batch_size: int = BATCH_SIZE, pos_col: str = "pos") -> DataFrame:
    """B2: step = pos div batch_size, slot = pos mod batch_size (last partial batch kept)."""
    return df.withColumn("step", F.floor(F.col(pos_col) / batch_size).cast("long")) \
             .withColumn("slot", (F.col(pos_col) % batch_size).cast("long"))


def batch_lengths(n: int, batch_size: int) -> tuple[int, int]:
    """(steps per epoch, size of the last batch)."""
    steps = -(-n // batch_size)
    return steps, n - (steps - 1) * batch_size if steps else 0


def device_shards(df: DataFrame, devices: int, n: int, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Split each batch into contiguous parts of ceil(len/devices) slots (len is the
    batch's actual size, smaller for the last batch)."""
    steps, last = batch_lengths(n, batch_size)
    blen = F.when(F.col("step") == steps - 1, F.lit(last)).otherwise(F.lit(batch_size))
    part = F.ceil(blen / devices)
    return df.withColumn("device", F.floor(F.col("slot") / part).cast("long"))


def write_shards(rows: DataFrame, path: str, shard_col: str = "device") -> None:
    """B4 on write: one directory per shard, so that a worker reads only its own."""
    rows.repartition(shard_col, *[c for c in ("step",) if c in rows.columns]) \
        .write.mode("overwrite").partitionBy(shard_col).parquet(path)


def collate(df: DataFrame, cols: list[str], group_cols: tuple = ("epoch", "step")) -> DataFrame:
    """Stack the rows of each batch in slot order (one group = one batch, bounded)."""
    agg = df.groupBy(*group_cols).agg(F.sort_array(F.collect_list(F.struct("slot", *cols))).alias("_rows"))
    return agg.select(*group_cols, *[F.transform("_rows", _field(c)).alias(c) for c in cols])


def _field(name: str):
    return lambda r: r[name]


def update_groups(steps: DataFrame, accum: int = ACCUMULATION_STEPS, step_col: str = "step") -> DataFrame:
    """Update flag and accumulation group of each step."""
    return steps.withColumn("is_update", is_update_step(F.col(step_col), accum)) \
                .withColumn("update_group", F.floor(F.col(step_col) / accum).cast("long"))


def eta_minutes(events: DataFrame, run_col: str = "user_id", ts_col: str = "ts",
                tie_col: str = "event_id", log_interval: int | None = None) -> DataFrame:
    """ETA in minutes at each step of a run:
    floor(elapsed / (step + 1) * steps / 60) - floor(elapsed / 60).

    step = position of the event in its run (S8 per group: a hot run is spread
    over many range partitions); first timestamp and step count come from a
    partial aggregate per run, not from a per-run window.
    """
    indexed = with_row_index(events.select(run_col, ts_col, tie_col), [ts_col, tie_col], "step",
                             group_cols=[run_col])
    stats = events.groupBy(run_col).agg(F.min(ts_col).alias("_t0"), F.count("*").alias("steps"))
    j = indexed.join(stats, run_col)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))  # noqa: E731  (NTZ or LTZ input)
    elapsed = (micros(ts_col) - micros("_t0")).cast("double") / 1e6
    eta = (F.floor(elapsed / (F.col("step") + 1) * F.col("steps") / 60) - F.floor(elapsed / 60)).cast("long")
    out = j.select(run_col, tie_col, F.col("step").cast("long").alias("step"), "steps",
                   F.round(elapsed, 6).alias("elapsed_s"), eta.alias("eta_min"))
    if log_interval:
        out = out.where(F.col("step") % log_interval == 0)
    return out
