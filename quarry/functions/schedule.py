"""Per-step plan arithmetic (B6, B7, B8) and a deterministic uniform draw."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.constants import LOG_INTERVAL, MIN_LR_DIVISOR, SAVE_INTERVAL, SNAPSHOT_INTERVAL


def uniform(key: Column) -> Column:
    """Deterministic U[0,1) from a string key: first 32 bits of md5 / 2^32."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / 4294967296.0


def lr_at(it: Column, total: Column, base: float, warmup: int) -> Column:
    """Linear warmup, cosine decay base -> base/10, then base/10 beyond ``total``.

    Undefined when total == warmup at it == total (0/0): NULL.
    """
    min_lr = base / MIN_LR_DIVISOR
    it_d = it.cast("double")
    warm = F.lit(base) * it_d / warmup if warmup > 0 else F.lit(None).cast("double")
    ratio = F.try_divide(it_d - warmup, (total - warmup).cast("double"))
    cosine = F.lit(min_lr) + F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * ratio)) * (base - min_lr)
    return (F.when(it < warmup, warm).when(it > total, F.lit(min_lr)).otherwise(cosine))


def is_update_step(step: Column, accum: int) -> Column:
    """The optimizer steps when (step + 1) % accum == 0 (step restarts each epoch)."""
    return (step + 1) % accum == 0


def event_flags(step: Column, log_interval: int = LOG_INTERVAL, save_interval: int = SAVE_INTERVAL,
                snapshot_interval: int = SNAPSHOT_INTERVAL) -> list[Column]:
    """Log / save / snapshot flags of a step."""
    return [(step % log_interval == 0).alias("is_log"), ((step + 1) % save_interval == 0).alias("is_save"),
            ((step + 1) % snapshot_interval == 0).alias("is_snapshot")]
