"""Operator 1: mixing sources to target weights by Pfair scheduling [native].

A source's rows are cut into blocks.  Block k (from 1) of a source with weight w
has release time floor((k - 1) / w) and deadline ceil(k / w), counted in block
slots; each slot takes the released block with the earliest deadline.  Every block
then lies inside its own window, so in any prefix of the mix a source is less than
one block away from its target.

The weights are rounded to shares of a period of 64 slots a source (1000 at least), each to less than
a slot.  The schedule repeats with that period, so only one period is simulated (on the driver, from the
weights alone); the slot of any block follows from its rank by arithmetic.  The bound of one block
holds exactly against the rounded shares, and against the weights within a period.  A row's
rank within its source is its place in a seeded order of the ids: the rank within a
hash bucket plus the sizes of the buckets before it, so that a source with a third of
all rows is spread over all buckets and never meets in one task.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16
PERIOD, SLOTS = 1000, 64
BUCKETS = 4096  # three hex digits of the order key


def period_of(weights: dict) -> int:
    """Slots in a period: SLOTS for each source of positive weight, PERIOD at least."""
    return max(PERIOD, SLOTS * sum(w > 0 for w in weights.values()))


def shares(weights: dict, period: int | None = None) -> dict:
    """Whole slots per period for each source of positive weight: its part of the period, by largest remainder.

    A source whose part is below one slot gets one; sources with the most over their part give it up.
    """
    period = period or period_of(weights)
    use = {s: w for s, w in weights.items() if w > 0}
    total = sum(use.values())
    exact = {s: w / total * period for s, w in use.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(use, key=lambda s: (out[s] - exact[s], s is not None, s))
    missing = period - sum(out.values()) if use else 0
    for s in by_rest[: max(missing, 0)]:
        out[s] += 1
    while missing < 0:
        for s in [s for s in reversed(by_rest) if out[s] > 1][: -missing]:
            out[s] -= 1
            missing += 1
    return out


def period_slots(share: dict, period: int) -> dict:
    """For each source the slots of its blocks in one period: earliest deadline first among released blocks."""
    slots: dict = {s: [] for s in share}
    order = sorted(share, key=lambda s: (s is not None, s))
    waiting = [(0, i) for i in range(len(order))]  # (release, source) of the next blocks
    ready: list = []  # (deadline, source)
    for t in range(period if share else 0):
        while waiting and waiting[0][0] <= t:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(len(slots[order[i]]) + 1) * period // share[order[i]]), i))
        i = heapq.heappop(ready)[1]
        own = slots[order[i]]
        own.append(t)
        if len(own) < share[order[i]]:
            heapq.heappush(waiting, (len(own) * period // share[order[i]], i))
    return slots


def temperature_weights(docs: DataFrame, source_col: str = "source", power: float = 0.5) -> dict:
    """Target weights proportional to rows ** power (one number per source reaches the driver)."""
    return {r[0]: r[1] ** power for r in docs.groupBy(source_col).count().collect()}


_ADDED = ["block", "release", "deadline", "slot", "slot_offset"]


def _placed(docs: DataFrame, weights: dict, id_col: str, source_col: str, block_rows: int, period: int | None,
            seed: int) -> DataFrame:
    """``docs`` plus the five figures as columns _m_block, ... (see ``mix``)."""
    period = period or period_of(weights)
    slots = period_slots(shares(weights, period), period)
    kind = docs.schema[source_col].dataType
    # one literal, however many sources
    text = json.dumps([{"s": None if s is None else str(s), "v": v} for s, v in slots.items()])
    table = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<s: string, v: array<int>>>"))) \
        .select(F.col("s").cast(kind).alias("_m_source"), F.col("v").alias("_m_slots"))
    columns = docs.columns
    text_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    keyed = docs.withColumn("_m_order", F.md5(F.concat(F.lit(f"{seed}:"), text_id))) \
        .withColumn("_m_bucket", F.conv(F.substring("_m_order", 1, 3), 16, 10).cast("int"))
    sizes = keyed.groupBy(source_col, "_m_bucket").agg(F.count("*").alias("_n"))
    # at most BUCKETS rows per source
    before = Window.partitionBy(source_col).orderBy("_m_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(source_col).alias("_s"), F.col("_m_bucket").alias("_b"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(source_col, "_m_bucket").orderBy("_m_order", F.xxhash64(*columns))
    ranked = keyed.withColumn("_m_rank", F.row_number().over(within))
    ranked = ranked.join(sizes, F.col(source_col).eqNullSafe(F.col("_s")) & (F.col("_m_bucket") == F.col("_b"))) \
        .withColumn("_m_rank", F.col("_before") + F.col("_m_rank") - 1)
    # one row per weighted source, a parameter of the call
    placed = ranked.join(F.broadcast(table), F.col(source_col).eqNullSafe(F.col("_m_source")), "left")
    placed = placed.withColumn("_m_share", F.when(F.col("_m_slots").isNotNull(), F.size("_m_slots").cast("long"))) \
        .withColumn("_m_block", F.when(F.col("_m_share").isNotNull(), F.floor(F.col("_m_rank") / block_rows)))
    block, share = F.col("_m_block"), F.col("_m_share")
    return placed.select(
        *columns, "_m_block",
        F.floor(block * period / share).alias("_m_release"),
        F.ceil((block + 1) * period / share).alias("_m_deadline"),
        (F.floor(block / share) * period + F.get("_m_slots", (block % share).cast("int"))).alias("_m_slot"),
        F.when(block.isNotNull(), F.col("_m_rank") % block_rows).alias("_m_slot_offset"))


def mix(docs: DataFrame, weights: dict, id_col: str = "doc_id", source_col: str = "source",
        block_rows: int = BLOCK_ROWS, period: int | None = None, seed: int = 0) -> DataFrame:
    """All rows and columns of ``docs`` plus block, release, deadline, slot and slot_offset (long).

    Ordering by (slot, slot_offset) gives the mix.  No row is dropped or repeated: a
    source that runs out leaves its later slots empty.  Within a source, rows come in
    the order of md5(seed:id), a null id counting as empty text; rows with the same id
    are ordered by a hash of all their columns (equal rows are interchangeable).  A
    null source is a source of its own.  Rows of a source without a positive weight
    get null in all five columns and belong after the mix.  Columns of ``docs``
    that carry one of the five names are replaced.  An empty table gives no rows.
    """
    placed = _placed(docs, weights, id_col, source_col, block_rows, period, seed)
    return placed.select(*[c for c in docs.columns if c not in _ADDED], *[F.col(f"_m_{c}").alias(c) for c in _ADDED])


def in_mix_order(docs: DataFrame, weights: dict, id_col: str = "doc_id", source_col: str = "source",
                 block_rows: int = BLOCK_ROWS, period: int | None = None, seed: int = 0) -> DataFrame:
    """The rows and columns of ``docs``, globally sorted into the mix (see ``mix``).

    Written out, the files in order of their names hold the mix.
    """
    placed = _placed(docs, weights, id_col, source_col, block_rows, period, seed)
    return placed.orderBy(F.col("_m_slot").asc_nulls_last(), "_m_slot_offset").select(*docs.columns)
