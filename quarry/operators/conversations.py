"""Long-form conversation operators that never hold a whole conversation in one task.

A conversation's first turns are picked by a ranked window with a limit: every task cuts
its part of a conversation to the limit before rows move, so one exchange carries at most the limit a task
for a hot conversation, and the groups that follow stand in that exchange's partitions.
The first turn, counts and lengths of each conversation come from partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_ranked(turns: DataFrame, bound: int) -> DataFrame:
    """The first ``bound`` turns of each conversation, in turn order; rows stay together by conversation."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.withColumn("_place", place).where(F.col("_place") <= bound).drop("_place")


def first_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, first_turn, first_from): the earliest turn of each conversation."""
    first = F.min_by(F.struct("turn", "from"), F.col("turn"))
    return turns.groupBy("conv_id").agg(first.alias("_f")).select(
        "conv_id", F.col("_f.turn").alias("first_turn"), F.col("_f.from").alias("first_from"))


def drop_leading_non_human_rows(turns: DataFrame) -> DataFrame:
    """C4 in long form: drop exactly the first turn of a conversation when it is not from a human."""
    f = first_turns(turns)
    j = turns.join(f, "conv_id")
    return j.where(~((F.col("turn") == F.col("first_turn")) & (F.col("first_from") != "human"))) \
        .drop("first_turn", "first_from")


def conversation_ids(turns: DataFrame) -> DataFrame:
    """Every conversation present in the raw rows (partial aggregate, skew-safe)."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_raw_turns"))
