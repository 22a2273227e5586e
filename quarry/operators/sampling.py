"""Grouped sampling over a next-token table.

Input rows are (ctx, token, logit).  A context's candidates are bounded by
the vocabulary size, so per-context windows hold at most V rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.constants import SEED
from quarry.functions.schedule import uniform


def greedy(df: DataFrame, by: str = "ctx", token: str = "token", logit: str = "logit") -> DataFrame:
    """G1: temperature 0 -> argmax logit per group; ties go to the lowest token id."""
    best = F.max_by(F.col(token), F.struct(F.col(logit), -F.col(token)))
    return df.groupBy(by).agg(best.alias(token))


def top_k_with_ties(df: DataFrame, k: int, by: str = "ctx", logit: str = "logit") -> DataFrame:
    """Keep candidates not strictly below the k-th largest logit (k capped at the group size)."""
    w = Window.partitionBy(by).orderBy(F.desc(logit))
    return df.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= k).drop("_r")


def temperature_softmax(df: DataFrame, t: float, by: str = "ctx", logit: str = "logit",
                        out: str = "p") -> DataFrame:
    """softmax(logit / t) within each group (max-shifted for stability)."""
    w = Window.partitionBy(by)
    z = F.exp((F.col(logit) - F.max(logit).over(w)) / t)
    return df.withColumn("_z", z).withColumn(out, F.col("_z") / F.sum("_z").over(w)).drop("_z")


def seeded_draw(df: DataFrame, by: str = "ctx", token: str = "token", p: str = "p",
                seed: int = SEED) -> DataFrame:
    """One reproducible draw per group: the first token (in id order) whose running
    probability reaches u = uniform(md5('ctx:seed'))."""
    w = Window.partitionBy(by).orderBy(token).rowsBetween(Window.unboundedPreceding, 0)
    u = uniform(F.concat_ws(":", F.col(by).cast("string"), F.lit(str(seed))))
    run = df.withColumn("_c", F.sum(p).over(w)).withColumn("_u", u)
    # numerical slack: if rounding leaves the total below u, the last token is drawn
    first_hit = F.min(F.when(F.col("_c") >= F.col("_u"), F.col(token)))
    return run.groupBy(by).agg(F.coalesce(first_hit, F.max(token)).alias(token))
