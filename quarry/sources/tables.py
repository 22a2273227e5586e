"""Reading the parquet tables and deriving the raw conversation form."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_turns(conversations: DataFrame) -> DataFrame:
    """Long conversation rows -> raw turn rows with a ``from`` field.

    user -> human; assistant -> gpt on odd conv_id, else assistant; other roles
    keep their name.  This exercises every branch of the role mappings.
    """
    return conversations.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", "human")
        .when(F.col("role") == "assistant",
              F.when(F.col("conv_id") % 2 == 1, "gpt").otherwise("assistant"))
        .otherwise(F.col("role")).alias("from"),
        F.col("text").alias("value"))
