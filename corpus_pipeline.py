"""Corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function) in order.  Each function takes
(spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read back as the next stage's ``docs``.  All but the last return the columns of
``documents``; columns that ``docs`` has besides are dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.llm.line_templates import drop_recurring_lines
from quarry.llm.minhash_dedup import drop_near_duplicates
from quarry.llm.mixing import in_mix_order, temperature_weights
from quarry.llm.packing import pack
from quarry.llm.queries import tokenizer_path, toxicity_model
from quarry.llm.toxicity import drop_toxic
from quarry.session import ensure_checkpoint_dir
from quarry.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark, docs, sf_dir):
    """Documents with a toxicity of 0.5 or more go; null and empty texts are scored like others."""
    docs = docs.select(*COLUMNS)
    return drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark, docs, sf_dir):
    """Lines of recurring templates go; all documents stay, n_chars counts the text that is left.

    Null and empty texts pass unchanged (a null text keeps its n_chars); equal rows are cut alike; no rows give none.
    """
    cut = drop_recurring_lines(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long"))
                          .otherwise(F.col("n_chars")))


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate group stays (five-word shingles, Jaccard >= 0.8).

    Texts without words are in no group and stay; no rows give none.
    """
    return drop_near_duplicates(docs.select(*COLUMNS))


def mixing(spark, docs, sf_dir):
    """All documents, in files sorted into a mix with sources weighted by the square root of their rows.

    A null source is a source of its own; repeated and null ids keep their rows; no rows give none.
    """
    docs = docs.select(*COLUMNS)
    return in_mix_order(docs, temperature_weights(docs))


def packing(spark, docs, sf_dir):
    """Pieces of the documents in sequences of at most 2048 tokens.

    A task packs the runs of the mix that it reads; which runs those are, Spark's reader decides by file
    size.  Null and empty texts are their end token alone; no rows give none.
    """
    return pack(docs.select(*COLUMNS), tokenizer_path())


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]

#: The network and the tokenizer cannot be expressed in SQL; the tests check each stage instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to ``documents``; each result goes through Parquet in the checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
