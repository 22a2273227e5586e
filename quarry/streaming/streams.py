"""V1-V4: the same DataFrame functions on ``readStream`` input.

V1 chunking and V2 chat conversion are stateless (append mode); V3 keeps
running pre-token counts in the state store and writes the changed ones (update mode); S10's
lines and bytes of every micro-batch are stored by a query listener; V4
packs each micro-batch as one packing batch through ``foreachBatch``.
Checkpoint locations must be in the shared checkpoint folder.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quarry.constants import BLOCK_SIZE, CHAT_SYSTEM_PROMPT, CHUNK_SIZE
from quarry.functions.chat import non_empty, prepend_system, render_chat, to_messages
from quarry.functions.text import nfkc, pretokenize
from quarry.operators.chunk import split_text
from quarry.operators.sequences import ONE_BATCH, pack_blocks
from quarry.sources.jsonl import parse_json_array_lines, parse_jsonl


def read_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path).select("value", F.col("_metadata.file_path").alias("file"),
                               F.col("_metadata.file_block_start").alias("start"))


def chunk_stream(lines: DataFrame, n: int = CHUNK_SIZE) -> DataFrame:
    """V1: S1 -> T1 (stateless)."""
    return split_text(parse_jsonl(lines), "text", n, keep=[])


def chat_stream(lines: DataFrame, system_prompt: str = CHAT_SYSTEM_PROMPT, render: bool = False) -> DataFrame:
    """V2: S3 -> C3 -> C1 -> C2 (-> C6): one message array (or rendered text) per record."""
    conv = parse_json_array_lines(lines)
    msgs = prepend_system(to_messages(F.col("conversations")), system_prompt)
    out = conv.where(non_empty(F.col("conversations"))).select(msgs.alias("messages"))
    return out.select(render_chat(F.col("messages")).alias("text")) if render else out


def pretoken_count_stream(lines: DataFrame, normalize: bool = True) -> DataFrame:
    """V3: running corpus frequency of each pre-token (stateful aggregation)."""
    parsed = parse_jsonl(lines)
    t = nfkc(F.col("text")) if normalize else F.col("text")
    return parsed.select(F.explode(pretokenize(t)).alias("word")).groupBy("word") \
        .agg(F.count("*").alias("freq"))


def write_changed_counts(counts: DataFrame, out_path: str, checkpoint: str, trigger_once: bool = True):
    """V3 sink in update mode: each micro-batch writes the words whose count it changed, with their
    new counts, to its own directory (``micro_batch=<id>``); no table is rewritten.

    A restarted stream goes on after the last finished micro-batch; an unfinished one replaces its own
    directory, so the log holds every change once.  ``latest_counts`` reads it.
    """

    def upsert(batch: DataFrame, epoch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_path}/micro_batch={epoch_id}")

    w = counts.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def latest_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """(word, freq) of a log of changed counts.  Running counts only grow, so a word's latest is its greatest."""
    log = spark.read.schema("word string, freq long, micro_batch long").parquet(out_path)
    return log.groupBy("word").agg(F.max("freq").alias("freq"))


INGEST_SCHEMA = "query string, batch long, lines long, bytes long"


class IngestLog(StreamingQueryListener):
    """S10 for streams: the observed lines and bytes of every micro-batch as a table.

    Register it with ``spark.streams.addListener`` and start queries on lines that went through
    ``observe_ingest`` under ``name``.  Each micro-batch is a row in a directory of its own (query id and
    batch), so one that is run again after a restart replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "ingest"):
        self.spark, self.path, self.name = spark, path, name
        self.seen: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        got = p.observedMetrics.get(self.name)
        if got is not None and p.numInputRows:
            row = (str(p.id), p.batchId, got["lines"], got["bytes"] or 0)
            self.spark.createDataFrame([row], INGEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/of={p.id}/number={p.batchId}")
        self.seen[str(p.id)] = p.batchId

    def table(self, query, timeout: float = 60.0) -> DataFrame:
        """The rows so far, after the last micro-batch with input of ``query`` has been told (with a delay)."""
        last = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=-1)
        end = time.monotonic() + timeout
        while self.seen.get(str(query.id), -1) < last:
            if time.monotonic() > end:
                raise TimeoutError(f"no progress of batch {last} after {timeout} s")
            time.sleep(0.05)
        return self.spark.read.schema(INGEST_SCHEMA).parquet(self.path).select("query", "batch", "lines", "bytes")


def pack_stream(lines: DataFrame, out_path: str, checkpoint: str, block_size: int = BLOCK_SIZE,
                trigger_once: bool = True):
    """V4: each micro-batch of texts is tokenized and packed as one batch (Q8) into Parquet,
    one idempotent directory per micro-batch (``micro_batch=<id>``).

    ``checkpoint`` must stay the same over restarts: a restarted stream goes on after the
    last finished micro-batch, and an unfinished one replaces its own directory.  Rows
    are packed in the order of file and place if ``lines`` carries them (``read_lines`` does).
    """
    place = [c for c in ("file", "start") if c in lines.columns]
    texts = parse_jsonl(lines, keep=place)

    def pack(batch: DataFrame, epoch_id: int):
        rows = batch.withColumn("pos", F.monotonically_increasing_id())
        packed = pack_blocks(rows, [*place, "pos"], ["input_ids"], block_size, ONE_BATCH, ones=["attention_mask"], text="text")
        packed.write.mode("overwrite").parquet(f"{out_path}/micro_batch={epoch_id}")

    w = texts.writeStream.foreachBatch(pack).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
