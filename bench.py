"""Headline-query benchmark.

Runs the main operators on the tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line.  Each
query is forced to completion with the no-op sink (full execution, nothing
collected).  Every query first runs once on the smallest tables (JVM class
loading, code generation and Python worker start-up are then not timed), and
the cache is cleared after each query so that queries do not share memory.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quarry.session import get_session  # noqa: E402


COPIES = 40


class Prepared:
    """A query whose input files are written first; calling it with a session gives the query itself."""

    def __init__(self, prepare):
        self.prepare = prepare


def build(sf: str):
    from quarry.operators.file_index import file_line_offsets
    from quarry.operators.batching import eta_minutes
    from quarry.operators.chunk import split_text
    from quarry.operators.index import record_offsets
    from quarry.operators.scoring import mask_accounting, ngram_nll
    from quarry.operators.sequences import pack_blocks
    from quarry.operators.tokenizer import merges_table, pretoken_counts, train_bpe
    from quarry.plans import catalog
    from quarry.functions.encode import encode
    from quarry.plans.pretrain import pretrain_sequences
    from quarry.plans.sft import sft_sequences
    from quarry.plans.training import training_plan
    from quarry.plans.turn_labels import turn_label_sequences
    from quarry.sources.tables import table

    def docs(spark):
        return table(spark, sf, "documents")

    def chunks(spark):
        return split_text(docs(spark).select("doc_id", "lang", "text"))

    def line_files(spark):
        """The lines of all chunks, COPIES times over, as text files; written before the clock starts."""
        from quarry.session import ensure_checkpoint_dir
        path = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
        line = F.translate("text", "\n", " ").alias("value")
        chunks(spark).select(line, F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).select("value").write.text(path)
        return lambda: file_line_offsets(spark, path)

    def packed(spark):
        c = chunks(spark).select("doc_id", "chunk_idx", encode(F.col("text")).alias("input_ids"))
        return pack_blocks(c, ["doc_id", "chunk_idx"], ["input_ids"], ones=["attention_mask"])

    def plan(spark):
        s = pretrain_sequences(chunks(spark).select(F.concat_ws(":", "doc_id", "chunk_idx").alias("key"), "text"))
        return training_plan(s, "key", epochs=2, batch_size=64)

    return {
        "t1_split_text": lambda s: chunks(s),
        "q12_pretrain_sequences": lambda s: pretrain_sequences(chunks(s)),
        "a3_mask_accounting": lambda s: mask_accounting(pretrain_sequences(chunks(s).select("lang", "text")), ["lang"]),
        "q13_sft_sequences": lambda s: sft_sequences(table(s, sf, "conversations")),
        "q14_turn_label_sequences": lambda s: turn_label_sequences(table(s, sf, "conversations")),
        "q8_pack_blocks": packed,
        "s9_record_offsets": lambda s: record_offsets(chunks(s).select("doc_id", "chunk_idx", F.col("text").alias("line")),
                                                      ["doc_id", "chunk_idx"]),
        f"s9_file_offsets_{COPIES}_copies": Prepared(line_files),
        "b9_training_plan": plan,
        "b10_eta": lambda s: eta_minutes(table(s, sf, "events")),
        "a4_ngram_nll": lambda s: ngram_nll(pretrain_sequences(chunks(s).select("lang", "text")), ["lang"], 261),
        "k1_pretoken_counts": lambda s: pretoken_counts(docs(s)),
        f"k3_train_bpe_{catalog.MERGES}_merges": lambda s: merges_table(
            s, train_bpe(docs(s).select("text"), vocab_size=261 + catalog.MERGES)),
        "k3_train_bpe_vocabulary_2000": lambda s: merges_table(s, train_bpe(docs(s).select("text"), vocab_size=2000)),
    }


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = get_session(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=int(cpus) * 2)
    queries = build(sf)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm = build(warm_dir) if os.path.isdir(warm_dir) else {}
    times = {}
    for name, q in queries.items():
        if only and name not in only:
            continue
        if name in warm and not name.startswith("k3_"):  # k3 shares its code paths with k1
            w = warm[name]
            (w.prepare(spark)() if isinstance(w, Prepared) else w(spark)).write.format("noop").mode("overwrite").save()
            spark.catalog.clearCache()
        ready = q.prepare(spark) if isinstance(q, Prepared) else lambda q=q: q(spark)
        t0 = time.perf_counter()
        ready().write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    scale = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_time_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
