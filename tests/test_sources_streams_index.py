import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.index import prefix_sums, record_offsets, rows_at, with_row_index
from quarry.sources.jsonl import (observe_ingest, read_json_array_lines, read_jsonl, read_jsonl_report,
                                  source_if_exists, write_jsonl)
from quarry.streaming.streams import chat_stream, chunk_stream, pack_stream, pretoken_count_stream, read_lines

LINES = ['{"text":"a"}', "", '{"x":1}', '{"text":"a"} junk', "{'text':'a'}"]


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_s1_s2(spark, tmp_path):
    p = str(tmp_path / "in.jsonl")
    _write(p, LINES)
    assert sorted(r.text for r in read_jsonl(spark, p).collect()) == ["", "a"]
    rows, rejects = read_jsonl_report(spark, p)
    assert [r.text for r in rows.collect()] == ["a"]
    got = sorted((r.line_num, r.reason) for r in rejects.collect())
    assert got == [(2, "malformed"), (3, "missing_key"), (4, "malformed"), (5, "malformed")]


def test_s3_array_lines(spark, tmp_path):
    p = str(tmp_path / "sft.json")
    conv = {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}
    _write(p, ["[", "  " + json.dumps(conv, ensure_ascii=False) + ",", json.dumps({"conversations": []}) + ",",
               json.dumps(conv), "]"])
    got = read_json_array_lines(spark, p).collect()
    assert len(got) == 2 and [t["from"] for t in got[0].conversations] == ["human", "gpt"]


def test_s6_roundtrip_and_s7(spark, tmp_path):
    df = spark.createDataFrame([("héllo\n😀",), ("x",)], "text string")
    out = str(tmp_path / "out")
    write_jsonl(df, out)
    lines = [l for f in os.listdir(out) if f.startswith("part") for l in open(os.path.join(out, f), encoding="utf-8")]
    assert sorted(json.loads(l)["text"] for l in lines) == ["héllo\n😀", "x"]
    assert all("\\u" not in l for l in lines)  # non-ASCII kept raw
    empty = source_if_exists(spark, str(tmp_path / "missing"), "text string")
    assert empty.count() == 0 and empty.columns == ["text"]


def test_s10_observe(spark, tmp_path):
    p = str(tmp_path / "in.jsonl")
    _write(p, ['{"text":"ab"}', '{"text":"é"}'])
    lines, obs = observe_ingest(spark.read.text(p))
    lines.write.format("noop").mode("overwrite").save()
    m = obs.get
    assert m["lines"] == 2 and m["bytes"] == len('{"text":"ab"}') + 1 + len('{"text":"é"}'.encode()) + 1


def test_s8_equals_row_number(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("k"), (F.col("id") % 5).alias("g"))
    got = with_row_index(df, ["k"], num_partitions=7).select("k", "idx")
    ref = df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("r"))
    assert got.join(ref, "k").where("idx <> r").count() == 0
    gg = with_row_index(df, ["k"], group_cols=["g"], num_partitions=5)
    ref2 = df.select("k", (F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).alias("r"))
    assert gg.join(ref2, "k").where("idx <> r").count() == 0 and gg.count() == 3000


def test_s9_offsets(spark):
    df = spark.createDataFrame([(i, "x" * i + "é") for i in range(50)], "k long, line string")
    got = {r.k: (r.byte_start, r.byte_end) for r in record_offsets(df, ["k"]).collect()}
    off = 0
    for i in range(50):
        n = i + 2 + 1
        assert got[i] == (off, off + n)
        off += n
    s = prefix_sums(df.withColumn("v", F.lit(2)), ["k"], {"a": "v"}).orderBy("k").collect()
    assert [r.a for r in s] == [2 * i for i in range(50)]


def test_index_offsets_and_packing_survive_a_cleared_cache(spark):
    from quarry.operators.sequences import pack_blocks
    wide = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("k"),
                                      F.concat(*[F.sha2((F.col("id") + i).cast("string"), 512) for i in range(6)]).alias("line"))
    w = Window.orderBy("k")
    index, offsets = with_row_index(wide, ["k"]), record_offsets(wide, ["k"])
    blocks = pack_blocks(wide.select("k", F.array(F.col("k").cast("int"), F.lit(0), F.lit(1)).alias("input_ids")), ["k"],
                         ["input_ids"], block_size=7, batch_size=100, ones=["attention_mask"])
    spark.catalog.clearCache()
    ref = wide.select("k", (F.row_number().over(w) - 1).alias("r"),
                      F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"))
    joined = index.join(ref, "k").join(offsets.withColumnRenamed("byte_start", "b"), "k")
    assert joined.count() == 40_000 and joined.where("idx <> r or b <> s").count() == 0
    spark.catalog.clearCache()
    got = blocks.select("batch", "block", "input_ids", "labels", "attention_mask").collect()
    assert len(got) == 400 * (300 // 7)
    keys = [r.k for r in wide.select("k").orderBy("k").collect()]
    for r in got:
        flat = [x for k in keys[r.batch * 100: r.batch * 100 + 100] for x in (k, 0, 1)]
        assert r.input_ids == flat[r.block * 7: r.block * 7 + 7] == r.labels and r.attention_mask == [1] * 7


def test_s8_null_groups_and_lookup(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, k long")
    got = {(r.g, r.k): r.idx for r in with_row_index(df, ["k"], group_cols=["g"]).collect()}
    assert got == {(None, 1): 0, (None, 3): 1, ("a", 2): 0}
    picked = rows_at(with_row_index(df, ["k"]), spark.createDataFrame([(0,), (2,), (2,), (9,)], "p long"))
    assert sorted(r.k for r in picked.collect()) == [1, 3]


def test_strict_json_rejects_tails(spark):
    from quarry.sources.jsonl import json_reason, parse_jsonl
    bad = ['{"text":"a"}] }', '{"text":"b"}],[{"x":1}', '{"text":"d"}] junk}', '{"a":1}],"x":[{"b":2}', '{"text":"a"}{"text":"b"}',
           '{"text":"a"},{"text":"b"}', "{'text':'a'}", "", " ", "[1]", "1", '"x"', '[{"text":"a"}]', '{"text":"a"} //x']
    good = ['{"text":"]}"}', ' {"text":"a"} ', '{"text":"\\"],[\\""}', '{"text":"a","y":[{"z":1}]}']
    df = spark.createDataFrame([(x,) for x in bad + good], "value string")
    assert [r.r is None for r in df.select(json_reason(F.col("value")).alias("r")).collect()] == [False] * len(bad) + [True] * len(good)
    assert sorted(r.text for r in parse_jsonl(df).collect()) == sorted(["]}", "a", '"],["', "a"])


def _stream_dir(tmp_path, lines):
    d = tmp_path / "stream_in"
    d.mkdir()
    _write(str(d / "part-0.jsonl"), lines)
    return str(d)


def test_v1_v3_stream_equals_batch(spark, tmp_path):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect()]
    d = _stream_dir(tmp_path, [json.dumps({"text": t}, ensure_ascii=False) for t in docs])
    q = chunk_stream(read_lines(spark, d)).writeStream.format("memory").queryName("v1_chunks") \
        .option("checkpointLocation", str(tmp_path / "ck1")).trigger(availableNow=True).start()
    q.awaitTermination()
    streamed = sorted(r.text for r in spark.sql("select text from v1_chunks").collect())
    batch = sorted(t[i:i + 512] for t in docs for i in range(0, len(t), 512))
    assert streamed == batch
    q3 = pretoken_count_stream(read_lines(spark, d)).writeStream.format("memory").queryName("v3_counts") \
        .outputMode("complete").option("checkpointLocation", str(tmp_path / "ck3")).trigger(availableNow=True).start()
    q3.awaitTermination()
    from quarry.operators.tokenizer import pretoken_counts
    ref = {r.word: r.freq for r in pretoken_counts(spark.createDataFrame([(t,) for t in docs], "text string")).collect()}
    assert {r.word: r.freq for r in spark.sql("select * from v3_counts").collect()} == ref


def test_v2_v4(spark, tmp_path):
    conv = {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}
    d = _stream_dir(tmp_path, ["[", json.dumps(conv) + ",", json.dumps(conv), "]"])
    q = chat_stream(read_lines(spark, d), render=True).writeStream.format("memory").queryName("v2_chat") \
        .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [r.text for r in spark.sql("select text from v2_chat").collect()]
    assert len(got) == 2 and got[0].endswith("<|im_start|>assistant\na<|im_end|>\n")
    d4 = tmp_path / "v4_in"
    d4.mkdir()
    _write(str(d4 / "a.jsonl"), [json.dumps({"text": "abcdefghij"}), json.dumps({"text": "klm"})])
    out = str(tmp_path / "v4_out")
    q4 = pack_stream(read_lines(spark, str(d4)), out, block_size=4, checkpoint=str(tmp_path / "ck4"))
    q4.awaitTermination()
    blocks = spark.read.parquet(out).collect()
    assert sorted(len(r.input_ids) for r in blocks) == [4, 4, 4]  # 13 ids -> 3 blocks of 4
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    # a stopped stream goes on with new files only; the first micro-batch's output stays
    first = sorted(map(tuple, spark.read.parquet(out).select("micro_batch", "block", "input_ids").collect()))
    _write(str(d4 / "b.jsonl"), [json.dumps({"text": "nopqrstu"})])
    pack_stream(read_lines(spark, str(d4)), out, block_size=4, checkpoint=str(tmp_path / "ck4")).awaitTermination()
    again = sorted(map(tuple, spark.read.parquet(out).select("micro_batch", "block", "input_ids").collect()))
    assert again[:3] == first and [r[0] for r in again] == [0, 0, 0, 1, 1]


def test_v3_writes_changed_words_only_and_restarts(spark, tmp_path):
    from quarry.streaming.streams import latest_counts, write_changed_counts
    d, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    d.mkdir()

    def run():
        write_changed_counts(pretoken_count_stream(read_lines(spark, str(d), 1)), out, ck).awaitTermination()
        return {(r.micro_batch, r.word): r.freq for r in spark.read.parquet(out).collect()}

    _write(str(d / "a.jsonl"), [json.dumps({"text": "one two three four five six seven"})])
    first = run()
    assert len(first) == 7
    _write(str(d / "b.jsonl"), [json.dumps({"text": "one two"})])
    second = run()  # a restart: the first micro-batch's rows stay, the second has the two changed words
    assert {k: v for k, v in second.items() if k[0] == 0} == first
    assert {k: v for k, v in second.items() if k[0] != 0} == {(1, "one"): 2, (1, " two"): 2}
    assert {r.word: r.freq for r in latest_counts(spark, out).collect()} == {w: 1 + (w in ("one", " two")) for _, w in first}
    assert run() == second  # nothing new, nothing written


def test_s10_listener_stores_a_row_per_micro_batch(spark, tmp_path):
    from quarry.sources.jsonl import observe_ingest
    from quarry.streaming.streams import IngestLog
    d = tmp_path / "in"
    d.mkdir()
    texts = [["é", ""], ["abc"], ["x" * 100, "y", "z"]]
    for i, lines in enumerate(texts):
        _write(str(d / f"{i}.txt"), lines)
    log = IngestLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    for _ in range(2):  # the second run finds nothing new and adds no rows
        lines, _ = observe_ingest(read_lines(spark, str(d), 1))
        q = lines.select("value").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        rows = log.table(q).collect()
        assert sorted(r.batch for r in rows) == [0, 1, 2]
        assert sorted((r.lines, r.bytes) for r in rows) == sorted((len(x), sum(len(t.encode()) + 1 for t in x)) for x in texts)
    spark.streams.removeListener(log)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "loss_share" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_s4_read_json_files(spark, tmp_path):
    from quarry.sources.jsonl import read_json_files
    a, b = str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")
    _write(a, ['{"text":"x","n":1}'])
    _write(b, ['{"text":"y","n":2}', '{"text":"z","n":3}'])
    df = read_json_files(spark, [a, b])
    assert sorted(df.columns) == ["n", "text"] and sorted(r.text for r in df.collect()) == ["x", "y", "z"]
    typed = read_json_files(spark, [a, b], "text string")
    assert typed.columns == ["text"] and typed.count() == 3


def test_u1_map_batches_paths(spark):
    from quarry.operators.batchfn import map_batches
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))

    def grow(batch):  # output rows may differ from input rows
        return {"k": batch["k"] + batch["k"], "v": [x + 1 for x in batch["v"]] * 2}

    with pytest.raises(Exception, match="remove the columns"):
        map_batches(df.withColumn("w", F.lit(1)), grow, "k long, v long", exact=False).collect()
    free = map_batches(df.withColumn("w", F.lit(1)), grow, "k long, v long", exact=False, remove_columns=["w"])
    assert free.count() == 20 and sorted(r.v for r in free.collect())[:2] == [1, 1]

    def sizes(batch):
        n = len(batch["k"])
        return {"k": batch["k"], "size": [n] * n}

    exact = map_batches(df, sizes, "k long, size long", ["k"], batch_size=4)
    assert exact.columns == ["v", "k", "size"]  # columns that are not removed pass through
    assert sorted((r.k, r.v, r["size"]) for r in exact.collect()) == [(i, 2 * i, 4 if i < 8 else 2) for i in range(10)]

    def shapes(batch):  # removed columns are inputs all the same
        return {"s": [{"a": k, "b": [str(v)]} for k, v in zip(batch["k"], batch["v"])], "d": batch["v"]}

    for mode in (True, False):
        out = map_batches(df, shapes, "s struct<a:int,b:array<string>>, d bigint", ["k"], remove_columns=["v"], exact=mode)
        assert out.columns == ["k", "s", "d"]
        assert all((r.s.a, r.s.b, r.d) == (r.k, [str(2 * r.k)], 2 * r.k) for r in out.collect())


def test_a_line_is_parsed_once(spark):
    from quarry.sources.jsonl import parse_jsonl
    lines = ['{"text":"a"}', '{"text":1}', '{"x":2}', '{"text":null}', "[1]", "{", "", '{"text":"a"} x', '{"text":"b"} ', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    out = parse_jsonl(df, missing="none", keep=["i"])
    assert out.columns == ["i", "text"]
    assert {r.i: r.text for r in out.collect()} == {0: "a", 2: "none", 8: "b"}
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("parse") == 1


def _line_dirs(tmp_path, files):
    d = tmp_path / "v4_lines"
    d.mkdir()
    for i, texts in enumerate(files):
        _write(str(d / f"{i:02d}.jsonl"), [json.dumps({"text": t}, ensure_ascii=False) for t in texts])
    return str(d)


def test_pack_stream_neither_caches_nor_stores_ids(spark, tmp_path, monkeypatch):
    frames = type(spark.range(0))
    seen = []
    for name in ("persist", "checkpoint"):
        def spied(self, *a, _name=name, _f=getattr(frames, name), **k):
            seen.append((_name, dict(self.dtypes)))
            return _f(self, *a, **k)
        monkeypatch.setattr(frames, name, spied)
    path = _line_dirs(tmp_path, [["abcdefghij", "klm"], ["nop"]])
    out = str(tmp_path / "v4_out")
    pack_stream(read_lines(spark, path), out, block_size=4, checkpoint=str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    assert [k for k, _ in seen].count("checkpoint") > 0
    assert not [t for _, t in seen if "array<int>" in t.values()]
    assert not [t for k, t in seen if k == "persist" and {"text", "value"} & t.keys()]


def test_pack_stream_over_many_runs_equals_loop(spark, tmp_path):
    import random

    from quarry.functions.encode import encode
    rnd = random.Random(5)
    words = ["a", "bcd", "\u00e9\ufb01", "<|im_end|>", "x" * 50, "x" * 700, "", "\u65e5\u672c"]
    files = [[" ".join(rnd.choices(words, k=rnd.choice([0, 1, 4, 9]))) for _ in range(n)] for n in (12, 0, 1, 30, 3, 1)]
    files.append([""])
    path = _line_dirs(tmp_path, files)
    texts = [(i, t) for i, t in enumerate(t for f in files for t in f)]
    ids = spark.createDataFrame(texts, "k int, t string").select("k", encode(F.col("t")).alias("ids")).orderBy("k").collect()
    flat = [x for r in ids for x in r.ids]
    sized = {"spark.sql.files.maxPartitionBytes": "3k", "spark.sql.files.openCostInBytes": "500"}
    old = {k: spark.conf.get(k) for k in sized}
    try:
        for k, v in sized.items():
            spark.conf.set(k, v)
        for block, whole in ((7, True), (64, True), (len(flat) + 1, True), (64, False)):
            lines = read_lines(spark, path)
            lines = lines if whole else lines.repartition(3)  # file parts lie anywhere: their order is free within a part
            out = str(tmp_path / f"out-{block}-{whole}")
            pack_stream(lines, out, block_size=block, checkpoint=f"{out}-ck").awaitTermination()
            got = spark.read.parquet(out).orderBy("block").collect()
            want = [flat[k: k + block] for k in range(0, len(flat) // block * block, block)] or [flat]
            assert [(r.shard, r.batch, r.block) for r in got] == [(0, 0, k) for k in range(len(want))]
            assert all(r.labels == r.input_ids and r.attention_mask == [1] * len(r.input_ids) for r in got)
            if whole:
                assert [r.input_ids for r in got] == want
            else:
                assert [len(r.input_ids) for r in got] == [len(w) for w in want]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
