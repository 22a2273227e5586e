import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.file_index import StoredIndex, file_line_offsets


def brute(data: bytes):
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end + 1
        out.append((len(out), at, end))
        at = end
    return out


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                          "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for k, v in zip(old, ("700", "64", "7")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_offsets_of_files_in_many_splits(spark, tmp_path, small_splits):
    """Splits inside lines, several splits a task, batches inside splits; CRLF, empty lines, bad UTF-8, open ends."""
    rng = random.Random(3)
    files = {}
    for i in range(6):
        lines = [rng.choice([b"", b"x", b"\r", "é漢".encode(), b"\xff\xfe", b"word " * rng.randrange(60)]) for _ in range(rng.randrange(1, 90))]
        files[f"f{i}.txt"] = b"\n".join(lines) + (b"\n" if i % 2 else b"")
    files["long.txt"] = b"a" * 5000 + b"\nb\n" + b"c" * 3000
    files["empty.txt"] = b""
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = file_line_offsets(spark, str(tmp_path)).collect()
    for name, data in files.items():
        mine = sorted((r.line, r.byte_start, r.byte_end) for r in got if r.file.endswith("/" + name))
        assert mine == brute(data), name
    assert len({r.file for r in got}) == 7


def test_offsets_without_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"")
    assert file_line_offsets(spark, str(tmp_path)).count() == 0


def test_offsets_need_no_sort_of_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\ny\n")
    plan = file_line_offsets(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "RepartitionByExpression" not in plan


def scanned(spark, df):
    """(files, rows) that the scans of a query read."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.collect()
        leaves, out = df._jdf.queryExecution().executedPlan().collectLeaves(), [0, 0]
        for i in range(leaves.size()):
            m = leaves.apply(i).metrics()
            if m.contains("numFiles"):
                out[0] += m.apply("numFiles").value()
                out[1] += m.apply("numOutputRows").value()
        return rows, out
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_reads_only_the_folders_of_the_positions(spark, tmp_path):
    n = 20_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("key"), F.lit("x").alias("_text")).repartition(5)
    index = StoredIndex(str(tmp_path / "i"), rows_per_part=500).write(df, ["key"])
    assert sorted((r.key, r.idx) for r in index.read(spark).collect()) == [(i, i) for i in range(n)]
    files = index.read(spark).select(F.input_file_name()).distinct().count()
    wanted = [4001, 4002, 4002, 4499, 12_345, n + 5, -1]
    got, (read, rows) = scanned(spark, index.at(spark.createDataFrame([(i,) for i in wanted], "p long")))
    assert sorted((r.key, r.idx) for r in got) == [(i, i) for i in (4001, 4002, 4499, 12_345)]
    assert files >= 40 and read <= 6 and rows <= 2000
    assert index.at(spark.createDataFrame([(n + 1,), (None,)], "p long")).count() == 0
    assert index.at(spark.createDataFrame([], "p long")).count() == 0


def test_stored_index_of_nothing(spark, tmp_path):
    index = StoredIndex(str(tmp_path / "i")).write(spark.range(0).select(F.col("id").alias("key")), ["key"])
    assert index.read(spark).count() == 0 and index.at(spark.range(3).toDF("p")).count() == 0
