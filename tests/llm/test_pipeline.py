import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from quarry.llm.mixing import BLOCK_ROWS, temperature_weights
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output."""
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        path = str(base / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stage_order_and_columns(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    for _, _, after in stages[:-1]:
        assert after.columns == cp.COLUMNS


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    _, before, after = stages[0]
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    gone = ids(before) - ids(after)
    toxic = {i for i, t in labels.items() if t == 1}
    assert len(gone & toxic) >= 0.9 * len(toxic)  # a few labels are flipped
    assert len(gone & (set(labels) - toxic)) <= 0.01 * len(labels)


def test_line_dedup_keeps_all_documents(stages):
    _, before, after = stages[1]
    assert ids(before) == ids(after)
    assert after.where(F.col("n_chars") != F.char_length("text")).count() == 0


def test_near_dedup_keeps_one_of_each_group(stages):
    _, before, after = stages[2]
    texts = {r.doc_id: r.text for r in before.collect()}
    first = {}
    for i in sorted(texts):
        first.setdefault(tuple(texts[i].lower().split()), i)
    assert all(i in set(first.values()) or not texts[i].strip() for i in ids(after))


def test_mixing_reorders_only(spark, stages):
    _, before, after = stages[3]
    assert sorted(map(repr, before.collect())) == sorted(map(repr, after.collect()))
    order = [r.source for r in after.orderBy(F.col("_metadata.file_name"), F.col("_metadata.row_index")).collect()]
    weight = temperature_weights(before)
    whole = sum(weight.values())
    for n in (100, 200, len(order) // 3):  # while every source has rows left, it is within a block of its share
        assert all(abs(order[:n].count(s) - n * weight[s] / whole) < 2 * BLOCK_ROWS for s in weight)


def test_packing_holds_every_document(stages):
    _, before, after = stages[4]
    got = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("want")).collect()
    assert {r.doc_id for r in got} == ids(before) and all(r.n == r.want for r in got)


def test_odd_rows_run_through(spark, odd_docs, no_docs, tmp_path):
    for k, docs in enumerate((odd_docs, no_docs)):
        for name, stage in cp.STAGES:
            path = str(tmp_path / f"{k}-{name}")
            stage(spark, docs, "/root/testdata/sf0.001").write.parquet(path)
            docs = spark.read.parquet(path)
        assert "sequence_id" in docs.columns
