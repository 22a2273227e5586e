import math

from pyspark.sql import functions as F

from quarry.functions.schedule import lr_at, uniform
from quarry.operators.batching import assign_batches, device_shards, update_groups
from quarry.operators.sampling import greedy, seeded_draw, temperature_softmax, top_k_with_ties
from quarry.operators.scoring import ignore_index, masked_mean
from quarry.plans.training import plan_rows


def test_a1_masked_mean_cases(spark):
    rows = ([(1, float(l), m) for l, m in zip([2.1, 1.8, 0, 0, 0], [1, 1, 0, 0, 0])]
            + [(2, float(l), m) for l, m in zip([2.1, 1.8, 2.3, 0.5, 0.8, 1.2, 0, 0], [0, 0, 0, 0, 1, 1, 0, 0])]
            + [(3, 1.0, 0)])
    df = spark.createDataFrame(rows, "b int, loss double, mask int")
    got = {r.b: r.loss for r in masked_mean(df, ["b"]).collect()}
    assert math.isclose(got[1], 1.95) and math.isclose(got[2], 1.0) and got[3] is None


def test_a2_ignore_index(spark):
    df = spark.createDataFrame([(1, 2.0, 0, 1), (1, 4.0, 5, 1)], "b int, loss double, y int, mask int")
    df = df.withColumn("loss", ignore_index(F.col("loss"), F.col("y")))
    assert masked_mean(df, ["b"]).collect()[0].loss == 2.0  # 0 in numerator, +1 in denominator


def test_b2_b6(spark):
    df = spark.range(10).withColumnRenamed("id", "pos")
    b = assign_batches(df, 4).groupBy("step").count().orderBy("step").collect()
    assert [(r.step, r["count"]) for r in b] == [(0, 4), (1, 4), (2, 2)]
    u = update_groups(spark.range(10).withColumnRenamed("id", "step"), 8).where("is_update").collect()
    assert [r.step for r in u] == [7]


def test_b4_device_shards_last_batch(spark):
    df = assign_batches(spark.range(10).withColumnRenamed("id", "pos"), 4)
    d = device_shards(df, 3, 10, 4).orderBy("pos").collect()
    assert [r.device for r in d] == [0, 0, 1, 1, 0, 0, 1, 1, 0, 1]


def test_b7_lr(spark):
    df = spark.createDataFrame([(0,), (100,), (101,)], "it long")
    got = [r.lr for r in df.select(lr_at(F.col("it"), F.lit(100), 2e-4, 0).alias("lr")).collect()]
    assert math.isclose(got[0], 2e-4) and math.isclose(got[1], 2e-5) and math.isclose(got[2], 2e-5)


def test_b1_shuffle_is_permutation(spark):
    df = spark.range(50).withColumn("key", F.col("id").cast("string")).withColumn("mask", F.array(F.lit(1)))
    rows, n = plan_rows(df.select("key"), "key", epochs=2, batch_size=8)
    got = rows.collect()
    assert n == 50 and len(got) == 100
    for e in (0, 1):
        assert sorted(r.pos for r in got if r.epoch == e) == list(range(50))
    order0 = [r.key for r in sorted((r for r in got if r.epoch == 0), key=lambda r: r.pos)]
    order1 = [r.key for r in sorted((r for r in got if r.epoch == 1), key=lambda r: r.pos)]
    assert order0 != order1


def test_g_ops(spark):
    df = spark.createDataFrame([(1, 10, 3.0), (1, 11, 2.0), (1, 12, 2.0), (1, 13, 1.0), (2, 5, 0.5), (2, 4, 0.5)],
                               "ctx int, token int, logit double")
    assert sorted(r.logit for r in top_k_with_ties(df.where("ctx = 1"), 2).collect()) == [2.0, 2.0, 3.0]
    assert {r.ctx: r.token for r in greedy(df).collect()} == {1: 10, 2: 4}
    sm = temperature_softmax(df, 1.0).collect()
    assert math.isclose(sum(r.p for r in sm if r.ctx == 2), 1.0)
    draws = {r.ctx: r.token for r in seeded_draw(temperature_softmax(df, 1.0)).collect()}
    assert draws[2] in (4, 5) and draws == {r.ctx: r.token for r in seeded_draw(temperature_softmax(df, 1.0)).collect()}
    u = spark.range(1).select(uniform(F.lit("1:42")).alias("u")).collect()[0].u
    assert 0 <= u < 1


def test_a4_group_without_loss_positions_is_null(spark):
    from quarry.operators.scoring import ngram_nll
    df = spark.createDataFrame([("a", [5, 6, 7], [6, 7, 5], [1, 1, 1]), ("b", [5, 6], [6, 5], [0, 0])],
                               "g string, x array<int>, y array<int>, loss_mask array<int>")
    got = {r.g: r for r in ngram_nll(df, ["g"], vocab_size=10).collect()}
    assert got["b"].mean_nll is None and got["b"].loss_tokens == 0
    # a: each pair seen once, context count 1: p = 2 / 11
    assert abs(got["a"].mean_nll - (-math.log(2 / 11))) < 1e-6


def test_a4_dense_equals_joined(spark, monkeypatch):
    """Random ids and masks, empty and short rows, ignored targets; ids outside the vocabulary take the joins."""
    import random

    from quarry.operators import scoring

    rng = random.Random(3)
    rows = []
    for i in range(60):
        n = rng.randrange(8)
        rows.append((rng.choice(["a", "b", None]), i, *[[rng.randrange(6) for _ in range(n)] for _ in range(2)],
                     [rng.randrange(2) for _ in range(n)]))
    rows.append(("c", 60, [1, 2], [2, 3], [0, 0]))
    df = spark.createDataFrame(rows, "g string, k int, x array<int>, y array<int>, loss_mask array<int>").repartition(3)

    def got(cells, frame, cols):
        monkeypatch.setattr(scoring, "DENSE_CELLS", cells)
        return sorted(map(str, scoring.ngram_nll(frame, cols, vocab_size=6).collect()))

    def per_row(r):  # a row without positions has no row in the joined form
        return "loss_tokens=None" not in r and "loss_tokens=0" not in r

    assert got(36, df, ["g"]) == got(0, df, ["g"])
    assert list(filter(per_row, got(36, df, ["k"]))) == list(filter(per_row, got(0, df, ["k"])))
    assert scoring.dense_bigram_model(df, 6) is None  # 36 cells are over the bound of 0
    monkeypatch.setattr(scoring, "DENSE_CELLS", 36)
    wide = df.unionByName(spark.createDataFrame([("a", 99, [7], [1], [1])], df.schema))
    assert scoring.dense_bigram_model(wide, 6) is None and scoring.dense_bigram_model(df.limit(0), 6).shape == (6, 6)
    plan = scoring.ngram_nll(df, ["k"], 6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Generate" not in plan  # two numbers a row are shuffled, no positions


def test_positions_are_scored_a_few_rows_at_a_time():
    import pyarrow as pa

    from quarry.operators.scoring import PART_ROWS, _parts

    batch = pa.RecordBatch.from_arrays([pa.array([[i, i] for i in range(3 * PART_ROWS + 1)])], names=["x"])
    parts = list(_parts([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in parts] == [PART_ROWS] * 3 + [1]
    assert [v for p in parts for v in p.column(0).flatten().to_pylist()] == batch.column(0).flatten().to_pylist()
