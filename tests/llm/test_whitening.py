import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import vectors, whitening
from quarry.llm.queries import op11_whitening
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, whitened string, deviation int, n int"


def brute(x):
    """Eigenpairs of the covariance of integer rows, falling."""
    z = x - x.mean(0)
    e, q = np.linalg.eigh(z.T @ z / len(x))
    return e[::-1], q[:, ::-1]


def made(rng, n, spectrum):
    turn = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    return (rng.standard_normal((n, len(spectrum))) * np.sqrt(spectrum)) @ turn


@pytest.mark.parametrize("spectrum", [np.linspace(40, 1, 120), np.r_[500, 90, np.full(98, 30.0)] + np.arange(100)[::-1] * 0.3,
                                      2.0 ** -np.arange(60)])
def test_filter_finds_the_leading_pairs(spectrum):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    v = turn @ np.diag(np.sort(spectrum)[::-1]) @ turn.T
    e, q, residual, passes = whitening.leading_pairs(lambda x: v @ x, len(v), 20, 30)
    want = np.sort(spectrum)[::-1][:20]
    assert residual <= 1e-10 * want[0] and passes > 1
    assert np.abs(e - want).max() <= 1e-12 * want[0]
    assert np.abs(q.T @ q - np.eye(20)).max() < 1e-12


def test_query_against_dense_eigenpairs(spark):
    vecs = {r.vec_id: r.embedding for r in table(spark, SF, "embeddings").collect()}
    x = np.array([[math.floor(64 * c) + 1000000 for c in vecs[i]] for i in sorted(vecs)], float)
    e, q = brute(x)
    rows = op11_whitening(spark, SF).collect()
    assert len(rows) == 32 * len(vecs) and {r.n for r in rows} == {len(vecs)}
    place = {i: k for k, i in enumerate(sorted(vecs))}
    w = np.empty((len(vecs), 32))
    for r in rows:
        w[place[r.vec_id], r.component - 1] = r.whitened
    want = (x - x.mean(0)) @ q[:, :32] / np.sqrt(e[:32])
    want *= np.sign((want * w).sum(0))
    assert np.abs(w - want).max() < 1e-9
    assert {r.identity_error for r in rows}.pop() < 1e-10
    for r in rows:
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-10
    ints = x.astype(int).astype(object)
    dev = ((len(vecs) * ints - ints.sum(0)) ** 2).sum(1)
    assert all(r.deviation == dev[place[r.vec_id]] for r in rows)


def test_more_dimensions_than_the_block_and_rank_below_it(spark):
    rng = np.random.default_rng(2)
    x = made(rng, 300, np.linspace(30, 2, 40))
    x[:, 7] = x[:, 8]  # rank 39
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    ints = np.floor(64 * x)
    e, q = brute(ints)
    few = whitening.fit(df, components=6)
    assert few.passes > 1 and np.abs(few.values / e[:6] - 1).max() < 1e-12
    assert np.abs(np.abs((few.vectors * q[:, :6]).sum(0)) - 1).max() < 1e-9
    assert len(whitening.fit(df, components=40).values) == 39


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((20, 4)).astype(np.float32).tolist()
    rows = [(i, v, "x", 1, 2) for i, v in enumerate(good)] + [(0, good[0], "x", 1, 2), (None, good[1], None, None, None)]
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [float("inf")] * 4, [1.0, 2.0], [3e38] * 4]
    df = spark.createDataFrame(rows + [(100 + i, v, None, 0, 0) for i, v in enumerate(bad)], SCHEMA).repartition(3)
    model = whitening.fit(df, components=3)
    out = whitening.whiten(df, model)
    assert out.columns == ["vec_id", "embedding", "n", "deviation", "whitened"]
    got = out.collect()
    assert model.n == len(rows) == len(got) and all(len(r.whitened) == 3 for r in got)
    same = [r.whitened for r in got if r.vec_id == 0]
    assert len(same) == 2 and same[0] == same[1]
    for none in (df.limit(0), df.where("vec_id >= 100 and size(embedding) <> 2")):
        assert whitening.whiten(none, whitening.fit(none)).count() == 0
    flat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    one = whitening.fit(flat)
    assert len(one.values) == 0 and one.identity_error is None
    assert [(r.deviation, r.whitened) for r in whitening.whiten(flat, one).collect()] == [(0, [])] * 5


def test_exact_beyond_64_bits(spark):
    far = 2.0 ** 43
    df = spark.createDataFrame([(0, [far]), (1, [-far]), (2, [0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, whitening.fit(df)).collect()}
    assert got == {0: None, 1: None, 2: 0}


def test_partial_sums_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FAN", 2)
    df = spark.range(1000, numPartitions=9).select(F.col("id").alias("vec_id"), F.array(F.col("id") * 1.0, F.lit(1.0)).alias("embedding"))
    chunks = vectors.packed(df, "embedding", 2, 1)
    got = vectors.summed(chunks, 9, 2, lambda x: x.sum(0))
    assert got.tolist() == [499500, 1000]
