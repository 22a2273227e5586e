import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as hn
from quarry.llm.queries import op13_hard_negatives
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"


def brute(rows, positives=5, negatives=5, low=80, scale=256, step=100):
    """rows: (id, label, vector), usable ones; every anchor against every row, sorted."""
    x = {}
    for i, lab, v in rows:
        x.setdefault(i, set()).add((lab, tuple(math.floor(scale * c) for c in v)))
    out = []
    for a in sorted(i for i in x if i % step == 0):
        lab, va = min(x[a])
        ranked = sorted({(-sum(p * q for p, q in zip(va, vb)), b, lb) for b, found in x.items() if b != a for lb, vb in found})
        pos = [(-s, b) for s, b, lb in ranked if lb == lab]
        neg = [(-s, b) for s, b, lb in ranked if lb != lab]
        for ps, p in list(dict.fromkeys(pos))[:positives]:
            window = list(dict.fromkeys((s, b) for s, b in neg if low * ps <= 100 * s <= 100 * ps))
            out += [(a, p, r, b, ps, s) for r, (s, b) in enumerate(window[:negatives], 1)]
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                              "negative_score").collect())


def test_query_against_all_pairs(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in table(spark, SF, "embeddings").collect()]
    assert as_rows(op13_hard_negatives(spark, SF)) == brute(rows)


@pytest.mark.parametrize("block", [20_000, 4])
def test_ties_few_rows_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(hn, "ANCHORS", block)
    monkeypatch.setattr(hn, "PRODUCTS", 50)
    rng = random.Random(block)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 9]), [rng.choice([-1, 0, 1, 2]) / 4 for _ in range(3)]) for i in range(120)]
    rows += [(500, 7, [0.5, 0.5, 0.5]), (505, 8, [-0.5, 0.0, 0.25]), (506, 8, [0.5, 0.0, -0.25])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(7)
    got = as_rows(hn.mine(df, F.col("id") % 5 == 0))
    assert got == brute(rows, step=5) and len(got) > 100
    assert as_rows(hn.mine(df, F.col("id") % 5 == 0, positives=2, negatives=9, low=10)) == brute(rows, 2, 9, 10, step=5)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, int(i % 3), rng.integers(-4, 5, 4).tolist()) for i in range(40)]
    odd = [(None, 1, [1.0] * 4), (200, None, [1.0] * 4), (300, 1, None), (400, 1, []), (500, 1, [1.0, 2.0]),
           (600, 1, [1.0, None, 1.0, 1.0]), (700, 1, [float("nan")] * 4), (800, 1, [1e300] * 4), (41, 2, [float("-inf")] * 4)]
    rows = good + [good[0], good[3], good[3], (7, 2, good[8][2]), (20, 0, good[0][2])]
    df = spark.createDataFrame([(i, lab, v, "x", 1) for i, lab, v in [(i, lab, v and [None if c is None else float(c) for c in v])
                                                                      for i, lab, v in rows + odd]],
                               "vec_id long, label int, embedding array<double>, rank string, anchor int").repartition(4)
    assert as_rows(hn.mine(df, F.col("id") % 10 == 0)) == brute(rows, step=10)
    for none in (df.limit(0), df.where("vec_id = 300"), df.where("vec_id = 1")):
        assert hn.mine(none, F.col("id") % 10 == 0).count() == 0


def test_products_beyond_doubles_are_exact():
    rng = np.random.default_rng(5)
    a, b = rng.integers(-2**29, 2**29, (3, 4)), rng.integers(-2**29, 2**29, (5, 4))
    got = hn.Anchors(np.arange(3), np.zeros(3, int), a).scores(b)
    assert got.tolist() == (a.astype(object) @ b.T.astype(object)).tolist()


def test_suffix_merges():
    limits, k = [90, 70, 70, 10], 3
    entries = sorted([(s, i) for i, s in enumerate([95, 90, 88, 71, 70, 70, 69, 60, 57, 10, 9, 3, 3, 1])], key=lambda e: (-e[0], e[1]))
    slots = {}
    for s, i in entries:
        j = sum(x >= s for x in limits)
        if j:
            slots.setdefault(j, []).append((s, i))
    got = hn.suffix_answers({j: e[:k] for j, e in slots.items()}, limits, k)
    assert got == [[e for e in entries if e[0] <= x and 80 * x <= 100 * e[0]][:k] for x in limits]
