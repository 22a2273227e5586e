import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import toxicity as tx
from quarry.llm import vec
from quarry.llm.keys import fold
from quarry.llm.queries import op4_toxicity
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"


def test_gradients_match_finite_differences(monkeypatch):
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tx.init_params(3, rng).items()}
    x = rng.normal(0, 1, (5, tx.WIDTH, tx.EMB))
    mask = np.arange(tx.WIDTH) < np.array([[tx.WIDTH], [3], [1], [10], [0]])
    y, w = np.array([1.0, 0, 1, 0, 1]), np.array([1.0, 2, 1, 1, 0.5])
    _, g, dx = tx.gradients(p, x, mask, y, w)
    for name in ("ow", "ob", "aw", "av", "wf", "uf", "cb", "ub"):
        for at in list(np.ndindex(p[name].shape))[:: max(1, p[name].size // 4)]:
            keep, eps = p[name][at], 1e-2
            p[name][at] = keep + eps
            up = tx.gradients(p, x, mask, y, w)[0]
            p[name][at] = keep - eps
            down = tx.gradients(p, x, mask, y, w)[0]
            p[name][at] = keep
            assert g[name][at] == pytest.approx((up - down) / (2 * eps), abs=3e-4)
    at = (0, 2, 1)
    hi, lo = x.copy(), x.copy()
    hi[at] += 1e-2
    lo[at] -= 1e-2
    slope = (tx.gradients(p, hi, mask, y, w)[0] - tx.gradients(p, lo, mask, y, w)[0]) / 2e-2
    assert dx[at] == pytest.approx(slope, abs=3e-4)


def test_windows_cover_every_word():
    woff = np.cumsum([0, 0, 1, tx.WIDTH, tx.WIDTH + 1, 100, 3])
    text, pos, mask = tx.windows(woff)
    for d in range(len(woff) - 1):
        own = text == d
        assert own.any() and set(pos[own][mask[own]]) == set(range(woff[d], woff[d + 1]))


def test_a_passage_lies_whole_in_a_window_wherever_it_stands():
    for n in range(1, 3 * tx.WIDTH):
        _, pos, mask = tx.windows(np.array([0, n]))
        runs = [set(p[m].tolist()) for p, m in zip(pos, mask)]
        size = min(n, tx.WIDTH - tx.STRIDE + 1)
        assert size == min(n, 17)
        for start in range(n - size + 1):
            assert any(set(range(start, start + size)) <= r for r in runs)


def plain_logit(p, inputs):
    """One window's logit, word by word and in plain floats."""
    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def direction(xs, w, u, c):
        h, out = [0.0] * tx.HID, []
        for x in xs:
            own = [sum(x[i] * w[i][j] for i in range(tx.EMB)) + c[j] for j in range(3 * tx.HID)]
            rec = [sum(h[i] * u[i][j] for i in range(tx.HID)) for j in range(3 * tx.HID)]
            z = [sigmoid(own[j] + rec[j]) for j in range(tx.HID)]
            r = [sigmoid(own[tx.HID + j] + rec[tx.HID + j]) for j in range(tx.HID)]
            new = [math.tanh(own[2 * tx.HID + j] + r[j] * rec[2 * tx.HID + j]) for j in range(tx.HID)]
            h = [z[j] * h[j] + (1 - z[j]) * new[j] for j in range(tx.HID)]
            out.append(h)
        return out

    states = [f + b for f, b in zip(direction(inputs, p["wf"], p["uf"], p["cf"]),
                                    reversed(direction(inputs[::-1], p["wb"], p["ub"], p["cb"])))]
    notice = [math.exp(sum(p["av"][k] * math.tanh(sum(s[j] * p["aw"][j][k] for j in range(2 * tx.HID)))
                           for k in range(tx.HID))) for s in states]
    pooled = [sum(a * s[j] for a, s in zip(notice, states)) / sum(notice) for j in range(2 * tx.HID)] if states \
        else [0.0] * (2 * tx.HID)
    return sum(x * w for x, w in zip(pooled, p["ow"])) + p["ob"][0]


@pytest.mark.parametrize("batch", [1, 7, 2048])
def test_scores_equal_a_plain_loop_over_all_windows(batch):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (0, 1, 5, 23, 24, 25, 32, 33, 70, 24, 3)]
    hasher = vec.Hasher()
    words = next(w for _, _, w in vec.word_chunks(pa.array(texts), hasher))
    known = np.unique(words.hashes)[::2]
    params = {k: rng.normal(0, 0.6, v.shape).astype(np.float32) for k, v in tx.init_params(len(known), rng).items()}
    model = tx.Model(known, params)
    p = {k: v.tolist() for k, v in params.items()}
    got = model.text_logits(words, hasher, batch)
    for k in range(len(texts)):
        a, b = words.woff[k], words.woff[k + 1]
        x = model.inputs(words, np.arange(a, b), hasher).tolist()
        starts = [*range(0, max(len(x) - tx.WIDTH, 0), tx.STRIDE), max(len(x) - tx.WIDTH, 0)]
        want = max(plain_logit(p, x[s: s + tx.WIDTH]) for s in starts)
        assert got[k] == pytest.approx(want, abs=2e-4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"  # some of its labels are flipped: documents without any insult
    got = op4_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 500
    assert sum(r.predicted == r.toxic for r in held) >= 0.96 * len(held)
    toxic, clean = ([r.score for r in held if r.toxic == y] for y in (1, 0))
    assert sum(a > b for a in toxic for b in clean) >= 0.96 * len(toxic) * len(clean)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for a, b in zip(*(tx.sample(docs, x.where(fold("doc_id") != 0), "doc_id", "text", "toxic") for x in (labels, flipped))):
        assert a == b


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (3, 0), (4, 0), (9, 1), (None, 1), (5, None), (0, 1), (8, 2), (77, 1)],
                                   "doc_id long, toxic int")
    texts, ys, weight = tx.sample(odd_docs, labels, "doc_id", "text", "toxic", per_class=2)
    assert weight == (1.0, 1.5)  # three ids are labelled 1, two are in the sample
    assert len(texts) == len(ys) and set(ys) == {0, 1}
    rows, weight = tx.sample_rows(odd_docs, labels, "doc_id", "text", "toxic", per_class=2)
    here, there = tx.train(texts, ys, weight), tx.train_on(rows, weight)  # in a task as on the driver
    assert (here.known == there.known).all() and all((here.params[k] == there.params[k]).all() for k in here.params)
    assert (here.scale, here.shift) == (there.scale, there.shift)
    few = tx.train_on(rows, weight, most_bytes=10)  # only texts that fit the bound
    assert few.scale == 0 or len(few.known) < len(here.known)
    assert tx.train_on(rows.limit(0), weight).scale == 0
    model = tx.train(texts, ys, epochs=2)
    got = tx.score(odd_docs, model)
    assert got.columns == ["doc_id", "score"]
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    left = tx.drop_toxic(odd_docs, model)
    assert left.columns == odd_docs.columns
    assert left.count() == sum(r.score < 0.5 for r in rows)
    assert tx.score(no_docs, model).count() == 0 and tx.drop_toxic(no_docs, model).count() == 0


def test_without_labels_scores_are_the_prior(spark, odd_docs):
    for texts, ys in (([], []), (["a b"], [1])):
        model = tx.train(texts, ys)
        words = next(w for _, _, w in vec.word_chunks(pa.array(["a", ""]), vec.Hasher()))
        got = model.score(words, vec.Hasher())
        assert (got == got[0]).all() and (got[0] > 0.5) == bool(ys)
