import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from quarry.llm import pitman_yor as py
from quarry.llm import vec
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [None]


def check_base(rows, got):
    learn = Counter(w for i, t in rows if crc32(str("" if i is None else i).encode()) % 5 != 1 for w in tokens(t))
    n, v = sum(learn.values()), len(learn)
    want = []
    for i, t in rows:
        ts = tokens(t)
        base = sum(math.log10((learn[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts)
        want.append((i is None, i or 0, len(ts), sum(learn[w] > 0 for w in ts), base))
    have = [(r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score) for r in got]
    assert len(have) == len(want)
    for a, b in zip(sorted(have), sorted(want)):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
    for r in got:
        assert r.train_tokens == n
        assert r.held_out == (crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 1)
        assert r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_base_is_exact_and_held_out_texts_gain(spark):
    docs = table(spark, SF, "documents")
    got = py.score(docs).collect()
    check_base([(r.doc_id, r.text) for r in docs.collect()], got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.95


def test_same_scores_for_any_partitioning(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for shuffle, parts in ((4, 1), (12, 5)):
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
            got.append({r.doc_id: r.score for r in py.score(docs.repartition(parts)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(got[0]) == set(got[1]) and all(got[0][i] == pytest.approx(got[1][i], rel=1e-9) for i in got[0])


def plain_scores(rows, sweeps, samples, seed):
    """The model customer by customer, in dictionaries (dishes of at most NEAR customers)."""
    hasher = vec.Hasher()

    def hashed(word):
        if word is None:
            return py._END
        data = np.frombuffer(word.encode(), np.uint8)
        return hasher.spans(data, np.array([0]), np.array([len(data)]))[0]

    def pairs(text):
        context = 0
        for w in map(hashed, tokens(text)):
            yield w, context
            context = 1 + int(vec.mix64(np.array([w]))[0] % np.uint64(py.CONTEXTS - 1))

    customers = Counter(p for i, t in rows if crc32(str(i).encode()) % 5 != 1 for p in pairs(t))
    kinds = len({w for w, _ in customers})

    def sums(of):
        by_word, by_context = Counter(), Counter()
        for (w, c), k in of.items():
            by_word[w] += k
            by_context[c] += k
        return by_word, by_context

    def discount(counts):
        ones, twos = sum(k == 1 for k in counts), sum(k == 2 for k in counts)
        return min(0.95, max(0.05, ones / (ones + 2 * twos)))

    tables = {p: 1 for p in customers}
    at_word, at_context = sums(tables)
    parent = {w: 1 for w in at_word}
    d, d0 = discount(customers.values()), discount(at_word.values())
    n_context = sums(customers)[1]

    def base(w):
        floor = (py.STRENGTH + d0 * sum(parent.values())) / (kinds + 1)
        return (at_word[w] - d0 * parent.get(w, 0) + floor) / (py.STRENGTH + sum(at_word.values()))

    def seated(n, rate, off, w, c, sweep):
        key = py.draw_keys(np.array([w]), np.array([c]), seed, sweep)
        t = 1
        for i in range(1, n):
            t += py.uniform(key, i)[0] < rate / (rate + i - off * t)
        return t

    predicted = []
    for sweep in range(sweeps):
        rate0 = (py.STRENGTH + d0 * sum(parent.values())) / (kinds + 1)
        tables = {(w, c): seated(n, (py.STRENGTH + d * at_context[c]) * base(w), d, w, c, sweep)
                  for (w, c), n in customers.items()}
        at_word, at_context = sums(tables)
        parent = {w: seated(n, rate0, d0, w, py.CONTEXTS, sweep) for w, n in at_word.items()}
        predicted.append(lambda w, c, tables=tables, at_context=at_context, p={w: base(w) for w in at_word}, rest=base(None):
                         (customers[w, c] - d * tables.get((w, c), 0) + (py.STRENGTH + d * at_context[c]) * p.get(w, rest))
                         / (py.STRENGTH + n_context[c]))
    use = predicted[-samples:]
    return {i: sum(math.log10(sum(f(w, c) for f in use) / len(use)) for w, c in pairs(t)) for i, t in rows}


def test_scores_equal_the_model_customer_by_customer(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x) % 50}" for x in rng.zipf(1.4, rng.integers(0, 9)))) for i in range(30)]
    want = plain_scores(rows, py.SWEEPS, py.SAMPLES, 9)
    got = py.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), seed=9).collect()
    assert len(got) == len(rows) and all(r.score == pytest.approx(want[r.doc_id], rel=1e-9) for r in got)


def test_odd_rows(odd_docs, no_docs):
    check_base([(r.doc_id, r.text) for r in odd_docs.collect()], py.score(odd_docs).collect())
    assert py.score(no_docs).count() == 0


def test_nothing_to_learn_from(spark):
    alone = next(i for i in range(100) if crc32(str(i).encode()) % 5 == 1)
    r = py.score(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)
    assert r.score == pytest.approx(0) and r.base_score == pytest.approx(0)


def toy_shard(text):
    """A shard of one block that holds all tokens of a training text and asks for unseen pairs too."""
    words = vec.Hasher().words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    token, context, where = py._token_block(words)
    kinds = np.unique(token)
    seen = np.unique(context)
    ask_t, ask_c = np.repeat(kinds, len(seen)), np.tile(seen, len(kinds))
    token, context = np.r_[token, ask_t], np.r_[context | py._TRAIN, ask_c]
    order = np.lexsort((context, token))
    token, context = token[order], context[order]
    new = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    return py.Shard([(0, token[new].astype("<u8").tobytes(), np.diff(np.r_[new, len(token)]).astype("<u4").tobytes(),
                      context.astype("<u2").tobytes(), np.zeros(len(token), "<u2").tobytes())])


def test_predictive_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    shard = toy_shard(" ".join(f"w{int(x)}" for x in rng.zipf(1.5, 800) % 40))
    tables, parent = shard.first_seating()
    total = {"customers": np.bincount(shard.context, shard.count, py.CONTEXTS),
             "tables": np.bincount(shard.context, tables, py.CONTEXTS).astype(float), "discount": 0.7,
             "parent_discount": 0.5, "parent_tables": parent.sum(), "kinds": shard.dishes}
    state = (tables, parent)
    for number in range(3):
        p = shard.predictive(state, total)
        base = shard.base(*state, total)
        floor = (py.STRENGTH + 0.5 * total["parent_tables"]) / (total["kinds"] + 1) / (py.STRENGTH + total["tables"].sum())
        assert base.sum() + floor == pytest.approx(1)
        for c in np.unique(shard.context):
            own = shard.context == c
            rest = (py.STRENGTH + 0.7 * total["tables"][c]) * floor / (py.STRENGTH + total["customers"][c])
            assert p[own].sum() + rest == pytest.approx(1)
        state = shard.sweep(state, total, 0, number)
        assert (state[0] <= shard.count).all() and ((state[0] > 0) == (shard.count > 0)).all()
        total = total | {"tables": np.bincount(shard.context, state[0], py.CONTEXTS).astype(float),
                         "parent_tables": state[1].sum()}


@pytest.mark.parametrize("count, rate, d", [(20, 0.8, 0.4), (200, 0.8, 0.4), (300, 8.0, 0.7), (3000, 3.0, 0.5)])
def test_seating_follows_the_restaurant_process(count, rate, d):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 4000).astype(np.uint64)
    got = py.seat(np.full(4000, count), np.full(4000, rate), d, keys)
    plain = np.ones(4000)
    for i in range(1, count):
        plain += rng.random(4000) < rate / (rate + i - d * plain)
    assert got.mean() == pytest.approx(plain.mean(), rel=0.03)
    assert got.std() == pytest.approx(plain.std(), rel=0.1)


def test_one_dish_with_very_many_customers():
    tables = [py.seat(np.array([10**8]), np.array([5.0]), 0.0, np.array([k], np.uint64))[0] for k in range(200)]
    assert np.mean(tables) == pytest.approx(5 * (math.log(10**8 / 5)), rel=0.1)
