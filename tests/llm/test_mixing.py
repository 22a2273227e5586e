from collections import Counter
from math import ceil, floor

import pytest

from quarry.llm.mixing import in_mix_order, mix, period_of, period_slots, shares, temperature_weights


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 0.9, None: 0.05, "c": 0.05},
                                     {f"s{i}": i + 1 for i in range(40)}])
def test_each_block_lies_in_its_window_and_prefixes_keep_the_weights(weights):
    share = shares(weights, 1000)
    assert sum(share.values()) == 1000
    slots = period_slots(share, 1000)
    owner = {}
    for s, at in slots.items():
        assert len(at) == share[s]
        for k, t in enumerate(at):
            assert floor(k * 1000 / share[s]) <= t < ceil((k + 1) * 1000 / share[s])
            owner[t] = s
    assert sorted(owner) == list(range(1000))
    done = Counter()
    for t in range(1000):
        done[owner[t]] += 1
        assert all(abs(done[s] - (t + 1) * share[s] / 1000) < 1 for s in share)


def test_shares_follow_the_weights():
    assert shares({"a": 0}, 10) == {} and period_slots({}, 10) == {}
    assert shares({"a": 1e9, "b": 1, "c": 1}, 10) == {"a": 8, "b": 1, "c": 1}  # one slot at least, given up by the largest
    weights = {"hot": 1000**0.5, **{f"s{i}": 1.0 + i % 7 / 10 for i in range(299)}}
    period, total = period_of(weights), sum(weights.values())
    got = shares(weights, period)
    assert sum(got.values()) == period and all(abs(got[s] - w / total * period) < 1 for s, w in weights.items())
    slots, done = period_slots(got, period), 0
    for n, t in enumerate(slots["hot"], 1):  # against the weight itself, over a whole period
        assert abs(n - (t + 1) * weights["hot"] / total) < 2
        done = n
    assert done == got["hot"]


def test_thousands_of_sources(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 5000)) as source")
    weights = temperature_weights(df)
    assert len(weights) > 3000
    rows = mix(df, weights, block_rows=2).collect()
    assert len({(r.slot, r.slot_offset) for r in rows}) == len(rows) == 20_000
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_ranks_are_dense_and_deviation_is_below_a_block(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then 'b' else null end as source")
    rows = mix(df, {"hot": 3, "b": 1, None: 1}, block_rows=4).orderBy("slot", "slot_offset").collect()
    assert len(rows) == 3000 and len({r.doc_id for r in rows}) == 3000
    share = {"hot": 0, "b": 0, None: 0}
    size = shares({"hot": 3, "b": 1, None: 1}, 1000)
    for r in rows:
        assert r.release <= r.slot < r.deadline
    for n, r in enumerate(rows[:1200], 1):  # while every source has rows left
        share[r.source] += 1
        for s in share:
            assert abs(share[s] - n * size[s] / 1000) < 2 * 4


def test_odd_rows_all_come_back(spark, odd_docs, no_docs):
    got = mix(odd_docs, {"a": 1, None: 2})
    assert set(got.columns) == set(odd_docs.columns) | {"block", "release", "deadline", "slot", "slot_offset"}
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert all((r.slot is None) == (r.source == "b") for r in rows)
    placed = [(r.slot, r.slot_offset) for r in rows if r.slot is not None]
    assert len(placed) == len(set(placed))
    ordered = in_mix_order(odd_docs, temperature_weights(odd_docs))
    assert ordered.columns == odd_docs.columns
    assert sorted(map(repr, ordered.collect())) == sorted(map(repr, odd_docs.collect()))
    assert mix(no_docs, temperature_weights(no_docs)).count() == 0
