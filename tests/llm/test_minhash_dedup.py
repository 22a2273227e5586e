import itertools

import numpy as np
import pytest

from quarry.llm import minhash_dedup as md
from quarry.llm.graph import components
from quarry.sources.tables import table


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k):
    """{id: (set sizes, component)} over (id, text) rows; rows that share an id are one node."""
    sets, parent = {}, {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, k))
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        for x, y in itertools.product(sets[a], sets[b]):
            n = len(x & y)
            if x and y and 100 * n >= 80 * (len(x) + len(y) - n):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: ({len(s) for s in sets[i]}, find(i)) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, k):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], k)
    got = md.near_duplicates(docs, shingle=k).collect()
    assert len(got) == len(want)
    for r in got:
        assert ({r.n_shingles}, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute([r for r in rows if r[0] is not None], 2)
    got = md.near_duplicates(odd_docs, shingle=2).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id][1] and r.n_shingles in want[r.doc_id][0]
            assert r.kept == (r.doc_id == r.component_id)
    left = md.drop_near_duplicates(odd_docs, shingle=2)
    assert left.columns == odd_docs.columns
    kept = {i for i, (_, c) in want.items() if i == c}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in rows if i is None or i in kept)
    assert md.near_duplicates(no_docs).count() == 0 and md.drop_near_duplicates(no_docs).count() == 0


def test_chains_of_near_copies_and_a_bucket_of_unlinked_texts(spark):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
    rows = []
    for i in range(60):  # each copy differs from the one before, the ends are far apart
        base = base.copy()
        base[int(rng.integers(0, 200))] = f"new{i}"
        rows.append((i, " ".join(base)))
    for i in range(60, 100):  # half of the text is common to all
        rows.append((i, " ".join(f"c{x}" for x in range(100)) + " " + " ".join(f"u{x}" for x in rng.integers(0, 9999, 100))))
    want = brute(rows, 2)
    got = md.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in want.items()}


def test_graph_components(spark):
    rng = np.random.default_rng(0)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
