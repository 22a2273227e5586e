import random

import pytest

from quarry.llm import suffix_dedup as sd
from quarry.sources.tables import table


def brute(rows, n=50):
    """Maximal runs of words covered by n-word windows that stand in another document."""
    docs = {}
    for i, t in rows:
        if t is not None:
            docs[(i, t)] = t.encode().lower().split()
    where = {}
    for d, w in docs.items():
        for k in range(len(w) - n + 1):
            where.setdefault(tuple(w[k: k + n]), set()).add(d)
    out = set()
    for d, w in docs.items():
        covered = [False] * len(w)
        for k in range(len(w) - n + 1):
            if len(where[tuple(w[k: k + n])]) > 1:
                covered[k: k + n] = [True] * n
        k = 0
        while k < len(w):
            if covered[k]:
                a = k
                while k < len(w) and covered[k]:
                    k += 1
                out.add((d[0], a, k))
            k += 1
    return out


def spans(df):
    rows = df.collect()
    assert all(r.n_words == r.end_word - r.first_word >= 50 for r in rows)
    return {(r.doc_id, r.first_word, r.end_word) for r in rows}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_spans_equal_brute_force(spark, sf):
    docs = table(spark, f"/root/testdata/sf{sf}", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert want and spans(sd.repeated_passages(docs)) == want


def words(rng, n):
    return [f"w{rng.randrange(10_000)}" for _ in range(n)]


def test_hot_passage_in_many_places_and_partitions(spark):
    rng = random.Random(1)
    passage = words(rng, 70)
    rows = []
    for i in range(120):
        w = words(rng, rng.randrange(0, 60))
        if i % 3 == 0:
            w += passage
        elif i % 3 == 1:
            w += passage[:49]
        rows.append((i, " ".join(w + words(rng, rng.randrange(0, 60)))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len(want) == 40
    assert spans(sd.repeated_passages(df)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert spans(sd.repeated_passages(df)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_repeats_inside_one_document_do_not_count(spark):
    rng = random.Random(2)
    p = " ".join(words(rng, 60))
    df = spark.createDataFrame([(1, f"{p} x {p} y {p}"), (2, " ".join(words(rng, 200)))], "doc_id long, text string")
    assert sd.repeated_passages(df).count() == 0
    more = df.union(spark.createDataFrame([(3, f"{p} z")], df.schema))
    assert spans(sd.repeated_passages(more)) == brute([tuple(r) for r in more.collect()])


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert spans(sd.repeated_passages(odd_docs)) == brute(rows)
    assert sd.repeated_passages(no_docs).count() == 0
