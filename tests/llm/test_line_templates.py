import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import line_templates as lt
from quarry.llm import vec
from quarry.sources.tables import table


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(40):
        lines = [words(rng, 12) for _ in range(4)]
        if i % 2:
            lines.insert(rng.randrange(5), "All rights are reserved by us.")
        if i % 4 == 0:
            lines.insert(rng.randrange(5), f"Posted on 2024-01-{i:02d} by the editors of issue {i}.")
        if i % 5 == 0:
            lines.append(f"Read the next long story about the {words(rng, 1)} here in our paper now.")
        lines.insert(1, "")
        rows.append((i, "\n".join(lines)))
    copy = "\n".join(words(rng, 12) for _ in range(6))
    rows += [(100 + i, copy) for i in range(30)]  # whole copies are no boiler-plate
    return rows


def expected(text):
    keep = [x for x in text.split("\n")
            if not x.startswith(("All rights are", "Posted on", "Read the next long story"))]
    return "\n".join(keep)


def test_recurring_templates_are_cut_and_the_rest_stays(spark):
    rows = corpus()
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).collect()
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.text == expected(text[r.doc_id])
        assert r.n_lines == len(text[r.doc_id].split("\n")) and r.n_dropped == r.n_lines - len(r.text.split("\n"))


@pytest.mark.parametrize("names", [6, 300, 1500, 2600, 20_000])
def test_variable_fields_are_generalised_at_any_number(spark, names):
    """Every name once; the same result however many lines the leaf has."""
    rng = random.Random(names)
    rows = [(i, f"{words(rng, 30)}\nRead the next long story about the {words(rng, 1)}{i} here in our paper now.".replace(str(i), ""))
            for i in range(names)]
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: t.split("\n")[0] for i, t in rows}


def test_leaf_filter_keeps_all_leaves(spark):
    rng = random.Random(8)
    leaves = [rng.randrange(-2**63, 2**63) for _ in range(3000)] + [0, 1, 32767, 32768, 32769, lt.FILTER_BITS - 1, lt.FILTER_BITS, -1]
    got = lt.leaf_filter(spark.createDataFrame([(x,) for x in leaves], "leaf long"))
    assert set(np.flatnonzero(got).tolist()) == {x % lt.FILTER_BITS for x in leaves}


def brute(rows, min_docs=5):
    """The definition, line by line; every document is unrelated to all others but its equals."""
    lines = [(i, k, x.split()) for i, t in rows for k, x in enumerate(t.split("\n")) if x.split()]
    masked = [tuple("#" if any(c.isdigit() for c in w) else w for w in ws) for _, _, ws in lines]
    leaf = [(len(m), m[: lt.DEPTH]) for m in masked]
    at = Counter((f, p, w) for f, m in zip(leaf, masked) for p, w in enumerate(m) if p >= lt.DEPTH)
    shape = [(f, tuple(w if p < lt.DEPTH or at[f, p, w] >= min_docs else None for p, w in enumerate(m))) for f, m in zip(leaf, masked)]
    docs = {}
    text = dict(rows)
    for (i, _, ws), (f, t) in zip(lines, shape):
        if len(ws) >= lt.MIN_WORDS and sum(w is not None for w in t) >= lt.SIMILAR * len(t):
            docs.setdefault((f, t), set()).add(text[i])
    gone = {(i, k) for (i, k, _), s in zip(lines, shape) if len(docs.get(s, ())) >= min_docs}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


@pytest.mark.parametrize("seed", range(3))
def test_templates_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lines = [words(rng, 45)]
        for _ in range(rng.randrange(6)):
            n = rng.randrange(2, 13)
            line = [f"lead{rng.randrange(2)}"] * min(n, lt.DEPTH) + [f"t{p}{rng.choice('ab') if rng.random() < 0.9 else words(rng, 1)}" for p in range(n - lt.DEPTH)]
            line[rng.randrange(n)] += rng.choice(["", "", "7", str(i)])
            lines.insert(rng.randrange(len(lines) + 1), "  ".join(line))
        rows.append((i, "\n".join(lines)))
    rows += [(100 + i, rows[0][1]) for i in range(7)]
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.text for r in got} == brute(rows)


def test_sketches_tell_copies_from_strangers():
    rng = random.Random(9)
    base = words(rng, 400).split()
    near = [" ".join(base[:k] + ["x"] + base[k + 1:]) for k in (3, 99, 200)]
    far = [words(rng, 400), words(rng, 3), "", "a b c d", " ".join(base[:60]) + " " + words(rng, 340)]
    found = lt.sketches(vec.Hasher().words(*vec.column_bytes(pa.array([" ".join(base)] + near + far))))
    assert lt.related(found[0], found).tolist() == [True] * 4 + [False] * 5


def test_blocks_of_several_lines_go_whole(spark):
    rng = random.Random(6)
    head, foot = [[words(rng, 6) for _ in range(5)] for _ in range(2)]
    body = {i: [words(rng, 12) for _ in range(4)] for i in range(20)}
    rows = [(i, "\n".join(head + x + foot)) for i, x in body.items()]
    long = [words(rng, 12) for _ in range(30)]
    near = {100 + i: "\n".join(x + " indeed" if k == i else x for k, x in enumerate(long)) for i in range(30)}
    rows += near.items()  # near copies, each edited in another line, are no boiler-plate
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: "\n".join(x) for i, x in body.items()} | near


def test_copies_do_not_hide_a_footer(spark):
    rng = random.Random(7)
    foot = "All rights are reserved by us."
    rows = [(i, f"{words(rng, 40)}\n{foot}") for i in range(10)]
    rows += [(100 + i, rows[0][1]) for i in range(90)]
    got = lt.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: x.split("\n")[0] for i, x in rows}


def test_documents_lose_the_licence_lines_only(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r.text for r in lt.drop_recurring_lines(docs).select("doc_id", "text").collect()}
    text = {d.doc_id: d.text for d in docs.collect()}
    where = {}
    for i, t in text.items():
        for x in t.split("\n"):
            where.setdefault(x, set()).add(i)
    lost = set()
    for i, t in text.items():
        after = got[i].split("\n") if got[i] or not t else []
        keep = [x for x in t.split("\n") if x in after]
        assert keep == after  # whole lines go, all copies of a line alike
        lost |= set(t.split("\n")) - set(after)
    assert any("License" in x for x in lost) and all(len(where[x]) >= lt.MIN_DOCS for x in lost)
    assert all(x in lost for x in where if "Licen" in x and len(x) < 80 and len(where[x]) >= lt.MIN_DOCS)


def test_odd_rows(odd_docs, no_docs):
    got = lt.drop_recurring_lines(odd_docs)
    assert got.columns == odd_docs.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, odd_docs.collect()))
    counted = lt.drop_recurring_lines(odd_docs.select("doc_id", "text"), counts=True).collect()
    assert all(r.n_dropped == 0 and r.n_lines == (0 if r.text is None else r.text.count("\n") + 1) for r in counted)
    assert lt.drop_recurring_lines(no_docs).count() == 0
