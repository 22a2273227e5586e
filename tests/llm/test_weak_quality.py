import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import weak_quality as wq
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, where = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i: i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            where.update(p + k for p in at for k in range(3))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(where))


def check(docs, got):
    want = sorted((brute(r.text), r.doc_id is None, r.doc_id) for r in docs.select("doc_id", "text").collect())
    rows = [((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.doc_id is None, r.doc_id) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert 0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_base_figures_and_held_against_labels(spark):
    docs = table(spark, SF, "documents")
    got = wq.quality(docs.select("doc_id", "text"))
    check(docs, got.collect())
    rows = got.join(table(spark, SF, "labels").select("doc_id", F.col("quality").alias("q")), "doc_id").collect()
    clean = [r for r in rows if r.q == 1 and not r.base_failed]
    junk = [r for r in rows if r.q == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.95 * len(junk)


def test_odd_rows(spark, odd_docs, no_docs):
    got = wq.quality(odd_docs)
    assert "text" not in got.columns and got.columns.count("n_words") == 1 and "key" in got.columns
    check(odd_docs, got.collect())
    assert wq.quality(no_docs).count() == 0


def brute_em(rows, n_rules, kinds):
    """EM over single documents' votes in plain Python."""
    share, own, other = wq.START
    shares = [1 - share * len(kinds)] + [share] * len(kinds)
    rates = [[other] + [own if r in kind else other for kind in kinds] for r in range(n_rules)]
    pad = wq.SMOOTH * len(rows)

    def post(votes):
        p = [s * math.prod(rates[r][k] if v < 0 else 1 - rates[r][k] for r, v in enumerate(votes) if v) for k, s in enumerate(shares)]
        return [x / sum(p) for x in p]

    for _ in range(wq.STEPS):
        got = [post(v) for v in rows]
        new = [(sum(g[k] for g in got) + pad) / (len(rows) + len(shares) * pad) for k in range(len(shares))]
        table = []
        for r in range(n_rules):
            found = []
            for k in range(len(shares)):
                bad, good = (sum(g[k] for g, v in zip(got, rows) if v[r] == x) for x in (-1, 1))
                found.append((bad + pad) / (bad + good + 2 * pad))
            table.append([found[0]] + [max(x, found[0]) for x in found[1:]])
        moved = max(abs(a - b) for x, y in [(shares, new), *zip(rates, table)] for a, b in zip(x, y))
        shares, rates = new, table
        if moved < wq.TOLERANCE:
            break
    return shares, rates, post


def planted(rng, n=1500):
    """Two kinds of junk, each seen by two good rules; e votes by chance.  (votes of a b c d e, kind)"""
    rows = []
    for _ in range(n):
        kind = rng.choices([0, 1, 2], [0.8, 0.12, 0.08])[0]
        votes = [(-1 if rng.random() < (0.95 if kind == k else 0.03) else 1) if rng.random() < 0.9 else 0 for k in (1, 1, 2, 2)]
        rows.append(((*votes, -1 if rng.random() < 0.1 else rng.choice([0, 1])), kind))
    return rows


def test_em_against_brute_force_and_an_outvoted_bad_vote(spark):
    rows = planted(random.Random(2))
    kinds = [["a", "b", "e"], ["c", "d"]]
    df = spark.createDataFrame([r for r, _ in rows], [f"_v_{x}" for x in "abcde"])
    patterns = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    shares, rates = wq.estimate(patterns, list("abcde"), kinds)
    want_shares, want_rates, post = brute_em([r for r, _ in rows], 5, [[0, 1, 4], [2, 3]])
    assert shares == pytest.approx(want_shares, abs=1e-6)
    assert [rates[x] for x in "abcde"] == [pytest.approx(w, abs=1e-6) for w in want_rates]
    # shares and accuracies are found, and the rule that votes by chance weighs next to nothing
    assert shares[0] == pytest.approx(0.8, abs=0.06) and rates["a"][1] > 0.8 and rates["c"][2] > 0.8
    assert max(rates["e"]) < 2 * min(rates["e"])
    got = {tuple(r[:5]): r.good for r in df.distinct().select("*", wq.posteriors(list("abcde"), shares, rates)[0].alias("good")).collect()}
    assert got == {v: pytest.approx(post(v)[0], abs=1e-6) for v in got}
    # one bad vote that its fellow rule does not share is outvoted; two together are not, nor by the other kind's rules
    assert post((-1, 1, 1, 1, 1))[0] > 0.5 and post((1, 1, 1, 1, -1))[0] > 0.9 and post((1, 1, -1, 1, 1))[0] > 0.5
    assert post((-1, -1, 1, 1, 1))[0] < 0.1 and post((1, 1, -1, -1, 1))[0] < 0.1
    clean = [post(v)[0] for v, kind in rows if kind == 0]
    assert sum(x > 0.5 for x in clean) > 0.98 * len(clean)


def test_em_of_an_empty_table_is_the_start(spark):
    none = spark.createDataFrame([], "_v_a int, n long")
    assert wq.estimate(none, ["a"], [["a"]]) == ([1 - wq.START[0], wq.START[0]], {"a": [wq.START[2], wq.START[1]]})


def test_a_document_that_one_rule_misreads_is_kept(spark):
    """A clean text in long words fails word_size alone, and stays; junk with the same word size goes."""
    rng = random.Random(5)
    plain = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(150)) for _ in range(300)]
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(150))
    junk = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) + rng.choice(["###", "$$$"]) for _ in range(150)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(plain + [long] + junk)), "doc_id long, text string")
    got = {r.doc_id: (r.quality, r.kept) for r in wq.quality(df).collect()}
    votes = wq.text_figures(df.where("doc_id = 300"), "text").select(*[v.alias(r) for r, v in wq.rules().items()]).first().asDict()
    assert [r for r, v in votes.items() if v == -1] == ["word_size"]
    assert got[300][1] and got[300][0] > 0.5 and all(got[i][1] for i in range(300))
    assert not any(got[301 + i][1] for i in range(40))
