import itertools
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import url_filter as uf
from quarry.llm.queries import op9_url_filter
from quarry.sources.tables import table

SF = "/root/testdata/sf0.01"
ODD = ["http://WWW.Example.COM/en/x?q#f", "https://example.com", "https://example.com?x", "ftp://a.net/es/1", "nothing", "",
       None, "http://xexample.com/en/", "http://b.example.com/en", "://net/fr/", "http://u:p@net/fr/a://b", "a://b.c\n/d?e",
       "http://", "http:///es/", "http://example.com/EN/"]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for what, h, p in uf.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, what)
    return host, path, *(best or (None, None))


def test_hosts_paths_and_rules(spark):
    urls = [r.url for r in table(spark, SF, "pages").collect()]
    for r in op9_url_filter(spark, SF).collect():
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict == ("block" if r.block_odds > 0 else "allow")


def test_odd_rows(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(ODD)] + [(None, None, "x"), (0, ODD[0], "y")],
                               "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as verdict", "3 as token")
    rows = uf.judge(df).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        want = brute(None if r.page_id is None else ODD[r.page_id])
        assert (r.host, r.path, r.rule) == want[:3] and r.verdict in ("allow", "block")
    assert uf.judge(df.limit(0)).count() == 0


def test_viterbi_is_optimal():
    seg = uf.Segmenter({"a": 5, "ab": 3, "abc": 2, "bc": 9, "c": 4, "the": 50, "rein": 3, "there": 20, "in": 40})
    for text in ("", "abc", "abcabc", "therein", "xtherey", "cab"):
        def cost(parts):
            return sum(seg.cost.get(p, seg.unknown(len(p))) for p in parts)
        every = [[text[a:b] for a, b in zip((0, *cut), (*cut, len(text)))]
                 for k in range(max(len(text), 1)) for cut in itertools.combinations(range(1, len(text)), k)] if text else [[]]
        got = seg.split(text)
        assert "".join(got) == text and cost(got) == pytest.approx(min(map(cost, every)))


def test_naive_bayes_scores(spark):
    import math
    rows = [(1, "http://goodnews.net/es/a"), (2, "http://badcasino.net/fr/b"), (3, "http://badcasino.com/x"),
            (4, "http://goodnews.com/y"), (5, "http://goodnews.com/y/z"), (6, "http://badcasino.org/q"), (7, "http://goodnews.org/q")]
    html = "<p>good good news news bad bad casino casino</p>"
    got = {r.page_id: r for r in uf.judge(spark.createDataFrame([(i, u, html) for i, u in rows],
                                                               "page_id long, url string, html string")).collect()}
    count = {"block": {}, "allow": {}}
    urls = {"block": 0, "allow": 0}
    split = {"goodnews": ["good", "news"], "badcasino": ["bad", "casino"]}
    for i, u in rows:
        host, path, rule, verdict = brute(u)
        if rule:
            urls[verdict] += 1
            for t in uf.tokens(host, path, lambda x: split[x]):
                count[verdict][t] = count[verdict].get(t, 0) + 1
    kinds = len(set(count["block"]) | set(count["allow"]))
    for i, host in ((6, "badcasino.org"), (7, "goodnews.org")):
        odds = math.log(urls["block"] / urls["allow"])
        for t in uf.tokens(host, "/q", lambda x: split[x]):
            if t in count["block"] or t in count["allow"]:
                odds += math.log((count["block"].get(t, 0) + 1) / (sum(count["block"].values()) + kinds)) \
                    - math.log((count["allow"].get(t, 0) + 1) / (sum(count["allow"].values()) + kinds))
        assert got[i].block_odds == pytest.approx(odds)


def test_long_words_split_hosts(spark):
    long = "pneumonoultramicroscopicsilicosis" + "x"  # 34 letters
    text = f"{long} " * 12 + "good news good news casino"
    rows = [(1, f"http://{long}goodnews.net/es/a", text), (2, "http://casino.com/x", text), (3, f"http://good{long}.org/q", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    hosts = df.select(uf.host_and_path(F.col("url"))[0].alias("host"))
    got = {(r.host, r.token) for r in uf.host_tokens(hosts, uf.word_counts(df, "html")).collect()}
    assert got == {(f"{long}goodnews.net", t) for t in (f"h:{long}", "h:good", "h:news")} | {("casino.com", "h:casino")} | {
        (f"good{long}.org", t) for t in (f"h:{long}", "h:good")}


def test_very_long_hosts(spark):
    """A host of 100,000 letters is worked off in pieces of a label's length."""
    rows = [(1, "http://" + "goodnews" * 12_500 + ".net/es/a", "good news"), (2, "http://casino.com/x", "casino"),
            (3, "http://" + "goodnews" * 12_500 + ".org/" + "q" * 100_000, None)]
    got = {r.page_id: r for r in uf.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].rule == "net/es/" and got[3].verdict == "block" and len(got[3].host) == 100_004


def test_words_beyond_any_cut_split_hosts(spark):
    # very many words tie at the highest count
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = ["z" + "".join(w) for w in itertools.islice(itertools.product(letters, repeat=4), 50_100)]
    rows = [(1, "http://goodnews.net/es/a", " ".join(many)), (2, "http://badcasino.com/x", "good news bad casino"),
            (3, "http://goodnews.org/q", None), (4, "http://newsgood.org/q", ""), (5, "http://xyxyxy.org/q", None)]
    got = {r.page_id: r.block_odds for r in uf.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == pytest.approx(got[4]) and got[3] > got[5]
