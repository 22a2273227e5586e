import hashlib

import pytest

from quarry.llm import lz_fingerprint as lz
from quarry.sources.tables import table


def phrases(data):
    """LZ78 phrases by plain string comparison."""
    seen, now = set(), b""
    for i in range(len(data)):
        now += data[i: i + 1]
        if now not in seen:
            seen.add(now)
            now = b""
    return seen


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    maker, out = lz.Fingerprinter(), []
    sig = [maker.text(t) for _, t in rows]
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        esig = maker.text(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), lz.as_text(sig[k]), lz.as_text(esig),
                    lz.likeness(sig[k], esig), lz.likeness(sig[k], sig[(k + 1) % len(rows)])))
    return sorted(map(repr, out))


def test_parse_gives_the_lz78_phrases():
    for data in (b"", b"a", b"aaaaaaaaaa", b"abracadabra abracadabra", "é à la é à la".encode()):
        ends = []
        lz.parse(data, {}, ends)
        assert {data[a:b] for a, b in zip([0] + ends, ends)} == phrases(data)


@pytest.mark.parametrize("ranges", [1, 7, None])
def test_pairs_equal_brute_force(spark, ranges):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = lz.edited_pairs(docs, ranges=ranges).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd_docs, no_docs, spark):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    for ranges in (1, 5):
        assert sorted(repr(tuple(r)) for r in lz.edited_pairs(odd_docs, ranges=ranges).collect()) == want
    assert lz.edited_pairs(no_docs).count() == 0
    single = spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")
    r = lz.edited_pairs(single).first()
    assert r.near_next == 1 and r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    prints = lz.fingerprints(odd_docs).collect()
    assert len(prints) == odd_docs.count()


def test_likeness_follows_the_shared_part():
    maker = lz.Fingerprinter()
    a = maker.text(" ".join(f"word{i * 7919 % 1000}" for i in range(400)))
    near = maker.text(" ".join(f"word{i * 7919 % 1000}" for i in range(380)) + " other end")
    far = maker.text(" ".join(f"x{i * 104729 % 1000}y" for i in range(400)))
    assert lz.likeness(a, a) == pytest.approx(1) and lz.likeness(a, near) > 0.75 > lz.likeness(a, far) + 0.3
    assert lz.likeness(None, None) == 1 and lz.likeness(a, None) == 0
