import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import packing as pk
from quarry.llm.queries import op7_packing, tokenizer_path
from quarry.sources.tables import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def check_sequences(rows):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_ids_round_trip_and_sequences_have_no_padding(spark, tok):
    docs = table(spark, SF, "documents")
    rows = pk.pack(docs, tokenizer_path()).collect()
    assert check_sequences(rows) == 0
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[d.doc_id], key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist() == ids
        assert all(r.doc_tokens == len(ids) for r in pieces)


def test_query_gives_checksums(spark, tok):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in op7_packing(spark, SF).limit(40).collect():
        ids = tok.encode(docs[r.doc_id], add_special_tokens=False).ids + [1]
        part = np.array(ids[r.start: r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes())


def test_odd_rows(spark, odd_docs, no_docs, tok):
    rows = pk.pack(odd_docs, tokenizer_path()).collect()
    assert check_sequences(rows) == 0
    want = sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(r.length for r in rows) == want
    assert sum(r.doc_id is None for r in rows) >= 2
    assert pk.pack(no_docs, tokenizer_path()).count() == 0


def test_special_strings_and_case(spark, tok):
    texts = ["a<|endoftext|>b <|ENDOFTEXT|> Hello HELLO hello", "İstanbul ﬁ Straße  x  y", "'s 's it's IT'S", "12345 ½ ٣٤"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {}
    for r in sorted(pk.pack(df, tokenizer_path()).collect(), key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == {i: tok.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}


def test_costs_are_balanced_and_pieces_descend():
    rng = np.random.default_rng(0)
    lengths = rng.integers(20, 1800, 400).tolist()
    total = sum(lengths)
    lengths.append(2048 - total % 2048)
    rooms = [2048] * (sum(lengths) // 2048)
    got = pk.assign(lengths, rooms)
    fill, load, parts = [0] * len(rooms), [0.0] * len(rooms), {}
    for piece, start, n, s, offset in got:
        assert offset == fill[s]
        fill[s] += n
        load[s] += pk.cost(n, 1.0, 1 / 2048)
        parts.setdefault(piece, []).append((start, n))
    assert fill == rooms
    for i, n in enumerate(lengths):
        at = 0
        for start, m in sorted(parts[i]):
            assert start == at
            at += m
        assert at == n
    assert max(load) < 1.35 * sum(load) / len(load)
    whole = [n for i, s, n, _, _ in got if s == 0 and n == lengths[i]]
    assert whole == sorted(whole, reverse=True)


def test_window_size_does_not_lose_ids(spark):
    docs = table(spark, SF, "documents").coalesce(1)
    want = pk.pack(docs, tokenizer_path()).agg(F.sum("length")).first()[0]
    rows = pk.pack(docs, tokenizer_path(), window=2).collect()
    assert check_sequences(rows) == 0 and sum(r.length for r in rows) == want
