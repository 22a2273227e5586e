import json
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions.bytes import byte_ids, byte_to_id
from quarry.functions.encode import decode, encode
from quarry.functions.text import NFKC_STABLE_CLASS, nfkc, pretokenize, split_specials
from quarry.operators.chunk import split_text

tokenizers = pytest.importorskip("tokenizers")


def test_split_text_emoji_and_empty(spark):
    df = spark.createDataFrame([(1, "a😀ba😀ba😀b"), (2, "")], "id long, text string")
    out = split_text(df, n=4).orderBy("id", "chunk_idx").collect()
    assert [(r.id, r.chunk_idx, r.text) for r in out] == [(1, 0, "a😀ba"), (1, 1, "😀ba😀"), (1, 2, "b")]


def test_byte_alphabet_matches_bytelevel_ids():
    # the trained vocabulary lists specials, then the 256 byte symbols in code-point order
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tr = trainers.BpeTrainer(vocab_size=261, special_tokens=["<unk>", "<s>", "</s>", "<|im_start|>", "<|im_end|>"],
                             min_frequency=2, show_progress=False,
                             initial_alphabet=pre_tokenizers.ByteLevel.alphabet())
    tok.train_from_iterator(["hello world"], trainer=tr)
    vocab = json.loads(tok.to_str())["model"]["vocab"]
    b2i = byte_to_id()
    for text in ["hello", "é", "😀", "\n\t ", "\x00\x7f\xad"]:
        ref = tok.encode(text).ids
        assert ref == [b2i[b] for b in text.encode("utf-8")], text
    assert len(vocab) == 261 and byte_to_id()[ord("!")] == 5 and byte_to_id()[173] == 260


def test_byte_ids_and_decode_roundtrip(spark):
    texts = ["", "abc", "é😀\n", "<|im_start|>user\nhi<|im_end|>\n", "x<s>y</s><unk>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(byte_ids(F.col("t")).alias("i"),
                    encode(F.col("t"), normalize=False).alias("e")).collect()
    b2i = byte_to_id()
    for t, r in zip(texts, out):
        assert r.i == [b2i[b] for b in t.encode("utf-8")]
    assert out[3].e[0] == 3 and 4 in out[3].e
    assert out[4].e[1:5] == [1] + [b2i[ord(c)] for c in "y"] + [2, 0]
    dec = df.select(decode(encode(F.col("t"), normalize=False)).alias("d")).collect()
    assert [r.d for r in dec] == texts


def test_split_specials_pieces(spark):
    df = spark.createDataFrame([("a<|im_start|>b<c</s>",), ("plain < text",)], "t string")
    out = [r.p for r in df.select(split_specials(F.col("t")).alias("p")).collect()]
    assert out == [["a", "<|im_start|>", "b<c", "</s>"], ["plain < text"]]


def test_pretokenize_matches_bytelevel(spark):
    from tokenizers import pre_tokenizers
    pt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    samples = ["Hello world!  It's  2024...\n\nNew line\t tab", "  leading spaces", "trailing   ",
               "ünïcödé wörds ça va? ¿Qué?", "numbers 12345 and ٣٤٥", "mixed—dash’s and “quotes”", "a\r\nb",
               "don't I'll we've they're", "!!!???", "日本語のテキスト、です。"]
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).collect()]
    samples += docs
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r.p for r in df.select(pretokenize(F.col("t")).alias("p")).collect()]
    b2u = {}
    from quarry.functions.bytes import byte_to_symbol
    for b, c in enumerate(byte_to_symbol()):
        b2u[chr(c)] = b
    for s, g in zip(samples, got):
        ref = [bytes(b2u[c] for c in w).decode("utf-8") for w, _ in pt.pre_tokenize_str(s)]
        assert g == ref, s


def test_nfkc_whitelist_is_stable():
    import re
    rx = re.compile("^[%s]*$" % NFKC_STABLE_CLASS.replace("\\\\", "\\"))
    stable = [chr(cp) for cp in range(0x10000) if not 0xD800 <= cp < 0xE000 and rx.match(chr(cp))]
    assert {"é", "ж", "Ω", "한", "か", "—", "“", "中"} <= set(stable)
    for ch in stable:
        assert unicodedata.normalize("NFKC", ch) == ch, hex(ord(ch))
        assert unicodedata.combining(ch) == 0, hex(ord(ch))
    # no two of them compose: the second character of every composition is outside the set
    pairs = [unicodedata.decomposition(chr(cp)).split() for cp in range(0x10000)]
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    assert not seconds & set(stable)


def test_nfkc_udf(spark):
    texts = ["ｆｕｌｌｗｉｄｔｈ", "ﬁ ligature", "plain", "é", None, "①"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(nfkc(F.col("t")).alias("n")).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]


def test_bos_prefix_identity(spark):
    """Q12 prepends id 3 instead of encoding BOS + text: the two must agree."""
    from quarry.functions.text import add_bos
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect()]
    texts = docs + ["|>tail", "<|im_end|>x", "", "im_start|>", "̸after"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(encode(add_bos(F.col("t"))).alias("a"),
                    F.concat(F.array(F.lit(3)), encode(F.col("t"))).alias("b")).collect()
    assert all(r.a == r.b for r in out)


def test_long_html_with_specials_roundtrip(spark):
    """Long texts full of '<' plus special strings: split path without regex recursion."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(
        F.concat(F.lit("<|im_start|>"), F.col("html"), F.lit("<|im_end|>\n<s>")).alias("t"))
    out = pages.select((decode(encode(F.col("t"))) == F.col("t")).alias("ok"),
                       F.length("t").alias("n")).collect()
    assert out and all(r.ok for r in out)


def test_nfkc_of_columns_equals_unicodedata():
    """All code points, alone and with their neighbours, nulls, empty texts, and batches that use every control byte."""
    import random
    import unicodedata

    import pyarrow as pa

    from quarry.functions.text import nfkc_column

    def check(texts, kind=pa.string()):
        want = [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
        got = nfkc_column(pa.array(texts, kind))
        assert got.type == kind and got.to_pylist() == want

    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check(points)
    check([p for p in points if p not in map(chr, range(32))])
    marks = [c for c in points if unicodedata.combining(c)]
    rng = random.Random(4)
    mixed = ["".join(rng.choice(points[:0x3100] if rng.random() < 0.6 else marks) for _ in range(rng.randrange(6))) for _ in range(20_000)]
    check([m.translate({c: None for c in range(32)}) for m in mixed] + ["", None, "e", "\u0301", None])
    check(["\u0301", "e", None, "", "\u0301x"], pa.large_string())
    check([None, None])
    check([])
    check(["plain", "ascii", None])
    sliced = pa.array(["xx", "e\u0301", None, "ﬁ", "yy"])[1:4]
    assert nfkc_column(sliced).to_pylist() == ["é", None, "fi"]


def test_column_encoding_equals_piecewise():
    """Specials across row and batch borders, combining marks after a special, nulls, slices."""
    import random
    import re
    import unicodedata

    import pyarrow as pa

    from quarry.constants import SPECIAL_TOKENS
    from quarry.functions.encode import byte_level_ids

    b2i = byte_to_id()
    special = re.compile("(" + "|".join(re.escape(s) for s in sorted(SPECIAL_TOKENS, key=len, reverse=True)) + ")")

    def slow(t, normalize):
        if t is None:
            return None
        out = []
        for piece in special.split(t):
            if piece in SPECIAL_TOKENS:
                out.append(SPECIAL_TOKENS.index(piece))
            else:
                out += [b2i[b] for b in (unicodedata.normalize("NFKC", piece) if normalize else piece).encode()]
        return out

    rng = random.Random(7)
    bits = SPECIAL_TOKENS + ["<|im_st", "art|>", "<s", ">", "</s", "\u0338", "e", "\u0301", "ﬁ", "漢", " ", "", "<<s>>", "\x00"]
    for _ in range(40):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(7))) for _ in range(30)]
        for normalize in (True, False):
            want = [slow(t, normalize) for t in texts]
            assert byte_level_ids(pa.array(texts, pa.string()), normalize).to_pylist() == want
            assert byte_level_ids(pa.array(texts, pa.string())[5:20], normalize).to_pylist() == want[5:20]
    assert byte_level_ids(pa.array([], pa.string()), True).to_pylist() == []


def test_packed_ids_equal_arrays(spark):
    from quarry.functions import arrays, idbytes

    df = spark.createDataFrame([(i, list(range(i, 3 * i))) for i in range(8)] + [(9, None)], "k int, ids array<int>")
    b = idbytes.pack_ids("ids")
    p, a = idbytes.pad_right(b, 6, 4), arrays.pad_right(arrays.truncate(F.col("ids"), 6), 6, 4)
    pairs = [(idbytes.unpack_ids(b), F.col("ids")), (idbytes.unpack_ids(idbytes.truncate(b, 3)), arrays.truncate(F.col("ids"), 3)),
             (idbytes.unpack_ids(p), a), (idbytes.unpack_ids(idbytes.shift_x(p, 6)), arrays.shift_x(a)),
             (idbytes.unpack_ids(idbytes.shift_y(p, 6)), arrays.shift_y(a)), (idbytes.n_ids(b), F.size("ids")),
             (idbytes.unpack_ids(idbytes.prepend(3, b)), F.concat(F.array(F.lit(3)), "ids"))]
    for r in df.select("k", *[F.struct(x.alias("x"), y.alias("y")).alias(f"p{i}") for i, (x, y) in enumerate(pairs)]).collect():
        for c in r[1:]:
            assert c.x == c.y or r.k == 9


def test_ids_are_made_a_slice_at_a_time():
    """What a batch of long texts takes besides its ids (32 MB here) is bounded by a slice, and counts keep no ids."""
    import tracemalloc

    from quarry.functions.bytes import SLICE_BYTES, text_slices
    from quarry.functions.encode import byte_level_counts, byte_level_ids

    texts = [None, "", "<s>é", *["ab<unk>" + "x" * 99_993] * 80, "", None, "y" * (2 * SLICE_BYTES), ""]
    col = pa.array(texts)
    slices = text_slices(col)
    assert [x for s in slices for x in s.to_pylist()] == texts and len(slices) > 8
    assert [s.to_pylist() for s in text_slices(col.slice(0, 0))] == [[]]
    tracemalloc.start()
    ids = byte_level_ids(col, False)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    counts = byte_level_counts(col, True)
    least = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.to_pylist() == [None, 0, 3, *[99_996] * 80, 0, None, 2 * SLICE_BYTES, 0]
    assert [None if x is None else len(x) for x in ids.to_pylist()] == counts.to_pylist()
    assert ids[3].as_py()[:4] == [*byte_level_ids(pa.array(["ab"]), False)[0].as_py(), 0, byte_level_ids(pa.array(["x"]), False)[0].as_py()[0]]
    assert most < 80e6 and least < 60e6


def test_split_specials_in_one_pass(spark):
    """Specials are found from '<' to '<', with no look back at every place; long texts need no stack."""
    n = 300_000
    texts = ["<s>" + "x" * n + "<|im_end|><unk>" + "<" * n, "a<<s>>b<|im_start|", "</s></s>", "<s\n>\n<unk>\n", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(split_specials(F.col("t")).alias("p"))
    assert [r.p for r in df.collect()] == [["<s>", "x" * n, "<|im_end|>", "<unk>", "<" * n], ["a<", "<s>", ">b<|im_start|"],
                                           ["</s>", "</s>"], ["<s\n>\n", "<unk>", "\n"], [], None]
    assert "(?<=" not in df._jdf.queryExecution().toString()
