import json

import pytest
from pyspark.sql import functions as F

from quarry.functions.encode import decode, encode
from quarry.operators.tokenizer import pair_counts, pretoken_counts, roundtrip_report, train_bpe, word_symbols

tokenizers = pytest.importorskip("tokenizers")
SPECIALS = ["<unk>", "<s>", "</s>", "<|im_start|>", "<|im_end|>"]


def _reference(texts, vocab_size):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers
    from tokenizers.normalizers import NFKC
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.normalizer = NFKC()
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tr = trainers.BpeTrainer(vocab_size=vocab_size, special_tokens=SPECIALS, min_frequency=2, show_progress=False,
                             initial_alphabet=pre_tokenizers.ByteLevel.alphabet())
    tok.train_from_iterator(texts, trainer=tr)
    return tok


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 40").select("text")
    texts = [r.text for r in docs.collect()]
    model = train_bpe(docs, vocab_size=330)
    return docs, texts, model, _reference(texts, 330)


def test_train_bpe_equals_reference_merges(trained):
    _, _, model, ref = trained
    j = json.loads(ref.to_str())
    voc = j["model"]["vocab"]
    ref_merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
    ref_ids = [(voc[a], voc[b], voc[a + b]) for a, b in ref_merges]
    assert [m for m in model.merges] == ref_ids
    assert model.vocab_size == len(voc)
    assert all(voc[s] == i for i, s in enumerate(SPECIALS))
    assert ref_ids[0][2] == 261


def test_encode_decode_with_merges_equal_reference(spark, trained):
    _, texts, model, ref = trained
    samples = texts[:15] + ["<|im_start|>user\nHello<|im_end|>\n", "ｆｕｌｌ width ﬁ", ""]
    df = spark.createDataFrame([(t,) for t in samples], "t string")
    got = df.select(encode(F.col("t"), model).alias("ids")).collect()
    for t, r in zip(samples, got):
        assert r.ids == ref.encode(t).ids, t[:60]
    dec = df.select(decode(encode(F.col("t"), model, normalize=False), model).alias("d")).collect()
    assert [r.d for r in dec] == samples


def test_roundtrip_report_all_equal(spark, trained):
    docs, _, model, _ = trained
    rep = roundtrip_report(docs.withColumn("g", F.lit(1)), ["g"], model).collect()[0]
    assert rep.equal_rate == 1.0


def test_pair_counts_overlapping(spark):
    words = spark.createDataFrame([("aaa", 2), ("ab", 3)], "word string, freq long")
    st = word_symbols(words)
    got = {r.pair: r.cnt for r in pair_counts(st).collect()}
    from quarry.operators.tokenizer import sym_char
    from quarry.functions.bytes import byte_to_id
    a, b = sym_char(byte_to_id()[ord("a")]), sym_char(byte_to_id()[ord("b")])
    assert got == {a + a: 4, a + b: 3}


def test_pretoken_counts(spark):
    df = spark.createDataFrame([("the cat the",), ("the",)], "text string")
    got = {r.word: r.freq for r in pretoken_counts(df).collect()}
    assert got == {"the": 2, " cat": 1, " the": 1}


def test_few_tracked_pairs_same_merges(spark, trained):
    """With a small bound the counts are taken anew whenever the best pair comes down to the floor."""
    docs, _, model, _ = trained
    assert train_bpe(docs, vocab_size=330, tracked=3).merges == model.merges


@pytest.mark.parametrize("texts", [["aaaa aaa aa aaaaaaa " * 3, "aaaaa"], ["abab ababab abcabc abc bca"] * 2, ["x"], [""],
                                   ["the thin thick this that then " * 4 + "ヴァ が ﬁﬁ été été"] * 3])
def test_train_bpe_small_texts(spark, texts):
    """Runs of one letter, repeated strings, words of one symbol; until no pair is left."""
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    voc = json.loads(_reference(texts, 400).to_str())["model"]
    merges = [m.split(" ", 1) if isinstance(m, str) else m for m in voc["merges"]]
    assert list(train_bpe(df, vocab_size=400).merges) == [(voc["vocab"][a], voc["vocab"][b], voc["vocab"][a + b]) for a, b in merges]


def test_choose_equals_one_at_a_time(spark):
    """Merges taken together are those that a plain loop takes one after another."""
    import random

    from quarry.operators.bpe_index import choose, merge_all, pair_keys, symbols, sym_char

    for seed in range(30):
        rng = random.Random(seed)
        words = [[rng.randrange(5) for _ in range(rng.randrange(1, 9))] for _ in range(60)]
        freq = [rng.randrange(1, 9) for _ in words]

        def counted(state):
            ids, word = state
            out = {}
            for k, w in zip(*(x.tolist() for x in pair_keys(ids, word))):
                out[k >> 32, k & 0xFFFFFFFF] = out.get((k >> 32, k & 0xFFFFFFFF), 0) + freq[w]
            return sorted(((a, b, n) for (a, b), n in out.items()), key=lambda t: (-t[2], t[0], t[1]))

        state, new = symbols(["".join(map(sym_char, w)) for w in words]), 100
        for _ in range(12):
            taken = choose(counted(state), 0)
            for a, b, n in taken:
                assert counted(state)[0] == (a, b, n)
                state = merge_all(*state, [(a, b, new)])
                new += 1
            if not counted(state):
                break


def test_index_reads_only_the_words_of_a_border(spark):
    """A round's scan leaves out the files that hold other pairs."""
    from quarry.operators.bpe_index import Version, sym_char

    words = [("".join(sym_char(i + k) for k in range(3)), 1) for i in range(3000)]
    version = Version(spark.createDataFrame(words, "sym string, freq long").repartition(4), 0)
    assert sorted(version.changes([], [(7, 8, 5000)])) == sorted(
        [(7, 8, -2), (6, 7, -1), (8, 9, -1), (6, 5000, 1), (5000, 9, 1)])
    # 7 8 was merged: its border with 9 is 8 9
    assert sorted(version.changes([(7, 8, 5000)], [(5000, 9, 5001)])) == [(5000, 9, -1)]
    files = {r.f: r.n for r in version.index.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()}
    hit = version.index.where(F.col("pair") == sym_char(7) + sym_char(8))
    assert len(files) > 1 and {r.f for r in hit.select(F.input_file_name().alias("f")).distinct().collect()} < set(files)
    assert "PushedFilters: [IsNotNull(pair), EqualTo(pair" in hit._jdf.queryExecution().toString()


def test_roundtrip_report_truncated(spark):
    df = spark.createDataFrame([("a" * 300, 1), ("é" * 100, 1), ("short", 1)], "text string, g int")
    rep = roundtrip_report(df, ["g"], max_length=256).collect()[0]
    # truncated texts no longer decode to the whole text; 'é' * 100 is 200 byte ids and fits
    assert (rep.n_rows, rep.n_equal) == (3, 2)


def test_decode_of_cut_characters(spark):
    """Ids that end inside a character decode to U+FFFD, and the cut round trip reports instead of failing."""
    text = "a" * 255 + "é"
    df = spark.createDataFrame([(text, 1), ("short é", 1)], "text string, g int")
    got = df.select(decode(F.slice(encode(F.col("text")), 1, 256)).alias("d")).collect()
    assert [r.d for r in got] == ["a" * 255 + "\ufffd", "short é"]
    rep = roundtrip_report(df, ["g"], max_length=256).first()
    assert (rep.n_rows, rep.n_equal) == (2, 1)


def test_word_encoder_equals_repeated_scans():
    import random

    from quarry.functions.encode import make_word_encoder
    rng = random.Random(0)
    merges, new = [], 261
    for _ in range(60):
        merges.append((rng.randrange(66, 70) if rng.random() < 0.5 else rng.randrange(261, new + 1) if new > 261 else 66,
                       rng.randrange(66, 70) if rng.random() < 0.5 else rng.randrange(261, new) if new > 261 else 67, new))
        new += 1
    enc = make_word_encoder(merges)
    ranks = {}
    for r, (a, b, n) in enumerate(merges):
        ranks[(a, b)] = (r, n)

    def scan(syms):
        while True:
            best = min((ranks[p] for p in zip(syms, syms[1:]) if p in ranks), default=None)
            if best is None:
                return syms
            out, i = [], 0
            while i < len(syms):
                if i + 1 < len(syms) and ranks.get((syms[i], syms[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(syms[i])
                    i += 1
            syms = out

    from quarry.functions.bytes import byte_to_id
    for _ in range(300):
        w = "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 40)))
        assert enc(w) == scan([byte_to_id()[b] for b in w.encode()]), w
    assert len(enc("ab" * 100_000)) > 0  # no quadratic scan


def test_dictionary_encoding_equals_encoding_in_place(spark, trained, monkeypatch):
    """Nulls, empty texts, specials, repeated rows, words in several chunks; columns that clash."""
    from quarry.operators import tokenizer as tk

    _, texts, model, _ = trained
    rows = [(i, t) for i, t in enumerate(texts[:12] + ["", None, "<|im_start|>user\nHello<|im_end|>\n", "ｆｕｌｌ width ﬁ", " the the the"])]
    df = spark.createDataFrame(rows + rows[:2] + [(None, None)], "id int, text string") \
        .selectExpr("*", "1 as word", "2 as ids", "array(9) as input_ids").repartition(3)
    want = sorted(((r.id, r.e) for r in df.select("id", encode(F.col("text"), model).alias("e")).collect()), key=str)
    for size in (200_000, 50):
        monkeypatch.setattr(tk, "CHUNK_WORDS", size)
        out = tk.encode_with_dictionary(df, model)
        assert out.columns == ["id", "text", "word", "ids", "input_ids"]
        assert sorted(((r.id, r.input_ids) for r in out.collect()), key=str) == want
    assert tk.encode_with_dictionary(df.limit(0), model).count() == 0


def _odd_texts():
    import random
    r = random.Random(7)
    parts = ["'", "'s", "'re", "'ll", " ", "  ", "\t", "\n", "　", "\x85", "\x1c", "a", "st", "é", "ﬁ", "中", "😀", "٣", "½", "Ⅷ",
             ".", "<", "<s>", "<|im_end|>", "​", "́"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(400)] + [None, "", "'s's", "a 's", "\n's", "x  ", " "]


def test_pretoken_counts_cut_as_the_pattern_does(spark):
    """Words are cut from character classes as Spark's regex cuts them, and added up in the task: no row for each word."""
    from quarry.functions.text import nfkc, pretokenize
    df = spark.createDataFrame([(t,) for t in _odd_texts()], "t string").repartition(3)
    for normalize in (True, False):
        got = pretoken_counts(df, "t", normalize)
        text = nfkc(F.col("t")) if normalize else F.col("t")
        want = df.select(F.explode(pretokenize(text)).alias("word")).groupBy("word").agg(F.count("*").alias("freq"))
        assert sorted(got.collect()) == sorted(want.collect()) and got.dtypes == want.dtypes
    assert "Generate" not in got._jdf.queryExecution().toString()
    assert pretoken_counts(df.where("false"), "t").collect() == []


def test_words_are_added_up_within_bounds():
    from collections import Counter

    import pyarrow as pa

    from quarry.functions.pretokens import counted
    lists = [[f"w{i * j % 37}" for j in range(20)] for i in range(30)]
    for held in (1, 10, 1000):
        total = Counter()
        for t in counted((pa.array(x, pa.large_string()) for x in lists), held):
            assert t.num_rows <= max(37, held)
            total.update(dict(zip(t.column("word").to_pylist(), t.column("freq").to_pylist())))
        assert total == Counter(w for x in lists for w in x)


def test_index_reads_symbols_from_a_column():
    import pyarrow as pa

    from quarry.operators.bpe_index import column_symbols, sym_char, symbols
    words = ["".join(sym_char(i) for i in x) for x in ([5, 260, 7000], [6399, 6400], [9])]
    for got, want in zip(column_symbols(pa.array(["x", *words]).slice(1)), symbols(words)):
        assert got.tolist() == want.tolist()


def test_dictionary_stores_texts_not_words(spark, monkeypatch):
    """Chunks that end within batches and rows over a chunk; the ids are those of each text alone."""
    from quarry.operators import tokenizer
    texts = _odd_texts() * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(2)
    model = train_bpe(df.select("t"), vocab_size=275, text_col="t")
    want = {r.id: r.x for r in df.select("id", encode(F.col("t"), model).alias("x")).collect()}
    stored, cut = [], tokenizer.cut_lineage
    monkeypatch.setattr(tokenizer, "cut_lineage", lambda rows: stored.append(rows.dtypes) or cut(rows))
    for n in (7, 200_000):
        monkeypatch.setattr(tokenizer, "CHUNK_WORDS", n)
        got = tokenizer.encode_with_dictionary(df, model, "t", "ids")
        assert got.columns == ["id", "t", "ids"]
        assert {r.id: r.ids for r in got.collect()} == want
        assert {r.id: r.t for r in got.collect()} == dict(enumerate(texts))
    assert {r.id: r.t for r in tokenizer.encode_with_dictionary(df, model, "t", "t").collect()} == want
    assert all("array" not in kind for dtypes in stored for _, kind in dtypes)
