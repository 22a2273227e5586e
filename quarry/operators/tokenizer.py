"""Byte-level BPE tokenizer jobs (K1-K7).

Training (K3) runs on the table of distinct pre-tokens with their corpus frequency and an
inverted index from pairs to words (``bpe_index``).  Each symbol id is one private-use character,
so a word is a string and a pair is a 2-character substring; ties break by (left id, right id).
A round makes several merges at once when one-at-a-time merging provably picks the same ones.
A merge whose string already exists reuses that id, closes the round and has the counts taken anew.
"""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.constants import BOS_ID, EOS_ID, MIN_FREQUENCY, PAD_ID, SPECIAL_TOKENS, UNK_ID, VOCAB_SIZE
from quarry.functions.bytes import FIRST_MERGE_ID, byte_to_id, id_lists, id_to_byte, text_slices
from quarry.functions.encode import BpeModel, decode, encode, joined_lists, token_count, word_ids
from quarry.functions.pretokens import char_classes, count_words, words_of
from quarry.operators import bpe_index
from quarry.operators.bpe_index import sym_char
from quarry.session import cut_lineage


def pretoken_counts(docs: DataFrame, text_col: str = "text", normalize: bool = True) -> DataFrame:
    """K1: corpus frequency of each pre-token (word, freq).  A task adds up its words before they leave it."""
    classes = char_classes(docs.sparkSession)
    return docs.select(F.col(text_col)).mapInArrow(lambda batches: count_words(batches, classes, normalize), "word string, freq long") \
        .groupBy("word").agg(F.sum("freq").alias("freq"))


_BYTE_CHARS = "".join(chr(b) for b in range(256))
_BYTE_SYMBOLS = "".join(sym_char(i) for i in byte_to_id())


def word_symbols(counts: DataFrame) -> DataFrame:
    """(sym, freq): each word as a string of one character per byte symbol.

    The UTF-8 bytes are read as Latin-1 (one character per byte) and mapped to
    their symbol characters with one ``translate``.
    """
    latin = F.decode(F.encode(F.col("word"), "UTF-8"), "ISO-8859-1")
    sym = F.translate(latin, _BYTE_CHARS, _BYTE_SYMBOLS)
    return counts.select(sym.alias("sym"), F.col("freq").cast("long").alias("freq"))


def pair_counts(state: DataFrame) -> DataFrame:
    """K2: frequency-weighted counts of adjacent symbol pairs (overlapping pairs counted).

    One linear regex pass per word yields all overlapping 2-symbol windows.
    """
    return state.select(F.explode(_pair_windows(F.col("sym"))).alias("pair"), "freq") \
        .groupBy("pair").agg(F.sum("freq").alias("cnt"))


def _pair_windows(sym):
    return F.regexp_extract_all(sym, F.lit("(?s)(?=(..))"), 1)


def train_bpe(docs: DataFrame, vocab_size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY,
              text_col: str = "text", normalize: bool = True, tracked: int = bpe_index.TRACKED,
              log_rounds: bool = False) -> BpeModel:
    """K3: byte-level BPE training.  Returns the ordered merges (bounded by vocab_size).

    See ``bpe_index`` for the index, the rounds and what the driver holds (``tracked`` pair counts and
    the merges).  A new version of the index is written when the merges since the last one are 64
    and half as many as those before it.
    """
    inv = id_to_byte()
    token = [s.encode("utf-8") for s in SPECIAL_TOKENS]
    token += [bytes([inv[i]]) for i in range(len(SPECIAL_TOKENS), FIRST_MERGE_ID)]
    known = {t: i for i, t in enumerate(token)}
    merges: list[tuple[int, int, int]] = []
    state = word_symbols(pretoken_counts(docs, text_col, normalize)).where(F.length("sym") > 1)
    version = bpe_index.Version(cut_lineage(state), 0)
    counts = bpe_index.Counts(version.top_pairs(tracked), tracked)
    rounds, began = 0, time.time()
    while len(token) < vocab_size:
        top = counts.best()
        if (not top or top[0][2] <= counts.floor) and counts.floor >= min_frequency:
            version = version.after(merges[version.made:], len(merges))
            counts = bpe_index.Counts(version.top_pairs(tracked), tracked)
            top = counts.best()  # only its first pair is taken while all tracked ones are equally frequent
        if not top or top[0][2] < min_frequency:
            break
        chosen, reused = [], False
        oldest_new = len(token)
        for a, b, n in bpe_index.choose(top, counts.floor):
            if n < min_frequency or reused or len(token) >= vocab_size:
                break
            s = token[a] + token[b]
            reused = s in known
            if not reused:
                known[s] = len(token)
                token.append(s)
            chosen.append((a, b, known[s]))
        made = len(merges)
        merges += chosen
        rounds += 1
        if len(token) >= vocab_size:
            break
        if reused or len(merges) - version.made >= max(64, version.made // 2):
            if not reused:
                counts.add(version.changes(merges[version.made:made], chosen), oldest_new)
            version = version.after(merges[version.made:], len(merges))
            if reused:
                counts = bpe_index.Counts(version.top_pairs(tracked), tracked)
        else:
            counts.add(version.changes(merges[version.made:made], chosen), oldest_new)
    if log_rounds:
        print(f"train_bpe: {len(merges)} merges in {rounds} rounds, {time.time() - began:.1f}s")
    return BpeModel(tuple(merges))


def merges_table(spark, model: BpeModel) -> DataFrame:
    """(rank, left_id, right_id, new_id)."""
    return spark.createDataFrame([(r, a, b, n) for r, (a, b, n) in enumerate(model.merges)],
                                 "rank int, left_id int, right_id int, new_id int")


def encode_table(df: DataFrame, model: BpeModel | None = None, text_col: str = "text",
                 out_col: str = "input_ids", with_attention: bool = False, normalize: bool = True) -> DataFrame:
    """K4: ids of each text (+ all-ones attention mask, as the tokenizer returns)."""
    out = df.withColumn(out_col, encode(F.col(text_col), model, normalize))
    if with_attention:
        out = out.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size(out_col)))
    return out


CHUNK_WORDS = 200_000


def encode_with_dictionary(df: DataFrame, model: BpeModel, text_col: str = "text", out_col: str = "input_ids",
                           normalize: bool = True) -> DataFrame:
    """K4 with a dictionary of the whole job: every distinct pre-token is merged once, and joined back in order.

    The rows are stored in chunks of CHUNK_WORDS words or one row.  Each chunk names its
    distinct words once, so a frequent word meets the join once per chunk, not once per
    occurrence, and adaptive execution splits what is still skewed.  The chunk's words with their ids
    meet the chunk's rows in a cogroup, which cuts the texts into words again: no list of words is stored or
    moved.  The result has ``df``'s columns and ``out_col``; null texts have null ids.
    """
    classes = char_classes(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name != out_col]
    kept = [f.name for f in fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def number(batches):
        last, size, part = -1, CHUNK_WORDS, TaskContext.get().partitionId()
        for batch in batches:
            chunk = []
            for s in text_slices(batch.column(batch.num_columns - 1)):
                for n in np.diff(words_of(s, classes, normalize)[1]).tolist():
                    if size + n > CHUNK_WORDS:
                        last, size = last + 1, 0
                    size += n
                    chunk.append((part << 40) + last)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk, pa.int64())], names=[*kept, "_text", "_chunk"])

    others = [c for c in kept if c != text_col]
    rows = cut_lineage(df.select(*kept, F.col(text_col).alias("_text")).mapInArrow(number, f"{ddl}, _text string, _chunk long")
                       .select(*others, "_text", "_chunk"))

    def distinct(batches):
        open_chunk = None  # the words of the last chunk so far: its rows may go on
        for batch in batches:
            at = 0
            for s in text_slices(batch.column(0)):
                found, first = words_of(s, classes, normalize)
                of = np.repeat(batch.column(1).slice(at, len(s)).to_numpy(), np.diff(first))
                at += len(s)
                if not len(of):
                    continue
                named = pa.table({"_chunk": of, "word": found})
                named = (named if open_chunk is None else pa.concat_tables([open_chunk, named])).group_by(["_chunk", "word"]).aggregate([])
                ended = pc.less(named.column("_chunk"), of[-1])
                open_chunk = named.filter(pc.invert(ended))
                yield from named.filter(ended).cast(schema).to_batches()
        if open_chunk is not None:
            yield from open_chunk.cast(schema).to_batches()

    schema = pa.schema([("_chunk", pa.int64()), ("word", pa.string())])
    needs = rows.select("_text", "_chunk").mapInArrow(distinct, "_chunk long, word string")

    def merge(batches):
        run = word_ids(model)
        for batch in batches:
            ids, offsets = run(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), id_lists(ids, offsets, batch.column(0))], names=["word", "ids"])

    dictionary = needs.select("word").distinct().mapInArrow(merge, "word string, ids array<int>")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, ids = left.column("_text").combine_chunks(), right.column("ids").combine_chunks()
        found, first = words_of(texts, classes, normalize)
        which = pc.index_in(found, value_set=right.column("word").combine_chunks().cast(found.type)).to_numpy()
        flat, offsets = joined_lists(ids.flatten().to_numpy(), pc.list_value_length(ids).to_numpy().astype(np.int64), which)
        out = id_lists(flat, offsets[first], texts)
        columns = [texts if c == text_col else left.column(c) for c in kept]
        return pa.table([*columns, out], names=[*kept, out_col])

    found = needs.join(dictionary.hint("merge"), "word").select("_chunk", "word", "ids")
    return rows.groupBy("_chunk").cogroup(found.groupBy("_chunk")).applyInArrow(assemble, f"{ddl}, `{out_col}` array<int>")


def decode_table(df: DataFrame, model: BpeModel | None = None, ids_col: str = "input_ids",
                 out_col: str = "decoded", skip_special: bool = False) -> DataFrame:
    """K5: text of each id array."""
    return df.withColumn(out_col, decode(F.col(ids_col), model, skip_special))


def roundtrip_report(df: DataFrame, group_cols: list[str], model: BpeModel | None = None,
                     text_col: str = "text", max_length: int | None = None) -> DataFrame:
    """K6: share of rows whose decode(encode(text)) equals the text, per group.

    With ``max_length`` the ids are truncated first (the chat check truncates at
    256) and the decoded text is still compared with the whole text, so a text
    longer than ``max_length`` tokens counts as not equal.
    """
    ids = encode(F.col(text_col), model, normalize=False)
    if max_length:
        ids = F.slice(ids, 1, max_length)
    checked = df.select(*group_cols, F.col(text_col).alias("_t"), ids.alias("_ids"))
    dec = decode(F.col("_ids"), model)
    ok = dec == F.col("_t")
    return checked.groupBy(*group_cols).agg(
        F.count("*").alias("n_rows"), F.count_if(ok).alias("n_equal"),
        F.round(F.avg(ok.cast("double")), 6).alias("equal_rate"))


def tokenizer_stats(df: DataFrame, group_cols: list[str], model: BpeModel | None = None,
                    text_col: str = "text") -> DataFrame:
    """K7: tokens per character by group, with the model's vocabulary size and special ids."""
    agg = df.select(*group_cols, F.length(text_col).alias("_c"), token_count(F.col(text_col), model).alias("_n")) \
        .groupBy(*group_cols).agg(F.count("*").alias("n_rows"), F.sum("_c").cast("long").alias("n_chars"),
                                  F.sum("_n").cast("long").alias("n_tokens"))
    model = model or BpeModel()
    return agg.select(*group_cols, "n_rows", "n_chars", "n_tokens",
                      F.round(F.try_divide(F.col("n_tokens"), F.col("n_chars").cast("double")), 6)
                      .alias("tokens_per_char"),
                      F.lit(model.vocab_size).alias("vocab_size"),
                      *[F.lit(i).alias(n) for n, i in (("unk_id", UNK_ID), ("bos_id", BOS_ID), ("eos_id", EOS_ID),
                                                       ("pad_id", PAD_ID))])
