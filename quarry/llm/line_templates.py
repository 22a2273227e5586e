"""Operator 10: line dedup by a log-template tree.

Every line (split at ``\\n``) with a word is parsed by a tree of fixed depth: its word count, then its
``DEPTH`` leading words, a word with a digit counting as a variable.  Within a leaf, a word that stands at its
place in ``min_docs`` lines or more is fixed, any other is a variable field.  Lines of a leaf
with the same fixed words form a template, if at least ``SIMILAR`` of their places are fixed (the leading words
are).  All of this is counted by Spark over distinct lines with their numbers, whatever the size of a leaf.

A template recurs when it stands in ``min_docs`` unrelated documents or more.  Documents are related if sketches of
their whole texts (the least hash of five-word shingles in each of ``BINS`` bins) agree in half of the
bins or more, so that lines which recur only because whole documents were copied, edited or not, are left to the
near-duplicate operator, and copies of a document that holds boiler-plate change nothing.  Each task
keeps up to ``min_docs`` mutually unrelated sketches a template, and what the tasks kept is merged in the same
way: no group of documents is ever gathered.  What stands beside a line does not
matter: a block of any number of lines goes whole.  Lines of recurring templates are dropped everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import vec
from quarry.llm.keys import row_key
from quarry.session import cut_lineage

DEPTH = 6
SIMILAR = 0.8
MIN_DOCS = 5
MIN_WORDS = 3
SHINGLE = 5
BINS = 32
RELATED = 0.5
_EMPTY = np.uint32(0xFFFFFFFF)
_VARIABLE = np.uint64(0x5A5A5A5A5A5A5A5A)
#: bits of the filter that keeps the second pass to leaves of several lines; it only saves work
FILTER_BITS = 1 << 23


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, text) of every line of consecutive texts, in order; each text has one line at least."""
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([offsets[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((text, start))
    return start[order], text[order]


def masked(words: vec.Words) -> np.ndarray:
    """Word hashes with every word that has a digit replaced by one mark."""
    digits = np.concatenate([[0], np.cumsum((words.data >= 48) & (words.data <= 57))])
    return np.where(digits[words.ends] > digits[words.starts], _VARIABLE, words.hashes)


class _Lines:
    """The lines with words of consecutive texts."""

    def __init__(self, words: vec.Words):
        start, text = line_bounds(words.data, words.offsets)
        self.hashes = masked(words)
        line_of = np.searchsorted(start, words.starts, "right") - 1
        self.first = np.flatnonzero(np.r_[True, line_of[1:] != line_of[:-1]])
        self.size = np.diff(np.r_[self.first, len(line_of)])
        line = line_of[self.first]
        self.doc = text[line]
        self.number = line - np.searchsorted(text, np.arange(len(words)))[self.doc]
        place = np.arange(len(line_of)) - np.repeat(self.first, self.size)
        part = self.hashes * (vec.mix64(place.astype(np.uint64)) | np.uint64(1))
        n = self.size.astype(np.uint64)
        self.line_hash = vec.mix64(np.add.reduceat(part, self.first) + n).view(np.int64)
        lead = np.add.reduceat(np.where(place < DEPTH, part, np.uint64(0)), self.first)
        self.leaf = vec.mix64(lead ^ vec.mix64(n)).view(np.int64)

    def tokens(self, which: np.ndarray) -> pa.Array:
        """32 bits of every word of the lines ``which``."""
        size = self.size[which]
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(offsets[-1]) + np.repeat(self.first[which] - offsets[:-1], size)
        short = (self.hashes[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(short))


def sketches(words: vec.Words) -> np.ndarray:
    """texts x BINS: the least hash of the five-word shingles in each bin; shorter texts are one shingle."""
    out = np.full((len(words), BINS), _EMPTY)
    grams, n = vec.ngrams(words.hashes, SHINGLE), np.diff(words.woff)
    text = np.repeat(np.arange(len(words)), n)[: len(grams)]
    inside = np.arange(len(grams)) + SHINGLE <= words.woff[text + 1]
    grams, text = grams[inside], text[inside]
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    grams = np.concatenate([grams, np.array([vec.sequence_hash(words.hashes[words.woff[i]: words.woff[i + 1]]) for i in few], np.uint64)])
    text = np.concatenate([text, few])
    bins = (grams >> np.uint64(59)).astype(np.int64)  # BINS is 2 ** 5
    np.minimum.at(out.reshape(-1), text * BINS + bins, ((grams >> np.uint64(20)) & np.uint64(0xFFFFFFFE)).astype(np.uint32))
    return out


def related(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Whether a sketch agrees with each of ``many`` in at least RELATED of the bins that either fills."""
    filled = (one != _EMPTY) | (many != _EMPTY)
    return ((one == many) & filled).sum(1) >= RELATED * filled.sum(1)


def _parsed(batches, col: int):
    """(batch, first row of the chunk, its words, its lines) for every chunk that has words."""
    hasher = vec.Hasher()
    for batch in batches:
        for i, _, words in vec.word_chunks(batch.column(col), hasher):
            if len(words.hashes):
                yield batch, i, words, _Lines(words)


def parse_lines(docs: DataFrame, text_col: str) -> DataFrame:
    """One row per line with words: (_k1, _k2, line, n_words, leaf, line_hash, sketch).

    sketch: of the whole text, in the row of its first line with words; null in the others.
    """

    def run(batches):
        for batch, i, words, lines in _parsed(batches, 2):
            at = pa.array(lines.doc + i)
            first = np.r_[True, lines.doc[1:] != lines.doc[:-1]]
            found = sketches(words)
            sketch = [found[d].tobytes() if f else None for d, f in zip(lines.doc.tolist(), first.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(lines.number, pa.int32()),
                 pa.array(lines.size, pa.int32()), pa.array(lines.leaf), pa.array(lines.line_hash), pa.array(sketch, pa.binary())],
                names=["_k1", "_k2", "line", "n_words", "leaf", "line_hash", "sketch"])

    return docs.select("_k1", "_k2", F.col(text_col).alias("text")).mapInArrow(
        run, "_k1 long, _k2 long, line int, n_words int, leaf long, line_hash long, sketch binary")


def leaf_filter(leaves: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, those of the leaves set: at most 256 rows of 4 KB reach the driver."""
    place = F.pmod("leaf", F.lit(FILTER_BITS)) + 1  # buckets count from 1
    rows = leaves.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(FILTER_BITS, bool)
    for r in rows:
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little").astype(bool)
        base = (r["bucket"] - 1) * len(bits)
        out[base: base + len(bits)] = bits
    return out


def line_tokens(docs: DataFrame, text_col: str, wanted: np.ndarray) -> DataFrame:
    """(leaf, line_hash, tokens) of the lines in leaves that pass the filter, each once per chunk of texts."""
    packed = np.packbits(wanted)

    def run(batches):
        keep = np.unpackbits(packed).astype(bool)
        for _, _, _, lines in _parsed(batches, 0):
            _, at = np.unique(lines.line_hash, return_index=True)
            at = at[keep[np.mod(lines.leaf[at], FILTER_BITS)]]
            yield pa.RecordBatch.from_arrays([pa.array(lines.leaf[at]), pa.array(lines.line_hash[at]), lines.tokens(at)],
                                             names=["leaf", "line_hash", "tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "leaf long, line_hash long, tokens array<int>")


def templates(lines: DataFrame, tokens: DataFrame, min_docs: int) -> DataFrame:
    """(line_hash, template) of the distinct lines of leaves that hold several.

    ``lines``: (leaf, line_hash, n), n its number of rows; ``tokens`` has at least these lines.
    """
    words = tokens.join(lines, ["leaf", "line_hash"]).dropDuplicates(["line_hash"]) \
        .select("leaf", "line_hash", "n", F.posexplode("tokens").alias("place", "word"))
    words = cut_lineage(words.where(F.col("place") >= DEPTH))
    fixed = words.groupBy("leaf", "place", "word").agg(F.sum("n").alias("lines")).where(F.col("lines") >= min_docs).drop("lines")
    shape = words.join(fixed, ["leaf", "place", "word"]).groupBy("line_hash").agg(
        F.count("*").alias("fixed"), F.bit_xor(F.xxhash64("place", "word")).alias("shape"))
    return lines.join(shape, "line_hash", "left") \
        .where(F.least(F.lit(DEPTH), "n_words") + F.coalesce("fixed", F.lit(0)) >= SIMILAR * F.col("n_words")) \
        .select("line_hash", F.xxhash64("leaf", F.coalesce("shape", F.lit(0)), F.coalesce("fixed", F.lit(0))).alias("template"), "n")


def unrelated(rows: DataFrame, most: int) -> DataFrame:
    """(template, sketch): up to ``most`` mutually unrelated sketches of each template, of those that each task reads."""

    def run(batches):
        kept: dict[int, list[np.ndarray]] = {}
        seen: dict[int, set[bytes]] = {}
        for batch in batches:
            for template, sketch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                have = kept.setdefault(template, [])
                if len(have) >= most or sketch in seen.setdefault(template, set()):
                    continue
                new = np.frombuffer(sketch, np.uint32)
                if not have or not related(new, np.array(have)).any():
                    have.append(new)
                    seen[template].add(sketch)
        pairs = [(t, x.tobytes()) for t, have in kept.items() for x in have]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in pairs], pa.int64()), pa.array([x for _, x in pairs], pa.binary())],
                                         names=["template", "sketch"])

    return rows.select("template", "sketch").mapInArrow(run, "template long, sketch binary")


def recurring_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_words: int = MIN_WORDS) -> DataFrame:
    """(_k1, _k2, line) of every line to drop, for docs with row keys _k1 and _k2."""
    lines = cut_lineage(parse_lines(docs, text_col))
    # a template has no more rows than its leaf: only leaves with min_docs rows are looked into
    busy = lines.where(F.col("n_words") >= min_words).groupBy("leaf").agg(
        F.count("*").alias("rows"), F.min("line_hash").alias("lo"), F.max("line_hash").alias("hi")) \
        .where(F.col("rows") >= min_docs).select("leaf", (F.col("lo") != F.col("hi")).alias("several"))
    held = cut_lineage(lines.drop("sketch").join(busy, "leaf"))
    distinct = held.where("several").groupBy("leaf", "line_hash", "n_words").agg(F.count("*").alias("n"))
    tokens = line_tokens(docs, text_col, leaf_filter(held.where("several").select("leaf").distinct()))
    named = templates(cut_lineage(distinct), tokens, min_docs)
    frequent = named.groupBy("template").agg(F.sum("n").alias("rows")).where(F.col("rows") >= min_docs)
    named = named.join(frequent, "template").select("line_hash", "template")
    cand = held.where("several").select("_k1", "_k2", "line", "line_hash").join(named, "line_hash") \
        .select("_k1", "_k2", "line", "template") \
        .unionByName(held.where("not several").select("_k1", "_k2", "line", F.col("line_hash").alias("template")))
    cand = cut_lineage(cand)
    sketch = lines.where("sketch is not null").select("_k1", "_k2", "sketch")
    some = unrelated(cand.join(sketch, ["_k1", "_k2"]), min_docs)
    every = unrelated(some.repartition("template"), min_docs)
    recurring = every.groupBy("template").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    return cand.join(recurring.select("template"), "template").select("_k1", "_k2", "line").distinct()


def drop_recurring_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS,
                         min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, with the lines of recurring templates cut from ``text_col``.

    With ``counts`` also n_lines and n_dropped (int).  The other lines stay as they are,
    joined by ``\\n``; a text that loses all lines becomes empty.  Blank lines and lines of
    fewer than ``min_words`` words are never dropped; null and empty texts pass
    unchanged with 0 dropped.  Rows are told apart by a hash of all their values, so
    ids may be null or repeated; equal rows count as one document and are cut alike.
    An empty table gives no rows.
    """
    plain = [c for c in docs.columns if docs.schema[c].dataType.typeName() != "map"]
    keyed = docs.select("*", *row_key(*plain))
    cut = recurring_lines(keyed, text_col, min_docs, min_words) \
        .groupBy("_k1", "_k2").agg(F.collect_list("line").alias("_drop"))
    joined = keyed.join(cut, ["_k1", "_k2"], "left").select(*docs.columns, "_drop")
    at = docs.columns.index(text_col)
    added = ", n_lines int, n_dropped int" if counts else ""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + added

    def run(batches):
        for batch in batches:
            text, drop = batch.column(at), batch.column(batch.num_columns - 1)
            total, gone = [], []
            out = text.to_pylist()
            for i, lost in enumerate(drop.to_pylist()):
                if counts:
                    total.append(0 if out[i] is None else out[i].count("\n") + 1)
                    gone.append(len(lost or ()))
                if lost:
                    lost = set(lost)
                    out[i] = "\n".join([x for k, x in enumerate(out[i].split("\n")) if k not in lost])
            cols = [batch.column(c) for c in range(batch.num_columns - 1)]
            cols[at] = pa.array(out, text.type)
            if counts:
                cols += [pa.array(total, pa.int32()), pa.array(gone, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    names = docs.columns + (["n_lines", "n_dropped"] if counts else [])
    return joined.mapInArrow(run, schema)
