"""Operator 12: secret scans by password guess cost.

Fixed patterns find assigned values, access keys and long hexadecimal strings (the base).  Beyond them,
every value in a credential context ("passphrase is ...", "pwd: ...", "Bearer ...", user and
password in a URL) is costed by ``guess_cost``: the cheapest segmentation into words, dates, repeats,
keyboard walks and brute-force spans.  A value of ``min_bits`` or more that no base span holds
becomes a span of kind ``guess``; placeholders and plain words stay below.

The dictionary are the words of all texts, whole spans of secrets left out, with their
ranks by frequency.  It stays a Spark table: the substrings of the distinct values are joined with
the word counts, so no word list travels.  Ranks come from a histogram of the counts in
eighths of an octave, a few hundred rows whatever the corpus.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import vec
from quarry.llm.guess_cost import KIND, guess_bits, plain_letters
from quarry.session import cut_lineage

MIN_BITS = 30.0
#: words of the dictionary have so many letters; other letter runs are no words
WORD_LETTERS = (3, 64)
#: values are costed in pieces of so many code points; a piece that comes again costs its number only
PIECE = 256
KINDS = ["assign", "access", "hex", "guess"]
_BASE = [("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                               re.ASCII)),
         ("access", re.compile(r"AKIA[A-Z0-9]{16,}")),
         ("hex", re.compile(r"[0-9a-f]{24,}"))]
_NAMES = r"pass(?:words?|wd|phrase|code|wort)?|pwd|pw|secret|token|credentials?|auth(?:orization)?|(?:api|access|private|secret|encryption)[_\-\x20]?key"
_CONTEXT = re.compile(
    rf"""(?i:(?:{_NAMES})["'\])]?(?:[\x20\t]*(?::=|=>|->|[:=])[\x20\t]*|(?P<prose>[\x20\t]+(?:is|was)[\x20\t]+))(?:(?:bearer|basic)[\x20\t]+)?|\bbearer[\x20\t]+)"""
    r"""["'`]?(?P<value>[^\s"'`<>,;]{4,})|://[^\s/:@]*:(?P<user>[^\s/@]{4,})@""", re.ASCII)
#: texts without a match of these have no span of that kind
_MAY = {"assign": r"(?i)passw|secret|token|api_?key", "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}",
        "context": r"(?i)pass|pwd|pw|secret|token|credential|auth|key|bearer|://[^\s/:@]*:[^\s/@]{4}"}
_TAIL = ".:)]}"


def base_spans(text: str, kinds=("assign", "access", "hex")) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, leftmost and not overlapping within a kind, by start, then kind as listed."""
    out = []
    for kind, pattern in _BASE:
        if kind in kinds:
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if kind != "assign" or len(m[1]) >= 6]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def context_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values in credential contexts, closing punctuation cut off.

    After "is" or "was" a value of letters only is prose.
    """
    out = []
    for m in _CONTEXT.finditer(text):
        start = m.start(kind := "value" if m["value"] else "user")
        value = m[kind].rstrip(_TAIL)
        if len(value) >= 4 and not (m["prose"] and value.isalpha()):
            out.append((start, start + len(value)))
    return out


def pieces_of(value: str) -> list[tuple[str, int]]:
    """The distinct pieces of a value and how often each comes."""
    return list(Counter(value[i: i + PIECE] for i in range(0, len(value), PIECE)).items())


def _found(texts: pa.Array):
    """(row, text, base spans, context values) of the rows that may have any."""
    may = {k: pc.fill_null(pc.match_substring_regex(texts, p), False).to_numpy(zero_copy_only=False) for k, p in _MAY.items()}
    for i in np.flatnonzero(np.logical_or.reduce(list(may.values()))).tolist():
        text = texts[i].as_py()
        yield (i, text, base_spans(text, [k for k in ("assign", "access", "hex") if may[k][i]]),
               context_values(text) if may["context"][i] else [])


_PLACES = ("base array<struct<start: int, kind: string, end: int>>, "
           "held array<struct<start: int, end: int, inside: boolean, pieces: array<struct<piece: string, times: int>>>>")


def _scan(docs: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
    """The id columns, base spans and context values (in pieces) of every row, stored with a row number _u."""
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*id_cols).schema.fields)
    k = len(id_cols)
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    piece = pa.list_(pa.struct([("piece", pa.string()), ("times", pa.int32())]))
    held_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("inside", pa.bool_()), ("pieces", piece)]))

    def run(batches):
        for batch in batches:
            base: list = [[]] * batch.num_rows
            held: list = [[]] * batch.num_rows
            for i, text, spans, values in _found(batch.column(k)):
                base[i] = [{"start": a, "kind": kind, "end": b} for a, kind, b in spans]
                held[i] = [{"start": a, "end": b, "inside": any(x <= a and b <= y for x, _, y in spans),
                            "pieces": [{"piece": p, "times": n} for p, n in pieces_of(text[a:b])]} for a, b in values]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], pa.array(base, base_type), pa.array(held, held_type)],
                                             names=[*id_cols, "base", "held"])

    got = docs.select(*[F.col(f"`{c}`") for c in id_cols], F.col(text_col).alias("_text")).mapInArrow(run, fields + _PLACES)
    return cut_lineage(got.withColumn("_u", F.monotonically_increasing_id()))


def _letters() -> vec.Hasher:
    """Words are runs of ASCII letters (A-Z as a-z) and non-ASCII bytes."""
    hasher = vec.Hasher()
    hasher.space = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
    return hasher


FLUSH = 4_000_000


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(h, n): how often each word stands in all texts outside base spans and context values."""

    def run(batches):
        hasher, waiting, size = _letters(), [], 0

        def counted():
            h, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

        for batch in batches:
            texts = batch.column(0)
            blank = {}
            for i, text, spans, values in _found(texts):
                for a, b in [(a, b) for a, _, b in spans] + values:
                    text = text[:a] + " " * (b - a) + text[b:]
                blank[i] = text
            if blank:
                texts = pa.array([blank.get(i, t) for i, t in enumerate(texts.to_pylist())], pa.large_string())
            for _, _, words in vec.word_chunks(texts, hasher):
                waiting.append(words.hashes)
                size += len(words.hashes)
                if size > FLUSH:
                    yield counted()
                    waiting, size = [], 0
        if size:
            yield counted()

    return docs.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _bucket(n: Column) -> Column:
    return F.floor(8 * F.log2(n)).cast("int")


def word_ranks(counts: DataFrame) -> DataFrame:
    """(bucket, rank): how many distinct words are as frequent as the bucket or more; at most 8 * 63 rows."""
    hist = counts.groupBy(_bucket(F.col("n")).alias("bucket")).agg(F.count("*").alias("words"))
    return hist.select("bucket", F.sum("words").over(Window.orderBy(F.desc("bucket"))).alias("rank"))


def substrings(piece: str, hasher: vec.Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every substring of a piece that might be a word: letters and signs that
    stand for them, a letter among them."""
    flat = plain_letters(piece)
    real = np.array([c.isalpha() or ord(c) > 127 for c in piece], bool)
    like = np.array([c.isalpha() or ord(c) > 127 for c in flat], bool)
    cut = np.r_[0, np.cumsum([len(c.encode()) for c in flat])].astype(np.int64)
    low, high = WORD_LETTERS
    a, size = np.meshgrid(np.arange(len(flat)), np.arange(low, high + 1), indexing="ij")
    a, b = a.ravel(), (a + size).ravel()
    a, b = a[b <= len(flat)], b[b <= len(flat)]
    seen, letters = np.r_[0, np.cumsum(like)], np.r_[0, np.cumsum(real)]
    fits = (seen[b] - seen[a] == b - a) & (letters[b] > letters[a])
    a, b = a[fits], b[fits]
    return a, b, hasher.slices(np.frombuffer(flat.encode(), np.uint8), cut[a], cut[b]).view(np.int64)


def _words_in(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """(piece, words): the dictionary words of each piece as (start, end, rank bits); pieces with none are left out."""

    def run(batches):
        hasher = _letters()
        for batch in batches:
            for piece in batch.column(0).to_pylist():
                a, b, h = substrings(piece, hasher)
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([piece]).take(pa.array(np.zeros(len(a), np.int64))), pa.array(a.astype(np.int32)),
                         pa.array(b.astype(np.int32)), pa.array(h)], names=["piece", "a", "b", "h"])

    slices = pieces.mapInArrow(run, "piece string, a int, b int, h long")
    ranks = F.broadcast(word_ranks(counts))  # a row per eighth of an octave
    # the planner sizes the substrings by their pieces and would broadcast them
    hits = slices.hint("merge").join(counts, "h").withColumn("bucket", _bucket(F.col("n"))).join(ranks, "bucket")
    return hits.groupBy("piece").agg(F.collect_list(F.struct("a", "b", F.log2("rank").alias("bits"))).alias("words"))


def _costs(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """(piece, bits) by the cheapest segmentation."""

    def run(batches):
        for batch in batches:
            pieces, words = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            bits = [guess_bits(p, [(w["a"], w["b"], w["bits"]) for w in ws or ()]) for p, ws in zip(pieces, words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.float64())], names=["piece", "bits"])

    return pieces.join(_words_in(pieces, counts), "piece", "left").select("piece", "words").mapInArrow(
        run, "piece string, bits double")


def find_secrets(docs: DataFrame, id_cols: list[str], text_col: str = "text", min_bits: float = MIN_BITS) -> DataFrame:
    """``id_cols`` of every row with ``spans`` and ``costed``.

    spans: array of (start, end, kind), by start, then kind as listed in KINDS; start and end
    (exclusive) are code points of the whole text.  costed: array of (start, end, bits) of all values in
    credential contexts, by start.  Those of ``min_bits`` or more that no base span holds are spans of kind
    guess; base spans stay whatever their cost.  Null and empty texts have neither; repeated
    rows and null ids each give their own row; an empty table gives none.  Other columns of
    ``docs`` do not matter, and ``id_cols`` must not be called base, held, costed, spans, _u or _text.
    A value longer than PIECE costs the sum of its distinct pieces, and the number of times for
    those that come again.
    """
    found = _scan(docs, id_cols, text_col)
    places = found.where(F.size("held") > 0).select("_u", F.explode("held").alias("v")) \
        .select("_u", "v.start", "v.end", "v.inside", F.explode("v.pieces").alias("p")) \
        .select("_u", "start", "end", "inside", "p.*")
    pieces = cut_lineage(places.select("piece").distinct())
    cost = _costs(pieces, cut_lineage(word_counts(docs, text_col)))
    again = F.when(F.col("times") > 1, KIND + F.log2("times")).otherwise(0.0)
    values = places.join(cost, "piece").groupBy("_u", "start", "end", "inside").agg(F.sum(F.col("bits") + again).alias("bits")) \
        .groupBy("_u").agg(F.array_sort(F.collect_list(F.struct("start", "end", "inside", "bits"))).alias("costed"))
    order = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), (F.array_position(order, s["kind"])).alias("order"),
                                                  s["end"].alias("end")))
    more = F.transform(F.filter("costed", lambda v: ~v["inside"] & (v["bits"] >= min_bits)),
                       lambda v: F.struct(v["start"].alias("start"), F.lit(len(KINDS)).cast("long").alias("order"), v["end"].alias("end")))
    ids = [F.col(f"`{c}`") for c in id_cols]
    none = F.array().cast("array<struct<start: int, end: int, inside: boolean, bits: double>>")
    every = found.where(F.size("held") == 0).select(*ids, base.alias("all"), none.alias("costed")).unionByName(
        found.where(F.size("held") > 0).join(values, "_u").select(*ids, F.array_sort(F.concat(base, more)).alias("all"), "costed"))
    return every.select(*ids, F.transform("all", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(order, s["order"].cast("int")).alias("kind"))).alias("spans"),
        F.transform("costed", lambda v: F.struct(v["start"].alias("start"), v["end"].alias("end"), v["bits"].alias("bits"))).alias("costed"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
