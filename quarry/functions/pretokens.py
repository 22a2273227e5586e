"""Pre-tokens (T4) of whole Arrow columns: the cuts of ``PRETOKEN_PATTERN`` found from character classes.

The pattern cuts a text where the class of its characters (letter, number, space, other) changes.  The last
character before a word of a run of spaces leaves the run, and joins the word if it is a blank.  A contraction
('s, 't, 're, ...) is a word of its own where a word could begin.  The classes are those of Spark's own regex
engine, asked once about every code point, so that both ways cut alike.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.functions.bytes import string_bytes, text_slices
from quarry.functions.encode import special_pieces
from quarry.functions.text import nfkc_column

OTHER, LETTER, NUMBER, SPACE = range(4)
_CODES = 0x110000
_known: list[bytes] = []


def char_classes(spark: SparkSession) -> bytes:
    """The class of each code point as a byte, compressed; a constant of the engine, asked once per process."""
    if not _known:
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        kind = F.when(char.rlike(r"(?U)\s"), SPACE).when(char.rlike(r"(?U)\p{L}"), LETTER).when(char.rlike(r"(?U)\p{N}"), NUMBER)
        codes = spark.range(_CODES).where("id < 55296 or id > 57343")  # surrogates are no characters
        got = codes.select("id", kind.alias("kind")).where("kind is not null").toArrow()
        table = np.full(_CODES, OTHER, np.uint8)
        table[got.column("id").to_numpy()] = got.column("kind").to_numpy()
        _known.append(zlib.compress(table.tobytes()))
    return _known[0]


@cache
def _table(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def word_cuts(data: np.ndarray, rows: np.ndarray, classes: bytes) -> np.ndarray:
    """Byte offsets of all words of the texts that lie between the offsets ``rows``, and the end."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    wide = not bool((data < 128).all())
    if wide:
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        rows = np.searchsorted(place, rows)
    else:
        code = data
    kind = _table(classes)[code]
    size = len(code)
    first = np.zeros(size + 1, bool)
    first[rows] = True
    start = np.ones(size + 1, bool)
    start[1:size] = first[1:size] | (kind[1:] != kind[:-1])
    after = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:size]) + 1  # words behind spaces
    start[after - 1] = True
    start[after] = code[after - 1] != 32
    quote = np.flatnonzero(code == 39)
    quote = quote[start[quote]]
    if len(quote):
        end = rows[np.searchsorted(rows, quote, "right")]  # of the quote's text
        ahead = [np.where(quote + k < end, code[np.minimum(quote + k, size - 1)], 0) for k in (1, 2)]
        one = np.isin(ahead[0], [ord(c) for c in "stmd"])
        two = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (ahead[0] == ord(a)) & (ahead[1] == ord(b))
        start[quote[one | two] + 1] = False
        start[quote[one] + 2] = True
        start[quote[two] + 3] = True
    at = np.flatnonzero(start)
    return np.r_[place, n][at] if wide else at


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def pretokens(col: pa.Array, classes: bytes, normalize: bool = True) -> pa.Array:
    """All words of the column, one after another."""
    data, rows = string_bytes(nfkc_column(col) if normalize else col)
    return _strings(data, word_cuts(data, rows, classes))


def words_of(col: pa.Array, classes: bytes, normalize: bool = True) -> tuple[pa.Array, np.ndarray]:
    """(all words, first word of each row and the end); special strings are words of their own."""
    data, cuts, at_special, _, first = special_pieces(col, normalize)
    rows = cuts[first]
    at = word_cuts(data, cuts, classes)
    if len(at_special):
        inside = np.zeros(len(data) + 1, bool)
        for p in at_special.tolist():
            inside[cuts[p] + 1: cuts[p + 1]] = True
        at = at[~inside[at]]
    return _strings(data, at), np.searchsorted(at, rows)


HELD = 1 << 18


def counted(words, held: int = HELD):
    """(word, n) tables of arrays of words: equal words are added up while few enough are held."""
    kept, n = [], 0
    for w in words:
        counts = pc.value_counts(w)
        kept.append(pa.table([counts.field(0), counts.field(1)], names=["word", "n"]))
        n += len(counts)
        if n > held:
            summed = _summed(kept)
            kept, n = [summed.rename_columns(["word", "n"])], len(summed)
            if n > held // 2:
                yield summed
                kept, n = [], 0
    if kept:
        yield _summed(kept)


def _summed(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
    return pa.table([out.column("word"), out.column("n_sum")], names=["word", "freq"]) if out.num_rows else \
        pa.table({"word": pa.array([], pa.large_string()), "freq": pa.array([], pa.int64())})


def count_words(batches, classes: bytes, normalize: bool):
    """Record batches (word, freq) of batches of texts, for one task."""
    def each():
        for batch in batches:
            for part in text_slices(batch.column(0)):
                yield pretokens(part, classes, normalize)

    for table in counted(each()):
        yield from table.cast(pa.schema([("word", pa.string()), ("freq", pa.int64())])).to_batches(max_chunksize=1 << 16)
