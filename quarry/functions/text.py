"""Text scalar functions: chunking (T1), BOS (T2), NFKC (T3), pre-tokenizing (T4),
special-token split (T6)."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import BOS_TOKEN, PRETOKEN_PATTERN, SPECIAL_TOKENS
from quarry.functions.bytes import string_bytes


def chunk_array(col: Column, n: int) -> Column:
    """T1 as an array: consecutive ``n``-code-point pieces, last may be short.

    One linear regex pass (``.`` is a code point in Java regex, so characters
    outside the BMP are never cut); ``""`` yields an empty array.
    """
    if n < 1:
        raise ValueError("chunk size must be positive")
    return F.regexp_extract_all(col, F.lit("(?s).{1,%d}" % n), 0)


def add_bos(col: Column, bos: str = BOS_TOKEN) -> Column:
    """Prepend the BOS special string before encoding."""
    return F.concat(F.lit(bos), col)


def _boundary_regex(specials: list[str]) -> str:
    # zero-width split points just before and just after every special string; Java's
    # split finds them iteratively, so arbitrarily long texts are safe
    alts = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    return "(?=%s)|(?<=%s)" % (alts, alts)


def has_special(col: Column, specials: list[str] = SPECIAL_TOKENS) -> Column:
    """True when a special string occurs; a byte search for '<' rules most texts out first."""
    if not all(s.startswith("<") for s in specials):
        return col.rlike("|".join(re.escape(s) for s in specials))
    tails = "|".join(re.escape(s[1:]) for s in sorted(specials, key=len, reverse=True))
    return (F.instr(col, "<") > 0) & col.rlike("<(?:%s)" % tails)


def _piece_regex(specials: list[str]) -> str:
    # a special, or all up to the next one; possessive, so Java loops without a stack and never goes back
    alts = "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))
    tails = "|".join(re.escape(s[1:]) for s in sorted(specials, key=len, reverse=True))
    return "%s|(?:[^<]++|<(?!%s))++" % (alts, tails)


def split_specials(col: Column, specials: list[str] = SPECIAL_TOKENS) -> Column:
    """Array of pieces; each special string is its own piece, gaps in between.

    Texts without any special string skip the splitting regex.  Specials that hold a '<' only as their first
    character cannot overlap: one pass from '<' to '<' cuts at them; others need the boundaries of every place.
    """
    if all(s.rfind("<") == 0 for s in specials):
        pieces = F.regexp_extract_all(col, F.lit(_piece_regex(specials)), 0)
    else:
        pieces = F.array_remove(F.split(col, _boundary_regex(specials)), "")
    return F.when(~has_special(col, specials),
                  F.when(F.length(col) > 0, F.array(col)).otherwise(F.array().cast("array<string>"))
                  ).otherwise(pieces)


def pretokenize(col: Column) -> Column:
    """T4: byte-level (GPT-2) pre-token split, no prefix space; lossless."""
    return F.regexp_extract_all(col, F.lit(PRETOKEN_PATTERN), 0)


def nfkc_column(col: pa.Array) -> pa.Array:
    """NFKC of a string column, normalized as one string.

    A control byte that no text holds joins the texts: it is a starter that composes with
    nothing, so the joined text's form is the joined forms.  (Arrow's own ``utf8_normalize`` does not
    compose: it leaves 12,315 code points of this build other than ``unicodedata`` does.)
    """
    if pc.all(pc.string_is_ascii(col)).as_py() is not False:
        return col
    data, offsets = string_bytes(col)
    unused = np.flatnonzero(np.bincount(data, minlength=32)[:32] == 0)
    if not len(unused):  # a batch that uses all of them
        return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in col.to_pylist()], col.type)
    sep = unused[0]
    whole = unicodedata.normalize("NFKC", np.insert(data, offsets[1:-1], sep).tobytes().decode())
    data = np.frombuffer(whole.encode(), np.uint8)
    at = np.flatnonzero(data == sep)
    offsets = np.concatenate([[0], at - np.arange(len(at)), [len(data) - len(at)]])
    out = pa.Array.from_buffers(pa.large_string(), len(col), [None, pa.py_buffer(offsets.tobytes()),
                                                              pa.py_buffer(data[data != sep])])
    return (pc.if_else(col.is_valid(), out, None) if col.null_count else out).cast(col.type)


@F.arrow_udf(T.StringType())
def _nfkc_udf(col: pa.Array) -> pa.Array:
    return nfkc_column(col)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _nfkc_pieces_udf(col: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32(), mask=np.r_[col.is_null().to_numpy(zero_copy_only=False), False])
    return pa.ListArray.from_arrays(offsets, nfkc_column(col.flatten()))


def is_ascii(col: Column) -> Column:
    return F.length(col) == F.octet_length(col)


# Characters whose NFKC form is themselves and that never compose with a
# neighbour from the same set: ASCII, non-compatibility Latin-1 and Latin Extended-A,
# Greek and Cyrillic letters, dashes, curly quotes, bullet and euro sign, CJK
# punctuation, kana, CJK unified ideographs, Hangul syllables.
# (Checked against unicodedata in tests/test_text_and_bytes.py.)
NFKC_STABLE_CLASS = ("\\x00-\\x7F\\u00A1-\\u00A7\\u00A9\\u00AB-\\u00AE\\u00B0\\u00B1\\u00B6\\u00B7"
                     "\\u00BB\\u00BF-\\u0131\\u0134-\\u013E\\u0141-\\u0148\\u014A-\\u017E"
                     "\\u0386\\u0388-\\u038A\\u038C\\u038E-\\u03A1\\u03A3-\\u03CE\\u0400-\\u045F"
                     "\\u2010\\u2012-\\u2015\\u2018-\\u201F\\u2022\\u20AC\\u3001\\u3002\\u3008-\\u3011"
                     "\\u3041-\\u3096\\u30A1-\\u30FA\\u30FC\\u3400-\\u4DBF\\u4E00-\\u9FFF\\uAC00-\\uD7A3")


def nfkc_stable(col: Column) -> Column:
    """True when NFKC certainly leaves the text unchanged (checked JVM-side)."""
    return col.rlike("^[%s]*$" % NFKC_STABLE_CLASS)


def nfkc(col: Column) -> Column:
    """Unicode NFKC.  No built-in exists; an Arrow UDF does it a column at a time, and
    values made only of NFKC-stable characters are not sent to Python."""
    return F.coalesce(_nfkc_udf(F.when(~is_ascii(col) & ~nfkc_stable(col), col)), col)


def nfkc_pieces(pieces: Column, text: Column) -> Column:
    """NFKC on each piece of a split text (specials are ASCII, so unchanged)."""
    return F.coalesce(_nfkc_pieces_udf(F.when(~is_ascii(text) & ~nfkc_stable(text), pieces)), pieces)
