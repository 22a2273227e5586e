"""Encoding (K4 per row) and decoding (K5) of text with a byte-level BPE model.

A model is the ordered merge list (left id, right id, new id); the base
vocabulary (specials + 256 byte symbols) is fixed by rule.  With zero merges
encoding is one Arrow UDF over the bytes of a batch: specials found, NFKC of the rest, bytes
looked up.  With merges, Spark does the splitting and pre-tokenizing and a small cached helper
applies the merge ranks to each pre-token inside an Arrow UDF; the merge
list is bounded by the vocabulary size, so shipping it with the task is safe.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import SPECIAL_TOKENS
from quarry.functions.bytes import (_ID_OF_BYTE, FIRST_MERGE_ID, byte_to_id, id_lists, id_to_byte, string_bytes,
                                    text_slices)
from quarry.functions.text import nfkc_column, nfkc_pieces, pretokenize, split_specials


@dataclass(frozen=True)
class BpeModel:
    """Ordered merges; ``merges[r] = (left_id, right_id, new_id)`` has rank r."""

    merges: tuple = field(default_factory=tuple)

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """id -> bytes of the token (specials as their own UTF-8 string)."""
        out = [s.encode("utf-8") for s in SPECIAL_TOKENS]
        inv = id_to_byte()
        out += [bytes([inv[i]]) for i in range(len(SPECIAL_TOKENS), FIRST_MERGE_ID)]
        for a, b, n in self.merges:
            if n == len(out):
                out.append(out[a] + out[b])
        return out

    @property
    def vocab_size(self) -> int:
        return len(self.token_bytes)


BYTE_LEVEL = BpeModel()


def _is_special(p: Column) -> Column:
    return p.isin(*SPECIAL_TOKENS)


def encode_pieces(col: Column, normalize: bool = True) -> Column:
    """Split specials out (T6) and NFKC the other pieces."""
    pieces = split_specials(col)
    return nfkc_pieces(pieces, col) if normalize else pieces


_ANY_SPECIAL = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(SPECIAL_TOKENS, key=len, reverse=True)))
_SPECIAL_IDS = {s.encode(): i for i, s in enumerate(SPECIAL_TOKENS)}


def byte_level_ids(col: pa.Array, normalize: bool) -> pa.Array:
    """Ids of each text without merges: special strings as their id, every other byte as its id.

    Works on the bytes of a slice of the column at a time, so that what it holds besides the ids stays small.
    """
    return pa.concat_arrays([_slice_ids(s, normalize) for s in text_slices(col)])


def byte_level_counts(col: pa.Array, normalize: bool) -> pa.Array:
    """Number of ids of each text; the ids of one slice of the column exist at a time."""
    return pa.concat_arrays([pc.list_value_length(_slice_ids(s, normalize)) for s in text_slices(col)])


def special_pieces(col: pa.Array, normalize: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of the pieces, pieces that are special strings, their ids, first piece of each row and the end).

    With specials inside, the column is cut into pieces at them, without a copy, so that NFKC sees one piece at a time.
    """
    data, rows = string_bytes(col)
    found = [(m.start(), m.end(), _SPECIAL_IDS[m[0]]) for m in _ANY_SPECIAL.finditer(memoryview(data))] if len(data) else []
    start, end, special = np.array(found, np.int64).reshape(-1, 3).T
    inside = np.searchsorted(rows, start, "right") == np.searchsorted(rows, end, "left")  # not across two texts
    start, end, special = start[inside], end[inside], special[inside]
    cuts = np.unique(np.concatenate([rows, start, end]))
    at_special, first = np.searchsorted(cuts, start), np.searchsorted(cuts, rows)
    if normalize:
        whole = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(data)])
        data, cuts = string_bytes(nfkc_column(whole))
    return data, cuts, at_special, special, first


def _slice_ids(col: pa.Array, normalize: bool) -> pa.Array:
    data, cuts, at_special, special, first = special_pieces(col, normalize)
    ids = _ID_OF_BYTE[data]
    keep = np.ones(len(ids), bool)
    for p, i in zip(at_special.tolist(), special.tolist()):
        ids[cuts[p]] = i
        keep[cuts[p] + 1: cuts[p + 1]] = False
    if not len(special):
        return id_lists(ids, cuts[first], col)
    return id_lists(ids[keep], np.concatenate([[0], np.cumsum(keep)])[cuts[first]], col)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _encode_udf(col: pa.Array) -> pa.Array:
    return byte_level_ids(col, False)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _encode_nfkc_udf(col: pa.Array) -> pa.Array:
    return byte_level_ids(col, True)


def encode(col: Column, model: BpeModel | None = None, normalize: bool = True) -> Column:
    """K4 for one text column -> array<int> of token ids (no truncation)."""
    if model is None or not model.merges:
        return (_encode_nfkc_udf if normalize else _encode_udf)(col)
    return bpe_words_udf(model)(words(col, normalize))


def words(col: Column, normalize: bool = True) -> Column:
    """The pre-tokens of a text, special strings as words of their own."""
    pieces = encode_pieces(col, normalize)
    return F.flatten(F.transform(pieces, lambda p: F.when(_is_special(p), F.array(p)).otherwise(pretokenize(p))))


@F.arrow_udf(T.IntegerType())
def _count_udf(col: pa.Array) -> pa.Array:
    return byte_level_counts(col, False)


@F.arrow_udf(T.IntegerType())
def _count_nfkc_udf(col: pa.Array) -> pa.Array:
    return byte_level_counts(col, True)


def token_count(col: Column, model: BpeModel | None = None, normalize: bool = True) -> Column:
    """Number of ids that ``encode`` gives; without merges only the numbers leave the UDF."""
    if model is not None and model.merges:
        return F.size(encode(col, model, normalize))
    return (_count_nfkc_udf if normalize else _count_udf)(col)


def make_word_encoder(merges, b2i=None):
    """Pre-token -> ids by applying merges in rank order; made once per task.

    A heap holds the mergeable neighbours by (rank, place); a merge links the symbols
    around it anew, so a word of n symbols takes n log n steps.  This equals merging all
    occurrences of the lowest-ranked pair, left to right, again and again.  Words
    met before come from a table that is emptied when it is full.
    """
    ranks = {(a, b): (r, n) for r, (a, b, n) in enumerate(merges)}
    b2i = list(b2i if b2i is not None else byte_to_id())
    special = {s: i for i, s in enumerate(SPECIAL_TOKENS)}
    cache: dict[str, list[int]] = {}

    def merge(syms: list[int]) -> list[int]:
        n = len(syms)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*hit, i, syms[i], syms[i + 1]) for i in range(n - 1) if (hit := ranks.get((syms[i], syms[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, new, i, a, b = heapq.heappop(heap)
            j = right[i] if syms[i] == a else n
            if j >= n or syms[j] != b:
                continue  # one of the two has been merged meanwhile
            syms[i], syms[j] = new, -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (hit := ranks.get((syms[x], syms[y]))):
                    heapq.heappush(heap, (*hit, x, syms[x], syms[y]))
        return [s for s in syms if s >= 0]

    def enc(w: str) -> list[int]:
        hit = cache.get(w)
        if hit is None:
            hit = [special[w]] if w in special else merge([b2i[b] for b in w.encode("utf-8")])
            if len(cache) >= WORD_TABLE:
                cache.clear()
            cache[w] = hit
        return hit

    return enc


WORD_TABLE = 200_000


def word_ids(model: BpeModel):
    """A function from a string column of words to (ids, n+1 offsets), for one task; equal words are merged once."""
    enc = make_word_encoder(list(model.merges), list(byte_to_id()))

    def run(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        coded = words.dictionary_encode()
        lists = [enc(w) for w in coded.dictionary.to_pylist()]
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return joined_lists(np.fromiter((i for x in lists for i in x), np.int32), np.array([len(x) for x in lists], np.int64), which)

    return run


def joined_lists(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``which`` (numbers into lists of ``sizes`` laid end to end in ``flat``), end to end, and their offsets."""
    starts, n = np.concatenate([[0], np.cumsum(sizes)])[:-1][which], sizes[which]
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], n)
    return flat[at], offsets


def bpe_words_udf(model: BpeModel):
    """array<string> of words -> array<int> of their ids, one after another."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _bpe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = word_ids(model)
        for words in batches:
            ids, offsets = run(words.flatten())
            sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
            yield id_lists(ids, offsets[np.concatenate([[0], np.cumsum(sizes)])], words)

    return _bpe


def decode(ids: Column, model: BpeModel | None = None, skip_special: bool = False) -> Column:
    """K5: ids -> token bytes -> UTF-8 string (malformed bytes become U+FFFD).

    JVM-only: the vocabulary (bounded by vocab size) is a literal array of hex
    strings indexed by id.
    """
    model = model or BYTE_LEVEL
    vocab = F.array(*[F.lit(b.hex().upper()) for b in model.token_bytes])
    if skip_special:
        ids = F.filter(ids, lambda i: i >= len(SPECIAL_TOKENS))
    hexed = F.array_join(F.transform(ids, lambda i: F.element_at(vocab, i + 1)), "")
    return F.make_valid_utf8(F.unhex(hexed).cast("string"))
