"""Word hashing over Arrow text columns, vectorised with numpy.

Words are maximal runs of bytes other than ASCII white space (``\\x20``,
``\\x09``-``\\x0D``) with A-Z lower-cased, the same words as the pattern
``[^\\x20\\x09-\\x0D]+`` on the text.  A word's 64-bit hash is a polynomial over a
fixed random byte table, mixed at the end; hashing a batch is a few array
passes over its bytes, no Python loop per word.  Memory is bounded: a batch is
worked off in chunks of about ``CHUNK`` bytes of text and a longer single text in
segments of ``SEG`` bytes (cut between words).
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20
SEG = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_POLY = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of consecutive texts: hashes, byte ranges, and each text's word range."""

    __slots__ = ("data", "offsets", "hashes", "starts", "ends", "woff")

    def __init__(self, data, offsets, hashes, starts, ends, woff):
        self.data, self.offsets, self.hashes = data, offsets, hashes
        self.starts, self.ends, self.woff = starts, ends, woff

    def __len__(self):
        return len(self.offsets) - 1


class Hasher:
    """Holds the tables; make one per task.  ``fold``: A-Z count as a-z."""

    def __init__(self, seed: int = 7, fold: bool = True):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**64, 256, dtype=np.uint64)
        if fold:
            self.table[65:91] = self.table[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.pw = self.ipw = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.pw) < n:
            size = max(n, SEG + 4096)
            for name, base in (("pw", _POLY), ("ipw", pow(_POLY, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges (ascending, not overlapping) of ``data``, A-Z lower-cased."""
        out = np.empty(len(starts), np.uint64)
        i, n = 0, len(starts)
        while i < n:
            base = int(starts[i])
            j = max(int(np.searchsorted(ends, base + SEG, "right")), i + 1)
            stop = int(ends[j - 1])
            self._powers(stop - base + 1)
            acc = np.zeros(stop - base + 1, np.uint64)
            np.cumsum(self.table[data[base:stop]] * self.pw[: stop - base], out=acc[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mix64((acc[b] - acc[a]) * self.ipw[a] + (b - a).astype(np.uint64) * _MULT)
            i = j
        return out

    def slices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of any byte ranges of short ``data`` (at most SEG bytes), as ``spans`` gives them."""
        self._powers(len(data) + 1)
        acc = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.pw[: len(data)], out=acc[1:])
        return mix64((acc[ends] - acc[starts]) * self.ipw[starts] + (ends - starts).astype(np.uint64) * _MULT)

    def words(self, data: np.ndarray, offsets: np.ndarray, hashed: bool = True) -> Words:
        """``data``: UTF-8 bytes of consecutive texts, ``offsets``: their n+1 bounds from 0."""
        inside = ~self.space[data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        if len(before):
            before[0] = False
            cut = offsets[(offsets < len(data))]
            before[cut] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        if len(after):
            after[-1] = False
            cut = offsets[(offsets > 0) & (offsets <= len(data))] - 1
            after[cut] = False
        ends = np.flatnonzero(inside & ~after) + 1
        hashes = self.spans(data, starts, ends) if hashed else None
        return Words(data, offsets, hashes, starts, ends, np.searchsorted(starts, offsets))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets (from 0) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, buf = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1] if off else np.zeros(1, np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each (a longer text stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1, i + 1)
        yield i, j
        i = j


def word_chunks(col: pa.Array, hasher: Hasher, size: int = CHUNK, hashed: bool = True) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, their words) for each chunk of a text column."""
    data, offsets = column_bytes(col)
    for i, j in chunks(data, offsets, size):
        part = offsets[i: j + 1]
        yield i, j, hasher.words(data[part[0]: part[-1]], part - part[0], hashed)


def worker_store() -> dict:
    """A dict that lives as long as the Python worker.

    Tasks unpickle this package anew, so its own module globals end with a task.
    """
    holder = sys.modules.setdefault("_quarry_worker_store", types.ModuleType("_quarry_worker_store"))
    return holder.__dict__.setdefault("store", {})


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` consecutive word hashes (empty if fewer)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = mix64(out * _MULT + hashes[i: i + m])
    return out


def sequence_hash(hashes: np.ndarray) -> int:
    """Hash of a whole word sequence."""
    h = np.uint64(len(hashes))
    if len(hashes):
        pos = mix64(np.arange(1, len(hashes) + 1, dtype=np.uint64) * _MULT)
        h = mix64(np.array([(hashes * (pos | np.uint64(1))).sum(dtype=np.uint64) + h]))[0]
    return int(h)


def bin_edges(bins: int) -> np.ndarray:
    """Lower bounds of equal bins of the hash range."""
    return np.array([i * (1 << 64) // bins for i in range(bins)], np.uint64)


def one_permutation(unique: np.ndarray, edges: np.ndarray, perm: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of sorted distinct 64-bit hashes, densified.

    The hash range is cut at ``edges`` into equal bins; a bin keeps its smallest hash.
    An empty bin takes the value of the first non-empty bin in its own row of
    ``perm`` (a fixed random order of all bins), so that two sets agree in a bin
    with probability equal to their Jaccard similarity (optimal densification).
    """
    at = np.searchsorted(unique, edges)
    stop = np.append(at[1:], len(unique))
    full = at < stop
    sig = np.zeros(len(edges), np.uint64)
    sig[full] = unique[at[full]]
    if not full.all():
        empty = np.flatnonzero(~full)
        src = perm[empty]
        sig[empty] = sig[src[np.arange(len(empty)), full[src].argmax(1)]]
    return sig


def bin_orders(bins: int, seed: int = 11) -> np.ndarray:
    """For each bin a fixed random order of all bins."""
    rng = np.random.default_rng(seed)
    return np.argsort(rng.random((bins, bins)), axis=1).astype(np.int32)
