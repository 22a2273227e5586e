"""Byte-pair training on an inverted pair-to-word index (K3).

The distinct pre-tokens, with their frequencies, are a stored table of *versions*.  A version
holds every word as the symbols it has after the merges made so far, and an index: one row
for each distinct adjacent pair of a word, with the word and its frequency, range-partitioned
and sorted by pair, so that a hot pair spreads over many files and a filter on a few pairs
reads only the row groups that hold them.

A round merges one or more pairs.  A word can hold a pair (a, b) only if its stored form
holds the *border* of that pair: the last stored symbol inside a and the first inside b.  So a
round reads the index rows of the borders alone, replays the merges since the version on
those words, and returns the changes of pair counts, summed by Spark.  Nothing is
written in a round: a lost executor only repeats it.  When the merges since the version have
grown to a share of all, the next version is written.

The driver keeps the counts of the most frequent pairs (``TRACKED``, a bound) and of the
pairs of new symbols above the least of them.  A pair's count never rises after the round that
made its younger symbol, so pairs under that floor stay under it; once the best
tracked count comes down to the floor, the counts are taken anew.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.bytes import string_bytes
from quarry.session import cut_lineage, ensure_checkpoint_dir

TRACKED = 50_000
CANDIDATES = 512
_BMP_SLOTS = 6400  # U+E000..U+F8FF


def sym_char(i: int) -> str:
    """Private-use character standing for symbol id ``i``."""
    return chr(0xE000 + i) if i < _BMP_SLOTS else chr(0xF0000 + i - _BMP_SLOTS)


def sym_id(c: str) -> int:
    o = ord(c)
    return o - 0xE000 if o < 0xF0000 else o - 0xF0000 + _BMP_SLOTS


def symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbol ids, word number of each) of words written with ``sym_char``."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    ids = np.where(code < 0xF0000, code - 0xE000, code - 0xF0000 + _BMP_SLOTS)
    return ids, np.repeat(np.arange(len(words)), np.array([len(w) for w in words], np.int64))


def column_symbols(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``symbols`` of a string column without nulls, read from its bytes."""
    data, _ = string_bytes(col)
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
    ids = np.where(code < 0xF0000, code - 0xE000, code - 0xF0000 + _BMP_SLOTS)
    return ids, np.repeat(np.arange(len(col)), pc.utf8_length(col).to_numpy(zero_copy_only=False))


def written(ids: np.ndarray, word: np.ndarray, n: int) -> list[str]:
    """The ``n`` words of ``symbols`` written back."""
    code = np.where(ids < _BMP_SLOTS, ids + 0xE000, ids + 0xF0000 - _BMP_SLOTS).astype("<u4")
    text = code.tobytes().decode("utf-32-le")
    cut = np.searchsorted(word, np.arange(n + 1)).tolist()
    return [text[a:b] for a, b in zip(cut, cut[1:])]


def merge_all(ids: np.ndarray, word: np.ndarray, merges) -> tuple[np.ndarray, np.ndarray]:
    """Apply merges (left, right, new) in order, left to right and not overlapping within a word."""
    for a, b, new in merges:
        at = np.flatnonzero(ids[:-1] == a)
        at = at[(ids[at + 1] == b) & (word[at] == word[at + 1])]
        if not len(at):
            continue
        if a == b:  # every other place of a run of neighbouring places
            start = np.r_[True, np.diff(at) != 1]
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids = ids.copy()
        ids[at] = new
        ids, word = ids[keep], word[keep]
    return ids, word


def pair_keys(ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left << 32 | right, word number) of all adjacent pairs, overlapping ones too."""
    inside = word[:-1] == word[1:]
    return ((ids[:-1] << 32) | ids[1:])[inside], word[:-1][inside]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(keys) else values


class Version:
    """The words after ``made`` merges, and their index, in the shared checkpoint folder."""

    def __init__(self, words: DataFrame, made: int):
        self.words, self.made = words, made
        spark = words.sparkSession
        path = f"{ensure_checkpoint_dir(spark)}/bpe-{uuid.uuid4().hex}"
        pairs = F.array_distinct(F.regexp_extract_all("sym", F.lit("(?s)(?=(..))"), 1))
        words.select(F.explode(pairs).alias("pair"), "sym", "freq") \
            .repartitionByRange(spark.sparkContext.defaultParallelism, "pair", "sym").sortWithinPartitions("pair").write.parquet(path)
        self.index = spark.read.schema("pair string, sym string, freq long").parquet(path)

    def top_pairs(self, n: int) -> list[tuple[int, int, int]]:
        """The ``n`` most frequent pairs as (left, right, count)."""
        counts = self.words.select(F.explode(F.regexp_extract_all("sym", F.lit("(?s)(?=(..))"), 1)).alias("pair"), "freq") \
            .groupBy("pair").agg(F.sum("freq").alias("n"))
        return [(sym_id(r["pair"][0]), sym_id(r["pair"][1]), r["n"])
                for r in counts.orderBy(F.desc("n"), "pair").limit(n).collect()]

    def after(self, merges: list, made: int) -> Version:
        """The version after further merges; words of one symbol leave."""

        def run(batches):
            for batch in batches:
                ids, word = merge_all(*column_symbols(batch.column(0)), merges)
                yield pa.RecordBatch.from_arrays([pa.array(written(ids, word, batch.num_rows)), batch.column(1)],
                                                 names=["sym", "freq"])

        return Version(cut_lineage(self.words.mapInArrow(run, "sym string, freq long").where(F.length("sym") > 1)), made)

    def changes(self, since: list, chosen: list) -> list[tuple[int, int, int]]:
        """(left, right, change) of pair counts when ``chosen`` are merged; ``since``: merges after the version."""
        last, first = {}, {}
        for a, b, new in since:
            last[new], first[new] = last.get(b, b), first.get(a, a)
        borders = sorted({(last.get(a, a), first.get(b, b)) for a, b, _ in chosen})
        border_keys = np.array([(a << 32) | b for a, b in borders])
        chosen_keys = np.array([(a << 32) | b for a, b, _ in chosen])

        def run(batches):
            for batch in batches:
                freq = batch.column(2).to_numpy()
                ids, word = column_symbols(batch.column(1))
                # a word comes once for each border it holds: only the row of the least one counts
                keys, of = pair_keys(ids, word)
                least = np.full(batch.num_rows, np.iinfo(np.int64).max)
                held = np.isin(keys, border_keys)
                np.minimum.at(least, of[held], keys[held])
                left, right = column_symbols(batch.column(0))[0].reshape(-1, 2).T
                own = (left << 32) | right
                mine = (least == own)[word]
                ids, word = merge_all(ids[mine], word[mine], since)
                keys, of = pair_keys(ids, word)
                touched = np.zeros(batch.num_rows, bool)
                touched[of[np.isin(keys, chosen_keys)]] = True
                ids, word = ids[touched[word]], word[touched[word]]
                old, of_old = pair_keys(ids, word)
                new, of_new = pair_keys(*merge_all(ids, word, chosen))
                keys, change = _summed(np.concatenate([old, new]), np.concatenate([-freq[of_old], freq[of_new]]))
                keys, change = keys[change != 0], change[change != 0]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(change)], names=["pair", "n"])

        hit = self.index.where(F.col("pair").isin([sym_char(a) + sym_char(b) for a, b in borders]))
        got = hit.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n <> 0")
        return [(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF, r["n"]) for r in got.collect()]


def choose(top: list[tuple[int, int, int]], floor: int) -> list[tuple[int, int, int]]:
    """The pairs, from the head of ``top``, that one-at-a-time merging would take next.

    ``top`` is a head of all pairs by (count falling, left, right); pairs of ``floor`` or less may be missing.
    Two pairs interact only if one's right symbol is the other's left.  Pairs are taken up to the
    first that interacts with a taken one.  Merging (a, b) to c makes pairs (x, c) and (c, y), which are no
    more frequent than (x, a) and (b, y); these interact with (a, b), so they stand behind all taken pairs.
    As c is the greatest symbol, the pairs made stand behind those in the order too, ties included.
    """
    taken, lefts, rights = [], set(), set()
    for a, b, n in top:
        if taken and (n <= floor or a in rights or b in lefts):
            break
        taken.append((a, b, n))
        lefts.add(a)
        rights.add(b)
        if a == b:  # interacts with itself
            break
    return taken


class Counts:
    """Pair counts on the driver: exact for all pairs above ``floor``."""

    def __init__(self, top: list[tuple[int, int, int]], limit: int):
        self.n = {(a, b): n for a, b, n in top}
        self.floor = top[-1][2] if len(top) == limit else 0

    def best(self, k: int = CANDIDATES) -> list[tuple[int, int, int]]:
        return [(a, b, n) for (a, b), n in heapq.nsmallest(k, self.n.items(), key=lambda e: (-e[1], e[0]))]

    def add(self, changes: list[tuple[int, int, int]], oldest_new: int) -> None:
        """``oldest_new``: symbols from here on were made in this round."""
        for a, b, change in changes:
            known = self.n.get((a, b))
            if known is not None:
                if known + change > 0:
                    self.n[a, b] = known + change
                else:
                    del self.n[a, b]
            elif max(a, b) >= oldest_new and change > self.floor:
                self.n[a, b] = change
