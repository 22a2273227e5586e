"""Operator 5: document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed LZ78-style into phrases (the longest phrase seen so
far plus one byte).  The hashed phrase set is reduced by one-permutation MinHash to
``BINS`` bins of 16 bits, written as hex.  The share of equal bins estimates the
Jaccard similarity of two phrase sets, a compression-like similarity.

``edited_pairs`` also fingerprints each text with its end replaced by the start of
the next document.  Documents are dealt into id ranges whose lower bounds are ids of
the table; the document at a bound also goes to the range before it, so every
task sees the successor of each of its documents: one shuffle of the texts, no
global sort and no join.  The edited text shares its first three quarters with the
original, so the parse is continued from there and undone, not repeated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import vec

BINS = 128
_FIRST = -(1 << 63)


def parse(data: bytes, trie: dict, ends: list, at: int = 0, node: int = 0) -> tuple[int, list]:
    """LZ78 over ``data``, continuing in state ``node``; (state, keys added to ``trie``).

    ``ends`` receives the end (counted from ``at``) of every phrase.  A node's number is
    a multiple of 256, so node plus byte is an edge's key.
    """
    added = []
    get, new, end = trie.get, added.append, ends.append
    size = (len(trie) + 1) << 8
    for i, c in enumerate(data, at + 1):
        key = node + c
        node = get(key)
        if node is None:
            trie[key] = size
            size += 256
            new(key)
            end(i)
            node = 0
    return node, added


class Fingerprinter:
    """Signatures of phrase sets; make one per task."""

    def __init__(self, bins: int = BINS):
        self.hasher = vec.Hasher(fold=False)
        self.orders = vec.bin_orders(bins)
        self.edges = vec.bin_edges(bins)

    def signature(self, data: bytes, ends: list) -> np.ndarray | None:
        """16-bit bins of the phrases of ``data``; None without phrases."""
        if not ends:
            return None
        stop = np.array(ends)
        start = np.r_[0, stop[:-1]]
        phrases = np.unique(self.hasher.spans(np.frombuffer(data, np.uint8), start, stop))
        return (vec.one_permutation(phrases, self.edges, self.orders) >> np.uint64(3)).astype(np.uint16)

    def text(self, text: str) -> np.ndarray | None:
        data, ends = text.encode(), []
        parse(data, {}, ends)
        return self.signature(data, ends)

    def text_and_edited(self, text: str, after: str):
        """(signature, edited text, its signature); see ``edited_pairs``."""
        k = len(text) // 4
        head, tail, new = (x.encode() for x in (text[: len(text) - k], text[len(text) - k:], after[:k]))
        trie: dict = {}
        shared: list = []
        node, _ = parse(head, trie, shared)
        own = shared.copy()
        _, added = parse(tail, trie, own, len(head), node)
        for key in added:
            del trie[key]
        parse(new, trie, shared, len(head), node)
        edited = head + new
        return self.signature(head + tail, own), edited, self.signature(edited, shared)


def as_text(sig: np.ndarray | None) -> str:
    """Hex form of a signature; the empty text's is empty."""
    return "" if sig is None else sig.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal bins, less what 16-bit bins share by chance; two empty texts are alike."""
    if a is None or b is None:
        return float(a is None and b is None)
    return max(0.0, (float((a == b).mean()) - 2.0**-16) / (1 - 2.0**-16))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint) of every row, in one pass; a null text counts as empty (fingerprint "")."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        maker = Fingerprinter()
        for batch in batches:
            texts = (maker.text(x or "") for x in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([as_text(x) for x in texts], pa.string())],
                                             names=[id_col, "fingerprint"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, fingerprint string")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Documents are ordered by their integer id (null ids first), equal ids by text; the
    last one is followed by the first.  The edited text is the text with its last
    floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    one.  One row per input row; a null text counts as empty; other columns are ignored;
    an empty table gives no rows.  ``ranges`` (default four per shuffle partition) only
    sets how the work is split.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * parts
    cuts = [i / ranges for i in range(ranges)]
    low, picks = rows.agg(F.min("key"), F.percentile_approx("key", cuts, 100 * ranges)).first()
    kind = docs.schema[id_col].dataType.simpleString()
    bounds = np.array(sorted({low, *picks}) if low is not None else [0], np.int64)
    last = len(bounds) - 1

    @F.pandas_udf("array<int>")
    def homes(key: pd.Series) -> pd.Series:
        """The range of a document, and the one before it if it is the range's lower bound."""
        at = np.searchsorted(bounds, key.to_numpy(), "right") - 1
        first = bounds[at] == key.to_numpy()
        return pd.Series([[r, (r - 1) if r else last] if f else [r] for r, f in zip(at.tolist(), first.tolist())])

    dealt = rows.select("id", "text", "key", F.posexplode(homes("key")).alias("carry", "range")) \
        .repartition(2 * parts, "range").sortWithinPartitions("range", "carry", "key", "text")

    def run(batches):
        maker = Fingerprinter()
        out: list[tuple] = []

        def emit(item, near_next):
            key, n, sha, sig, esig = item
            out.append((key, n, sha, as_text(sig), as_text(esig), likeness(sig, esig), likeness(sig, near_next)))

        def result(key, text, after):
            sig, edited, esig = maker.text_and_edited(text, after)
            return key, len(text), hashlib.sha256(edited).hexdigest(), sig, esig

        def table():
            cols = list(zip(*out))
            out.clear()
            kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        now, open_row, waiting = None, None, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text, carry, home in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if home != now:
                    now, open_row, waiting = home, None, None
                if open_row is None:
                    if not carry:
                        open_row = (key, text)
                    continue  # further rows at the next range's bound
                done = result(*open_row, text)
                if waiting:
                    emit(waiting, done[3])
                waiting, open_row = done, (key, text)
                if carry:
                    emit(waiting, maker.text(text))
                    open_row, waiting = None, None
            if out:
                yield table()

    return dealt.select("id", "text", "carry", "range").mapInArrow(
        run, f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
