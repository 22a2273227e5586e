"""Operator 8: repeated passages by a sparse suffix array.

A suffix of a text starts at a word.  Only suffixes at minimisers are retained: of
every ``MIN_WORDS - GRAM + 1`` consecutive word ``GRAM``-grams the one with the smallest
hash, so any passage of ``MIN_WORDS`` words has one in each of its copies, at the same
place.  Suffixes whose first ``GRAM`` words occur in one document only are left out;
the others are sorted by their words, in range partitions.  Each is extended left and
right to every window of ``MIN_WORDS`` words around its gram; for each alignment of the
window the suffixes of a gram are sorted, and neighbours from different documents that
agree over the whole window match.  So a suffix finds the furthest match on either side,
even if they are with different documents.  A longer repeat holds further retained
suffixes, each of which finds its part; the union of a document's matches covers it.

Cost: linear in the suffixes times the alignments, however often a passage occurs; no
pairs are made.  The range partitioning on (words, document, place) splits even a
passage that a third of all documents share.  What such a split separates, the windows
of a partition's first and last gram, is matched by one aggregate over all partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import vec
from quarry.llm.keys import row_key
from quarry.session import cut_lineage

MIN_WORDS = 50
GRAM = 16


def minimiser_places(words: vec.Words, grams: np.ndarray, gram: int, min_words: int) -> np.ndarray:
    """Word places (ascending) of the smallest of every min_words - gram + 1 consecutive grams of a text."""
    width = min_words - gram + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    rank = vec.mix64(grams ^ np.uint64(0xABCDEF))
    at = np.arange(n) + np.lib.stride_tricks.sliding_window_view(rank, width).argmin(1)
    # only windows inside one text
    text = np.searchsorted(words.woff, np.arange(n), "right") - 1
    return np.unique(at[np.arange(n) + min_words <= words.woff[text + 1]])


def retained(docs: DataFrame, text_col: str, gram: int, min_words: int) -> DataFrame:
    """(_k1, _k2, grams, places): minimisers of each text that has any."""

    def run(batches):
        hasher = vec.Hasher()
        for batch in batches:
            for i, j, words in vec.word_chunks(batch.column(2), hasher):
                grams = vec.ngrams(words.hashes, gram)
                at = minimiser_places(words, grams, gram, min_words)
                cut = np.searchsorted(at, words.woff)
                own = [(k, at[cut[k]: cut[k + 1]]) for k in range(j - i) if cut[k] < cut[k + 1]]
                if own:
                    rows = pa.array([i + k for k, _ in own])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows),
                         pa.array([grams[p].view(np.int64) for _, p in own], pa.list_(pa.int64())),
                         pa.array([p - words.woff[k] for k, p in own], pa.list_(pa.int32()))],
                        names=["_k1", "_k2", "grams", "places"])

    return docs.select("_k1", "_k2", F.col(text_col).alias("text")).mapInArrow(
        run, "_k1 long, _k2 long, grams array<long>, places array<int>")


def suffixes(docs: DataFrame, id_type: str, gram: int, min_words: int) -> DataFrame:
    """Sort keys and contexts of the suffixes at ``places`` of (id, _k1, _k2, text, places) rows.

    ``after`` and ``before``: 32-bit hashes of the words after the gram, and of those before
    it from right to left, as far as a match of min_words can need; 0 beyond the text.
    """
    reach = min_words - gram

    def run(batches):
        hasher = vec.Hasher()
        steps = np.arange(reach)
        for batch in batches:
            places_of = batch.column(4)
            for i, j, words in vec.word_chunks(batch.column(3), hasher):
                small = (words.hashes >> np.uint64(32)).astype("<u4") | np.uint32(1)
                lists = places_of.slice(i, j - i).to_pylist()
                row = np.repeat(np.arange(j - i), [len(p) for p in lists])
                place = np.concatenate([np.array(sorted(p), np.int64) for p in lists])
                at = words.woff[row] + place
                right = at[:, None] + gram + steps
                left = at[:, None] - 1 - steps
                last = len(small) - 1
                after = np.where(right < words.woff[row + 1][:, None], small[np.minimum(right, last)], 0).astype("<u4")
                before = np.where(left >= words.woff[row][:, None], small[np.maximum(left, 0)], 0).astype("<u4")
                grams = vec.ngrams(words.hashes, gram)[at]
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(2).take(rows),
                     pa.array(grams.view(np.int64)), pa.array(place.astype(np.int32)),
                     pa.array([x.tobytes() for x in after], pa.binary()),
                     pa.array([x.tobytes() for x in before], pa.binary())], names=names)

    names = ["id", "_k1", "_k2", "gram", "place", "after", "before"]
    return docs.select("id", "_k1", "_k2", "text", "places").mapInArrow(
        run, f"id {id_type}, _k1 long, _k2 long, gram long, place int, after binary, before binary")


def window_hashes(gram: np.ndarray, after: np.ndarray, before: np.ndarray):
    """For each alignment k (words of the window before the gram): (k, rows that have it, hashes)."""
    reach = after.shape[1]
    weight = vec.mix64(np.arange(1, 2 * reach + 1, dtype=np.uint64)) | np.uint64(1)
    right = np.zeros((len(gram), reach + 1), np.uint64)
    left = np.zeros((len(gram), reach + 1), np.uint64)
    np.cumsum(vec.mix64(after.astype(np.uint64)) * weight[:reach], 1, out=right[:, 1:])
    np.cumsum(vec.mix64(before.astype(np.uint64)) * weight[reach:], 1, out=left[:, 1:])
    n_right, n_left = (after != 0).sum(1), (before != 0).sum(1)
    for k in range(reach + 1):
        rows = np.flatnonzero((n_left >= k) & (n_right >= reach - k))
        yield k, rows, vec.mix64(vec.mix64(gram[rows] + np.uint64(k)) + right[rows, reach - k] + left[rows, k])


def compare_neighbours(id_type: str, gram: int, min_words: int):
    """A mapInArrow function over sorted suffixes.

    Rows (kind, id, _k1, _k2, start, stop, other, hash); kind 0 is a match of words start to
    stop with document ``other``, kind 1 a window of a gram that may go on in another
    partition: all its unmatched windows, and of matched ones two documents'.
    """
    cols = ["id", "_k1", "_k2", "gram", "place", "after", "before"]
    names = ["kind", "id", "_k1", "_k2", "start", "stop", "other", "hash"]
    reach = min_words - gram

    def matches(t: pa.Table, open_rows: np.ndarray):
        doc = t["_k1"].to_numpy()
        key = t["gram"].to_numpy().view(np.uint64)
        place = t["place"].to_numpy().astype(np.int64)
        after, before = (np.frombuffer(b"".join(t[c].to_pylist()), "<u4").reshape(len(t), reach) for c in ("after", "before"))
        n = len(t)
        least, most, other = np.full(n, reach + 1), np.full(n, -1), np.zeros(n, np.int64)
        edges = []
        for k, rows, h in window_hashes(key, after, before):
            order = np.lexsort((doc[rows], h))
            rows, h = rows[order], h[order]
            if not len(rows):
                continue
            begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            end = np.r_[begin[1:], len(h)]
            lo, hi = rows[begin], rows[end - 1]  # the window's smallest and largest document
            run = np.repeat(np.arange(len(begin)), end - begin)
            shared = doc[lo] != doc[hi]
            hit = shared[run]
            r = rows[hit]
            least[r] = np.minimum(least[r], k)
            most[r] = k
            other[r] = np.where(doc[r] != doc[lo[run[hit]]], lo[run[hit]], hi[run[hit]])
            keep = open_rows[rows] & (~hit | (rows == lo[run]) | (rows == hi[run]))
            edges.append((rows[keep], np.full(keep.sum(), k), h[keep]))
        found = np.flatnonzero(most >= 0)
        head = [t[c].combine_chunks() for c in cols[:3]]

        def batch(kind, rows, start, stop, others, hashes):
            at = pa.array(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), kind, np.int32)), *[c.take(at) for c in head], pa.array(start), pa.array(stop),
                 others, hashes], names=names)

        yield batch(0, found, place[found] - most[found], place[found] - least[found] + min_words,
                    head[0].take(pa.array(other[found])), pa.nulls(len(found), pa.int64()))
        if edges:
            r, k, h = (np.concatenate(x) for x in zip(*edges))
            yield batch(1, r, place[r] - k, place[r] - k + min_words, pa.nulls(len(r), head[0].type), pa.array(h.view(np.int64)))

    def run(batches):
        held, first_gram = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch]).select(cols)
            held = t if held is None else pa.concat_tables([held, t])
            key = held["gram"].to_numpy()
            first_gram = key[0] if first_gram is None else first_gram
            whole = int(np.searchsorted(key, key[-1]))  # rows are sorted by gram
            if whole > 5000:
                yield from matches(held.slice(0, whole), key[:whole] == first_gram)
                held = held.slice(whole)
        if held is not None:
            key = held["gram"].to_numpy()
            yield from matches(held, (key == first_gram) | (key == key[-1]))

    return run, f"kind int, id {id_type}, _k1 long, _k2 long, start long, stop long, other {id_type}, hash long"


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      gram: int = GRAM) -> DataFrame:
    """One row per maximal repeated span: (id_col, first_word, end_word, n_words, other_id).

    A span is a run of words, from ``first_word`` up to but not including ``end_word``
    (places in the text's words, from 0), covered by passages of at least ``min_words`` words
    that also stand in another document; ``other_id`` is the smallest id among the compared
    documents that share part of it.  Words are runs without white space, A-Z
    lower-cased.  Null, empty and shorter texts have no spans.  Rows are told apart by
    id and text: rows equal in both are one document (and give its spans once), rows
    with null or repeated ids but different texts are different documents.  Other columns
    are ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null") \
        .select("*", *row_key("id", "text"))
    kept = cut_lineage(retained(keyed, "text", gram, min_words))
    single = kept.select("_k1", "_k2", F.explode(F.arrays_zip("grams", "places")).alias("x")) \
        .select("_k1", "_k2", F.col("x.grams").alias("gram"), F.col("x.places").alias("place"))
    shared = single.groupBy("gram").agg(F.min("_k1").alias("lo"), F.max("_k1").alias("hi")).where("lo <> hi")
    hits = single.join(shared.select("gram"), "gram").groupBy("_k1", "_k2").agg(F.collect_set("place").alias("places"))
    texts = keyed.join(hits, ["_k1", "_k2"])
    sparse = suffixes(texts, kind, gram, min_words)
    order = ["gram", "after", "_k1", "_k2", "place"]
    compare, schema = compare_neighbours(kind, gram, min_words)
    found = cut_lineage(sparse.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, schema))
    ends = found.where("kind = 1").drop("other")
    apart = ends.groupBy("hash").agg(F.min("_k1").alias("lo"), F.max("_k1").alias("hi"), F.min_by("id", "_k1").alias("lo_id"),
                                     F.max_by("id", "_k1").alias("hi_id")).where("lo <> hi")
    across = ends.join(apart, "hash").withColumn("other", F.when(F.col("_k1") == F.col("lo"), F.col("hi_id"))
                                                 .otherwise(F.col("lo_id")))
    span = ["id", "_k1", "_k2", "start", "stop", "other"]
    matches = found.where("kind = 0").select(*span).unionByName(across.select(*span))
    earlier = Window.partitionBy("_k1", "_k2").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_k1", "_k2").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    parted = matches \
        .withColumn("new", F.coalesce(F.col("start") > F.max("stop").over(earlier), F.lit(True)).cast("int")) \
        .withColumn("span", F.sum("new").over(upto))
    spans = parted.groupBy("_k1", "_k2", "span").agg(
        F.min("id").alias("id"), F.min("start").alias("first_word"), F.max("stop").alias("end_word"),
        F.min("other").alias("other_id"))
    return spans.select(F.col("id").alias(id_col), "first_word", "end_word",
                        (F.col("end_word") - F.col("first_word")).alias("n_words"), "other_id")
