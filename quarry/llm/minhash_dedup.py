"""Operator 3: near-duplicate documents by one-permutation MinHash.

A document is the set of its distinct word shingles (64-bit hashes).  One
permutation hashing with optimal densification gives ``BANDS * ROWS`` bins;
``ROWS`` bins together make a band hash.  Documents with equal sets collapse to one
node first.  Within a bucket (equal band hash) candidate edges form a star around
one centre, so a bucket of n nodes gives n - 1 edges, not n squared.  Every edge
is confirmed by the exact Jaccard similarity of the two full sets.  Two stars are
drawn, around the smallest and the largest node.  Nodes of a bucket that are
still in different components after that are compared across components, so no link
inside a bucket is lost.  The join that finds these pairs lets only those through that
can reach the similarity: every set has a bitmap of ``BITS`` bits in which each shingle
flips one bit, and the bits in which two bitmaps differ are a lower bound of the sets'
symmetric difference.  That bound loses no pair, and it keeps near copies of one text that
are too far apart from becoming pairs.

At similarity 0.8 a pair shares no bucket with probability
(1 - 0.8**7)**48 = 1.2e-5.

Skew: equal sets are merged by a partial aggregate before anything is joined, the
star's centre comes from a partial aggregate, and all joins are plain equi-joins
that adaptive execution can split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import vec
from quarry.llm.graph import components
from quarry.session import cut_lineage

BANDS, ROWS = 48, 7
BITS = 1024


def shingle_set(hashes: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, no words give none."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    if len(hashes) < shingle:
        return np.array([vec.sequence_hash(hashes)], np.uint64)
    return np.unique(vec.ngrams(hashes, shingle))


def _sets(batches, shingle):
    """(row index in batch, batch, set) for every row of (id, text) batches."""
    hasher = vec.Hasher()
    for batch in batches:
        for i, j, words in vec.word_chunks(batch.column(1), hasher):
            yield batch, i, j, [shingle_set(words.hashes[words.woff[r]: words.woff[r + 1]], shingle)
                                for r in range(j - i)]


def _digest(u: np.ndarray) -> bytes | None:
    return hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, n_shingles, digest, bands): digest and bands are null for an empty set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        perm, edges = vec.bin_orders(BANDS * ROWS), vec.bin_edges(BANDS * ROWS)
        weights = vec.mix64(np.arange(1, ROWS + 1, dtype=np.uint64))
        salt = vec.mix64(np.arange(100, 100 + BANDS, dtype=np.uint64))
        for batch, i, j, sets in _sets(batches, shingle):
            bands = []
            for u in sets:
                if len(u):
                    sig = vec.one_permutation(u, edges, perm).reshape(BANDS, ROWS)
                    bands.append(vec.mix64((vec.mix64(sig) * weights).sum(1, dtype=np.uint64) ^ salt).view(np.int64))
                else:
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([len(u) for u in sets], pa.int64()),
                 pa.array([_digest(u) for u in sets], pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_shingles long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, id_type: str, shingle: int) -> DataFrame:
    """(id, shingles, bits) of (id, text) rows; bits: the parity bitmap as longs."""

    def run(batches):
        for batch, i, j, sets in _sets(batches, shingle):
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([u.view(np.int64) for u in sets], longs),
                 pa.array([parity_bits(u) for u in sets], longs)], names=["id", "shingles", "bits"])

    return docs.mapInArrow(run, f"id {id_type}, shingles array<long>, bits array<long>")


def parity_bits(u: np.ndarray) -> np.ndarray:
    """Bitmap of BITS bits; every hash flips the bit that its own low bits name."""
    flips = np.bincount((vec.mix64(u) % np.uint64(BITS)).astype(np.int64), minlength=BITS)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64)


def _can_reach(percent: int, a: str, b: str) -> Column:
    """Whether sets of sizes a_n, b_n and bitmaps a_bits, b_bits may be similar enough.

    100 * |A & B| >= percent * |A | B| holds just if (100 + percent) * |A ^ B| is at most
    (100 - percent) * (|A| + |B|), and |A ^ B| is at least the number of differing bits.
    """
    differ = F.lit(0)
    for k in range(BITS // 64):
        differ = differ + F.bit_count(F.get(f"{a}bits", F.lit(k)).bitwiseXOR(F.get(f"{b}bits", F.lit(k))))
    return (100 + percent) * differ <= (100 - percent) * (F.col(f"{a}n") + F.col(f"{b}n"))


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs (a, b), the smaller id first."""
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) whose sets have Jaccard similarity of at least percent / 100."""
    left = edges.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = left.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """One row per input row: (id_col, n_shingles, component_id, kept).

    ``component_id`` is the smallest id that is reachable over links (pairs with
    Jaccard similarity >= ``threshold``), the row's own id included; ``kept`` marks
    the rows that carry it.  A text without words (null or empty) has the empty set
    and is linked with nothing.  Rows that share an id are one document for linking
    and each returns a row.  A null id is linked with nothing, has a null component
    and is kept.  Other columns are ignored.
    """
    percent = round(100 * threshold)
    kind = docs.schema[id_col].dataType.simpleString()
    sig = cut_lineage(signatures(docs, id_col, text_col, shingle))
    known = sig.where("digest is not null and id is not null")
    nodes = known.groupBy("digest").agg(F.min("id").alias("rep"))
    rows = cut_lineage(known.select("id", "digest", "n_shingles").join(nodes, "digest")
                       .select("id", "rep", "n_shingles").distinct())
    reps = rows.where("id = rep").select("id").distinct()
    banded = known.join(reps, "id").select("id", F.explode("bands").alias("key"))
    # buckets with at least two nodes; their smallest and largest node are the star centres
    stars = banded.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    members = cut_lineage(banded.join(stars, "key"))
    sets = cut_lineage(full_sets(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
            members.select("id").distinct(), "id"), kind, shingle))
    spokes = members.select("id", F.explode(F.array("first", "last")).alias("centre")).where("id <> centre")
    links = cut_lineage(_confirm(_pairs(spokes, "id", "centre"), sets, percent))
    labels = components(links)
    # members of buckets that still hold several components are compared across components
    named = members.select("key", "id").join(labels.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("component", F.coalesce("component", "id"))
    split = named.groupBy("key").agg(F.min("component").alias("lc"), F.max("component").alias("hc")) \
        .where("lc <> hc").select("key")
    rest = cut_lineage(named.join(split, "key").join(sets.select("id", F.size("shingles").alias("n"), "bits"), "id"))
    other = rest.select("key", *[F.col(c).alias(f"o_{c}") for c in ("id", "component", "n", "bits")])
    across = rest.join(other, "key").where((F.col("id") < F.col("o_id")) & (F.col("component") != F.col("o_component"))
                                           & _can_reach(percent, "", "o_"))
    found = cut_lineage(_confirm(_pairs(across, "id", "o_id"), sets, percent))
    if not found.isEmpty():
        labels = components(links.unionByName(found))
    # rows that share an id but have different sets tie their nodes together
    ties = rows.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    if not ties.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties))
    groups = rows.select("id", "rep").distinct().join(labels.withColumnRenamed("node", "rep"), "rep", "left") \
        .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = sig.select("id", "n_shingles").join(groups, "id", "left") \
        .withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                         threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose document is its group's kept one, all columns unchanged.

    Rows that share an id stand or fall together; rows with a null id stay.
    """
    gone = near_duplicates(docs, id_col, text_col, shingle, threshold).where("not kept") \
        .select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
