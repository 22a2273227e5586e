"""Operator 13: hard-negative mining by slot-decomposed selection.

Every anchor is scored against all rows by inner products of integer vectors.  An anchor's
positives are its best rows of the same label.  A positive with score P asks for the best
rows of other labels in the window [low * P, P]; the windows of one anchor overlap.  Their
upper limits P1 >= P2 >= ... cut the scores into disjoint slots (P2, P1], (P3, P2], ..., and
the last one below.  Each task keeps the top k rows of every slot, a combiner keeps the top k of all
tasks, and as the rows under a limit P_j are those of slot j and all lower ones,
one merge from the lowest slot upwards, keeping k, answers all windows: a row of
window j among the first k under P_j is among the first k of its slot.  The lower
limits cut the answers afterwards, since a window's rows are a head of that list.

Anchors go to the tasks in blocks of a bounded size, one after another; rows are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.vectors import common_length, int_matrix
from quarry.session import cut_lineage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW = 80  # per cent of the positive's score
ANCHORS = 20_000  # anchors in a block
BLOCK_BYTES = 64 << 20  # of a block's vectors
PRODUCTS = 2_000_000  # scores held at once in a task
_LEAST = np.iinfo(np.int64).min


class Anchors:
    """A block of anchors, ascending by id: ids, labels, integer vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.most = int(np.abs(x).max()) if x.size else 0

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors x rows."""
        bound = self.most * (int(np.abs(rows).max()) if rows.size else 0) * max(rows.shape[1], 1)
        if bound < 1 << 53:  # exact in doubles
            return (self.x.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
        return self.x @ rows.T


class Best:
    """The first ``k`` distinct (score falling, id rising) entries of each of ``groups`` lists."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(groups, _LEAST)  # score of the k-th entry, once there are k

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        near = score >= self.floor[group]
        group, score, ids = (np.concatenate([a, b[near]]) for a, b in
                             ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        group, score, ids = group[new], score[new], ids[new]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = place < self.k
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]
        full = place == self.k - 1
        self.floor[group[full]] = score[full]


def slots_of(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The slot of each score (anchors x rows): how many of the anchor's limits (falling; missing ones
    least) are not under it.  0: above all limits."""
    slot = np.zeros(scores.shape, np.int64)
    for j in range(limits.shape[1]):
        slot += (scores <= limits[:, j: j + 1]) & (limits[:, j: j + 1] > _LEAST)
    return slot


def suffix_answers(slots: dict[int, list[tuple[int, int]]], limits: list[int], k: int, low: int = LOW):
    """For each limit (falling) the first k (score, id) of slots j, j+1, ... that lie at low % of it or above.

    ``slots[j]`` (from 1) has the first k entries of slot j, in order.  Every entry of a slot
    is above every entry of a lower one, so a merge puts it in front.
    """
    out, rest = [None] * len(limits), []
    for j in range(len(limits), 0, -1):
        rest = (slots.get(j, []) + rest)[:k]
        out[j - 1] = [(s, i) for s, i in rest if low * limits[j - 1] <= 100 * s]
    return out


def prepared(df: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """(id, label, vec) of the rows with an id, a label and a vector."""
    out = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec"))
    return out.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())


def _numbers(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).astype(np.int64)


def _stored_anchors(rows: DataFrame, is_anchor: Column, dim: int, scale: int) -> DataFrame:
    """(id, label, x) of the anchors, one row an id, ``x`` the 64-bit integer vector."""

    def run(batches):
        for batch in batches:
            at, x = int_matrix(batch.column(2), dim, scale)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "x"])

    found = rows.where(is_anchor).mapInArrow(run, "id long, label long, x binary")
    return cut_lineage(found.groupBy("id").agg(F.min(F.struct("label", "x")).alias("a")).select("id", "a.*"))


def _blocks(anchors: DataFrame, dim: int):
    """Blocks of a bounded number of anchors: id ranges whose sizes are counted beforehand."""
    size = max(1, min(ANCHORS, BLOCK_BYTES // (8 * dim)))
    total = anchors.count()
    if not total:
        return
    buckets = -(-total // max(size // 2, 1))
    held = anchors.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    waiting, n = [], 0
    for r in held.groupBy("_b").count().orderBy("_b").collect() + [None]:
        if waiting and (r is None or n + r["count"] > size):
            got = held.where(F.col("_b").isin(waiting)).select("id", "label", "x").orderBy("id").collect()
            yield Anchors(np.array([g.id for g in got]), np.array([g.label for g in got]),
                          np.stack([np.frombuffer(g.x, "<i8") for g in got]))
            waiting, n = [], 0
        if r is not None:
            waiting.append(r["_b"])
            n += r["count"]


def _select(rows: DataFrame, a: Anchors, dim: int, scale: int, limits: np.ndarray | None, k: int) -> DataFrame:
    """(anchor, slot, score, id): the first k rows of each anchor and slot; with no limits of the same label (slot 0)."""
    width = 1 if limits is None else limits.shape[1] + 1
    step = max(1, PRODUCTS // len(a.ids))

    def run(batches):
        best = Best(len(a.ids) * width, k)
        for batch in batches:
            at, x = int_matrix(batch.column(2), dim, scale)
            ids, labels = _numbers(batch.column(0))[at], _numbers(batch.column(1))[at]
            for i in range(0, len(x), step):
                part = slice(i, i + step)
                s = a.scores(x[part])
                same = a.labels[:, None] == labels[None, part]
                other = a.ids[:, None] != ids[None, part]
                if limits is None:
                    fits, slot = same & other, np.zeros(s.shape, np.int64)
                else:
                    slot = slots_of(s, limits)
                    fits = ~same & other & (slot > 0)
                group = np.arange(len(a.ids))[:, None] * width + slot
                fits &= s >= best.floor[group]
                which = np.nonzero(fits)
                best.add(group[which], s[which], ids[part][which[1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.ids[best.group // width]), pa.array((best.group % width).astype(np.int32), pa.int32()),
             pa.array(best.score), pa.array(best.id)], names=["anchor", "slot", "score", "id"])

    got = rows.mapInArrow(run, "anchor long, slot int, score long, id long")
    # the combiner: Spark cuts each task's part of a group to k before the shuffle as well
    place = F.dense_rank().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return got.withColumn("rank", place).where(F.col("rank") <= k).distinct()


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         label: Column | str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the columns ``id`` and ``label``.  An anchor's positives are the first ``positives``
    other rows of its label by (score falling, id rising); for each, the first ``negatives``
    rows of other labels with low * positive_score <= 100 * negative_score <= 100 * positive_score
    come back, ranked from 1.  Fewer where there are fewer; an anchor without positives, and a
    positive without such rows (always, if its score is negative), gives no rows.  Rows without an
    id or a label, or whose vector takes no part (``vectors.int_matrix``), are left out.  Rows with an
    id and a score in common count once per anchor; a repeated anchor id counts once, with its least
    (label, vector).  Ids of other rows never equal the anchor's.  An empty table gives no rows.
    """
    rows = prepared(df, id_col, vec_col, F.col(label) if isinstance(label, str) else label)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    dim = common_length(rows, "vec")
    out = df.sparkSession.createDataFrame([], schema)
    if not dim:
        return out
    for a in _blocks(_stored_anchors(rows, is_anchor, dim, scale), dim):
        # at most anchors x positives rows: bounded by the block
        found = _select(rows, a, dim, scale, None, positives).orderBy("anchor", "rank").collect()
        place = np.searchsorted(a.ids, [r.anchor for r in found])
        limits = np.full((len(a.ids), positives), _LEAST)
        chosen = np.zeros((len(a.ids), positives), np.int64)
        if len(found):
            rank = np.array([r["rank"] for r in found]) - 1
            limits[place, rank] = [r.score for r in found]
            chosen[place, rank] = [r.id for r in found]
        # stored block by block, so that the driver holds one block at a time
        out = out.unionByName(cut_lineage(_answers(_select(rows, a, dim, scale, limits, negatives), a.ids, limits, chosen,
                                                   negatives, low, schema)))
    return out


def _answers(slots: DataFrame, ids, limits, chosen, k: int, low: int, schema: str) -> DataFrame:
    """The windows' rows from each anchor's slots (a bounded group: slots times k entries)."""
    lists = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(
        F.struct("slot", (-F.col("score")).alias("s"), "id"))).alias("e"))

    def run(batches):
        for batch in batches:
            rows = []
            for anchor, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                i = int(np.searchsorted(ids, anchor))
                n = int((limits[i] > _LEAST).sum())
                by_slot: dict[int, list[tuple[int, int]]] = {}
                for e in entries:
                    by_slot.setdefault(e["slot"], []).append((-e["s"], e["id"]))
                for j, got in enumerate(suffix_answers(by_slot, limits[i, :n].tolist(), k, low)):
                    rows += [(anchor, int(chosen[i, j]), r, neg, int(limits[i, j]), s) for r, (s, neg) in enumerate(got, 1)]
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                                    "negative_score"])

    return lists.mapInArrow(run, schema)
