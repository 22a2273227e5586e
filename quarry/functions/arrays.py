"""Sequence (array<int>) operators Q1-Q5, Q7, Q9-Q11 as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.constants import EOS_ID, PAD_ID


def truncate(ids: Column, n: int) -> Column:
    """Q1: keep the first n ids."""
    return F.slice(ids, 1, n)


def pad_right(ids: Column, n: int, pad: int = PAD_ID) -> Column:
    """Q2: right-pad to width n with ``pad`` (ids already truncated to <= n)."""
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(n) - F.size(ids), F.lit(0))))


def length_mask(length: Column, n: int) -> Column:
    """Q3: 1 on the first ``length`` positions, 0 on the padding (by length, not id)."""
    real = F.least(length, F.lit(n))
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(n) - real))


def shift_x(ids: Column) -> Column:
    """Q4: X = ids[:-1]."""
    return F.slice(ids, 1, F.size(ids) - 1)


def shift_y(ids: Column) -> Column:
    """Q4: Y = ids[1:]."""
    return F.slice(ids, 2, F.size(ids) - 1)


shift_mask = shift_y  # Q4: mask = mask[1:]


def assistant_span_mask(ids: Column, header: list[int], eos: int = EOS_ID) -> Column:
    """Q5 on the padded ids.

    A header occurrence starting at i (strictly i < n - len(header)) opens a
    span at e = i + len(header) that closes at the first eos j >= e, eos
    included; an unclosed span sets nothing.  Headers cannot overlap (they start
    with im_start and hold no other im_start), so the scan's skip rule changes
    nothing and spans can be found independently.  Position p is 1 iff it lies
    in some closed span.
    """
    a = len(header)
    hdr = F.array(*[F.lit(h) for h in header])
    n = F.size(ids)
    starts = F.when(n > a, F.filter(F.sequence(F.lit(0), n - a - 1),
                                    lambda i: (ids[i] == header[0]) & (F.slice(ids, i + 1, a) == hdr))
                    ).otherwise(F.array().cast("array<int>"))
    spans = F.filter(
        F.transform(starts, lambda i: F.struct((i + a).alias("s"),
                                               F.array_position(F.slice(ids, i + a + 1, n), eos).alias("k"))),
        lambda sp: sp["k"] > 0)
    # fold the (few) spans over a zero mask: the span list is evaluated once per row
    zero = F.array_repeat(F.lit(0), n)
    return F.aggregate(spans, zero, lambda acc, sp: F.transform(
        acc, lambda x, p: F.when((p >= sp["s"]) & (p < sp["s"] + sp["k"]), 1).otherwise(x)))


def attention_mask(ids: Column, pad: int = PAD_ID) -> Column:
    """Q7: true where id <> pad (by id: real end markers equal to pad are masked too)."""
    return F.transform(ids, lambda x: x != pad)


def copy_labels(ids: Column) -> Column:
    """Q9: labels are the input ids, unshifted."""
    return ids


def left_crop(ids: Column, n: int) -> Column:
    """Q10: keep the last n ids when longer."""
    return F.when(F.size(ids) > n, F.slice(ids, -n, n)).otherwise(ids)


def cut_at_stop(ids: Column, stop: int, max_new: int = 256) -> Column:
    """Q11: ids before the first ``stop`` (stop excluded), at most ``max_new``."""
    pos = F.array_position(ids, stop)
    keep = F.when(pos > 0, pos - 1).otherwise(F.size(ids))
    return F.slice(ids, 1, F.least(keep.cast("int"), F.lit(max_new)))


def ids_text(ids: Column, sep: str = ",") -> Column:
    """Join an int array to text (for value comparison and plain-text sinks)."""
    return F.array_join(ids.cast("array<string>"), sep)  # a cast, not a lambda: stays in codegen
