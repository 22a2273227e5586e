import random

from pyspark.sql import functions as F

from quarry.constants import ASSISTANT_HEADER
from quarry.functions.arrays import (assistant_span_mask, attention_mask, cut_at_stop, left_crop, length_mask,
                                     pad_right, shift_mask, shift_x, shift_y, truncate)
from quarry.functions.literal import encode_literal
from quarry.operators.sequences import pack_blocks


def scan_mask(ids, header, eos):
    """Brute force: the reference's left-to-right scan."""
    mask, a, n, i = [0] * len(ids), len(header), len(ids), 0
    while i < n - a:
        if ids[i:i + a] == header:
            j = next((k for k in range(i + a, n) if ids[k] == eos), None)
            if j is not None:
                for p in range(i + a, j + 1):
                    mask[p] = 1
            i += a
        else:
            i += 1
    return mask


def test_shift_pad_truncate(spark):
    df = spark.createDataFrame([(list(range(1, 513)),), ([7, 8],)], "ids array<int>")
    r = df.select(pad_right(truncate(F.col("ids"), 512), 512, 4).alias("p"),
                  length_mask(F.size(truncate(F.col("ids"), 512)), 512).alias("m")) \
        .select(shift_x(F.col("p")).alias("x"), shift_y(F.col("p")).alias("y"), shift_mask(F.col("m")).alias("lm")).collect()
    assert r[0].x == list(range(1, 512)) and r[0].y == list(range(2, 513)) and r[0].lm == [1] * 511
    assert r[1].x == [7, 8] + [4] * 509 and r[1].y == [8] + [4] * 510 and r[1].lm == [1] + [0] * 510


def test_q5_hand_cases(spark):
    h = [3, 7, 9]
    base = [0] * 512
    c1 = list(base)
    c1[6:9] = h
    c1[12] = 4
    c2 = list(base)
    c2[6:9] = h  # reply without eos to the end
    c3 = list(base)
    c3[509:512] = h  # header in the last a slots: never seen
    c4 = [4] * 512
    df = spark.createDataFrame([(c,) for c in (c1, c2, c3, c4)], "ids array<int>")
    got = [r.m for r in df.select(assistant_span_mask(F.col("ids"), h, 4).alias("m")).collect()]
    exp1 = [0] * 512
    exp1[9:13] = [1] * 4
    assert got[0] == exp1
    assert got[1] == [0] * 512 and got[2] == [0] * 512 and got[3] == [0] * 512


def test_q5_random_equals_scan(spark):
    rnd = random.Random(7)
    h = encode_literal(ASSISTANT_HEADER)
    seqs = []
    for _ in range(300):
        n = rnd.choice([0, 5, 11, 12, 40, 128])
        s = [rnd.choice([4, 5, 6, 203]) for _ in range(n)]
        for _ in range(rnd.randint(0, 4)):
            if n > len(h):
                p = rnd.randint(0, n - len(h))
                s[p:p + len(h)] = h
        seqs.append(s)
    df = spark.createDataFrame([(s,) for s in seqs], "ids array<int>")
    got = [r.m for r in df.select(assistant_span_mask(F.col("ids"), h, 4).alias("m")).collect()]
    assert got == [scan_mask(s, h, 4) for s in seqs]


def test_attention_crop_stop(spark):
    df = spark.createDataFrame([([5, 4, 6, 4, 4],)], "ids array<int>")
    r = df.select(attention_mask(F.col("ids"), 4).alias("a"), left_crop(F.col("ids"), 3).alias("c"),
                  cut_at_stop(F.col("ids"), 6, 256).alias("s"), cut_at_stop(F.col("ids"), 9, 2).alias("s2")).collect()[0]
    assert r.a == [True, False, True, False, False]
    assert r.c == [4, 4, 4][:0] + [4, 4][:0] + [4, 4, 4][:0] + r.c and r.c == [6, 4, 4]
    assert r.s == [5, 4] and r.s2 == [5, 4]


def _pack(spark, sizes, block, batch):
    rows = [(i, list(range(100 * i, 100 * i + s))) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "k long, input_ids array<int>").withColumn(
        "attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    out = pack_blocks(df, ["k"], block_size=block, batch_size=batch).orderBy("batch", "block").collect()
    return [(r.batch, r.block, r.input_ids, r.labels == r.input_ids, len(r.attention_mask)) for r in out]


def brute_pack(sizes, block, batch):
    out = []
    for b in range(0, len(sizes), batch):
        cat = [x for i in range(b, min(b + batch, len(sizes))) for x in range(100 * i, 100 * i + sizes[i])]
        total = len(cat) if len(cat) < block else (len(cat) // block) * block
        for k, s in enumerate(range(0, total, block)):
            out.append((b // batch, k, cat[s:s + block]))
    return out


def test_pack_hand_cases(spark):
    got = _pack(spark, [4, 6], 4, 1000)  # 10 ids -> two blocks of 4, 2 lost
    assert [(g[2]) for g in got] == [[0, 1, 2, 3], [100, 101, 102, 103]] and all(g[3] for g in got)
    got = _pack(spark, [3], 4, 1000)  # 3 ids -> one short block
    assert [g[2] for g in got] == [[0, 1, 2]]
    got = _pack(spark, [0, 0], 4, 1000)  # no ids -> no block
    assert got == []


def test_pack_random_equals_loop(spark):
    rnd = random.Random(3)
    sizes = [rnd.choice([0, 1, 3, 7, 20]) for _ in range(60)]
    for block, batch in [(4, 7), (16, 10), (64, 1000), (5, 1)]:
        got = [(a, b, c) for a, b, c, _, _ in _pack(spark, sizes, block, batch)]
        assert got == brute_pack(sizes, block, batch), (block, batch)
