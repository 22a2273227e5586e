"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the given tables in full.  Array results are rendered as
comma-joined text so that Spark and DuckDB values compare exactly.  The SQL
side is written independently (different formulation where practical: byte
ids by range arithmetic, masks by window scans, counts by arithmetic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.arrays import ids_text
from quarry.operators.chunk import split_text
from quarry.operators.scoring import mask_accounting
from quarry.plans.pretrain import pretrain_sequences
from quarry.plans.sft import sft_sequences
from quarry.plans.turn_labels import turn_label_sequences
from quarry.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL pieces
def sql_byte_id(b: str) -> str:
    return (f"(CASE WHEN {b} BETWEEN 33 AND 126 THEN {b} - 28 WHEN {b} BETWEEN 161 AND 172 THEN {b} - 62 "
            f"WHEN {b} BETWEEN 174 AND 255 THEN {b} - 63 WHEN {b} <= 32 THEN {b} + 193 "
            f"WHEN {b} BETWEEN 127 AND 160 THEN {b} + 99 ELSE 260 END)")


def sql_bytes(s: str) -> str:
    """DuckDB: list of byte ids of string expression ``s``."""
    return (f"list_transform(list_transform(range(0, octet_length(encode({s}))), "
            f"lambda i: ('0x' || substr(hex(encode({s})), 2*i+1, 2))::INTEGER), lambda b: {sql_byte_id('b')})")


def sql_text(lst: str) -> str:
    return f"array_to_string({lst}, ',')"


CHUNKS_SQL = """SELECT doc_id, lang, source, k::BIGINT AS chunk_idx, substring(text, k*512+1, 512) AS text
FROM (SELECT doc_id, lang, source, text, unnest(range(0, (length(text)+511)//512)) AS k
      FROM documents WHERE length(text) > 0)"""


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _chunks(spark, sf):
    return split_text(_docs(spark, sf).select("doc_id", "lang", "source", "text")) \
        .withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


# ---------------------------------------------------------------- T1
@register("t1_split_text", f"SELECT doc_id, chunk_idx, text FROM ({CHUNKS_SQL})")
def t1_split_text(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).select("doc_id", "chunk_idx", "text")


# ---------------------------------------------------------------- T5
@register("t5_byte_ids", f"""
WITH c AS ({CHUNKS_SQL}), e AS (SELECT doc_id, chunk_idx, {sql_bytes('text')} AS ids FROM c)
SELECT doc_id, chunk_idx, len(ids)::BIGINT AS n_ids, {sql_text('ids')} AS ids FROM e""")
def t5_byte_ids(spark, sf):
    from quarry.functions.bytes import byte_ids
    c = _chunks(spark, sf).select("doc_id", "chunk_idx", byte_ids(F.col("text")).alias("ids"))
    return c.select("doc_id", "chunk_idx", F.size("ids").cast("long").alias("n_ids"), ids_text(F.col("ids")).alias("ids"))


# ---------------------------------------------------------------- Q12
PRETRAIN_SQL = f"""
WITH c AS ({CHUNKS_SQL}),
e AS (SELECT doc_id, lang, chunk_idx, [3] || {sql_bytes('text')} AS ids FROM c),
t AS (SELECT doc_id, lang, chunk_idx, len(ids) AS n_tokens, ids[1:512] AS t FROM e),
p AS (SELECT doc_id, lang, chunk_idx, n_tokens, t || list_transform(range(512 - len(t)), lambda i: 4) AS p,
             list_transform(range(512), lambda i: CASE WHEN i < len(t) THEN 1 ELSE 0 END) AS m FROM t)"""


@register("q12_pretrain_sequences", PRETRAIN_SQL + f"""
SELECT doc_id, chunk_idx, n_tokens::BIGINT AS n_tokens, {sql_text('p[1:511]')} AS x,
       {sql_text('p[2:512]')} AS y, {sql_text('m[2:512]')} AS loss_mask FROM p""")
def q12_pretrain_sequences(spark, sf):
    s = pretrain_sequences(_chunks(spark, sf).select("doc_id", "chunk_idx", "text"))
    return s.select("doc_id", "chunk_idx", F.col("n_tokens").cast("long").alias("n_tokens"),
                    ids_text(F.col("x")).alias("x"), ids_text(F.col("y")).alias("y"),
                    ids_text(F.col("loss_mask")).alias("loss_mask"))


# ---------------------------------------------------------------- A3
@register("a3_mask_accounting", f"""
WITH c AS ({CHUNKS_SQL}), s AS (SELECT lang, 1 + octet_length(encode(text)) AS n FROM c)
SELECT lang, count(*)::BIGINT AS n_seq, (count(*) * 511)::BIGINT AS n_positions,
       sum(least(n, 512) - 1)::BIGINT AS loss_positions,
       (count(*) * 511 - sum(least(n, 512) - 1))::BIGINT AS pad_positions,
       count_if(n > 512)::BIGINT AS truncated,
       round(sum(least(n, 512) - 1) / (count(*) * 511.0), 6) AS loss_share
FROM s GROUP BY lang""")
def a3_mask_accounting(spark, sf):
    return mask_accounting(pretrain_sequences(_chunks(spark, sf).select("lang", "text")), ["lang"])


# ---------------------------------------------------------------- Q13
SFT_SQL = f"""
WITH t AS (SELECT conv_id, turn, text,
                  CASE WHEN role = 'user' THEN 'user' WHEN role = 'assistant' THEN 'assistant' END AS r
           FROM conversations),
e AS (SELECT conv_id, turn, [3] || {sql_bytes("r || chr(10) || text")} || [4] || {sql_bytes('chr(10)')} AS ids
      FROM t WHERE r IS NOT NULL),
s AS (SELECT c.conv_id, [3] || {sql_bytes("'system' || chr(10) || '你是一个AI助手'")} || [4] || {sql_bytes('chr(10)')}
             || coalesce(flatten(list(e.ids ORDER BY e.turn) FILTER (WHERE e.ids IS NOT NULL)), []) AS ids
      FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN e ON c.conv_id = e.conv_id
      GROUP BY c.conv_id),
p AS (SELECT conv_id, len(ids) AS n_tokens, ids[1:512] || list_transform(range(512 - len(ids[1:512])), lambda i: 4) AS p
      FROM s),
u AS (SELECT conv_id, unnest(p) AS id, unnest(range(512)) AS pos FROM p),
h AS (SELECT conv_id, pos, id,
             list(id) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 10 FOLLOWING) AS w
      FROM u),
k AS (SELECT conv_id, pos, id,
             max(CASE WHEN pos < 512 - 11 AND w = [3] || {sql_bytes("'assistant' || chr(10)")} THEN pos + 11 END)
                 OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 11 PRECEDING) AS hh,
             max(CASE WHEN id = 4 THEN pos END)
                 OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ee,
             max(CASE WHEN id = 4 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nn
      FROM h),
m AS (SELECT conv_id, string_agg(CASE WHEN hh IS NOT NULL AND hh > coalesce(ee, -1) AND nn = 1 THEN '1' ELSE '0' END,
                                 ',' ORDER BY pos) FILTER (WHERE pos >= 1) AS loss_mask
      FROM k GROUP BY conv_id)"""


@register("q13_sft_sequences", SFT_SQL + f"""
SELECT p.conv_id, n_tokens::BIGINT AS n_tokens, {sql_text('p[1:511]')} AS x, {sql_text('p[2:512]')} AS y, m.loss_mask
FROM p JOIN m ON p.conv_id = m.conv_id""")
def q13_sft_sequences(spark, sf):
    s = sft_sequences(table(spark, sf, "conversations"))
    return s.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"), ids_text(F.col("x")).alias("x"),
                    ids_text(F.col("y")).alias("y"), ids_text(F.col("loss_mask")).alias("loss_mask"))


# ---------------------------------------------------------------- Q14
NL = sql_bytes("chr(10)")
TURN_SQL = f"""
WITH t AS (SELECT conv_id, turn, text,
                  CASE WHEN role = 'user' THEN 'human'
                       WHEN role = 'assistant' THEN CASE WHEN conv_id % 2 = 1 THEN 'gpt' ELSE 'assistant' END
                       ELSE role END AS frm
           FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
             first_value(frm) OVER (PARTITION BY conv_id ORDER BY turn) AS ff FROM t),
k AS (SELECT conv_id, turn, CASE WHEN frm = 'assistant' THEN 'assistant' ELSE 'human' END AS role,
             {sql_bytes('text')} AS v
      FROM f WHERE NOT (rn = 1 AND ff <> 'human')),
q AS (SELECT conv_id, turn, [3] || {sql_bytes('role')} || {NL} || v || [4] || {NL} AS ids,
             CASE WHEN role = 'assistant'
                  THEN [3] || list_transform(range(1 + octet_length(encode(role))), lambda i: -100) || v || [4] || {NL}
                  ELSE [3] || list_transform(range(octet_length(encode(role)) + len(v) + 1), lambda i: -100) || [4] || {NL}
             END AS labels
      FROM k),
sy AS (SELECT [3] || {sql_bytes("'system'")} || {NL} || {sql_bytes("'You are a helpful assistant.'")} || [4] || {NL} AS ids),
s AS (SELECT c.conv_id,
             (SELECT ids FROM sy) || coalesce(flatten(list(q.ids ORDER BY q.turn) FILTER (WHERE q.ids IS NOT NULL)), []) AS ids,
             [3] || list_transform(range(len((SELECT ids FROM sy)) - 3), lambda i: -100) || [4] || {NL}
                 || coalesce(flatten(list(q.labels ORDER BY q.turn) FILTER (WHERE q.ids IS NOT NULL)), []) AS labels
      FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN q ON c.conv_id = q.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, ids[1:2048] || list_transform(range(2048 - len(ids[1:2048])), lambda i: 4) AS input_ids,
             labels[1:2048] || list_transform(range(2048 - len(labels[1:2048])), lambda i: -100) AS labels FROM s)"""


@register("q14_turn_label_sequences", TURN_SQL + f"""
SELECT conv_id, {sql_text('input_ids')} AS input_ids, {sql_text('labels')} AS labels,
       {sql_text('list_transform(input_ids, lambda x: CASE WHEN x <> 4 THEN 1 ELSE 0 END)')} AS attention_mask FROM p""")
def q14_turn_label_sequences(spark, sf):
    s = turn_label_sequences(table(spark, sf, "conversations"))
    return s.select("conv_id", ids_text(F.col("input_ids")).alias("input_ids"), ids_text(F.col("labels")).alias("labels"),
                    ids_text(F.col("attention_mask").cast("array<int>")).alias("attention_mask"))


# ---------------------------------------------------------------- S5, S8, S9
@register("s5_head_records", """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS idx FROM documents
QUALIFY idx < 100""")
def s5_head_records(spark, sf):
    from quarry.operators.index import head_records
    return head_records(_docs(spark, sf).select("doc_id"), ["doc_id"], 100) \
        .withColumn("idx", F.col("idx").cast("long"))


@register("s8_row_index", """
SELECT doc_id, chunk_idx, (row_number() OVER (ORDER BY source, doc_id, chunk_idx) - 1)::BIGINT AS idx
FROM ({chunks})""".format(chunks=CHUNKS_SQL))
def s8_row_index(spark, sf):
    from quarry.operators.index import with_row_index
    return with_row_index(_chunks(spark, sf).select("doc_id", "chunk_idx", "source"),
                          ["source", "doc_id", "chunk_idx"]).select("doc_id", "chunk_idx", "idx")


@register("s9_record_offsets", """
SELECT doc_id, chunk_idx,
       coalesce(sum(octet_length(encode(text)) + 1) OVER (ORDER BY doc_id, chunk_idx
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS byte_start,
       sum(octet_length(encode(text)) + 1) OVER (ORDER BY doc_id, chunk_idx
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS byte_end
FROM ({chunks})""".format(chunks=CHUNKS_SQL))
def s9_record_offsets(spark, sf):
    from quarry.operators.index import record_offsets
    return record_offsets(_chunks(spark, sf).select("doc_id", "chunk_idx", F.col("text").alias("line")),
                          ["doc_id", "chunk_idx"]).select("doc_id", "chunk_idx", "byte_start", "byte_end")


# ---------------------------------------------------------------- Q8 + Q9 (+ U2 with one shard)
@register("q8_pack_blocks", f"""
WITH c AS ({CHUNKS_SQL}),
i AS (SELECT row_number() OVER (ORDER BY doc_id, chunk_idx) - 1 AS idx, {sql_bytes('text')} AS ids FROM c),
u AS (SELECT idx // 1000 AS batch, idx, unnest(ids) AS id, unnest(range(len(ids))) AS k FROM i),
g AS (SELECT batch, id, row_number() OVER (PARTITION BY batch ORDER BY idx, k) - 1 AS pos,
             count(*) OVER (PARTITION BY batch) AS total FROM u)
SELECT 0::BIGINT AS shard, batch::BIGINT AS batch, (pos // 2048)::BIGINT AS block,
       string_agg(id::VARCHAR, ',' ORDER BY pos) AS input_ids, string_agg(id::VARCHAR, ',' ORDER BY pos) AS labels,
       count(*)::BIGINT AS attention_sum
FROM g WHERE total < 2048 OR pos < (total // 2048) * 2048
GROUP BY batch, pos // 2048""")
def q8_pack_blocks(spark, sf):
    from quarry.functions.encode import encode
    from quarry.operators.sequences import pack_blocks
    c = _chunks(spark, sf).select("doc_id", "chunk_idx", encode(F.col("text")).alias("input_ids"))
    p = pack_blocks(c, ["doc_id", "chunk_idx"], ["input_ids"], ones=["attention_mask"])
    return p.select("shard", "batch", "block", ids_text(F.col("input_ids")).alias("input_ids"),
                    ids_text(F.col("labels")).alias("labels"),
                    F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("attention_sum"))


# ---------------------------------------------------------------- B1-B4, B7, B9
KEYED_SQL = f"""SELECT doc_id, chunk_idx, doc_id || ':' || chunk_idx AS key, text FROM ({CHUNKS_SQL})"""
SHUFFLED_SQL = f"""
WITH k AS ({KEYED_SQL}), e AS (SELECT *, unnest(range(2)) AS epoch FROM k),
s AS (SELECT doc_id, chunk_idx, key, text, epoch,
             row_number() OVER (PARTITION BY epoch ORDER BY md5(key || ':' || epoch || ':' || '42'), key) - 1 AS pos
      FROM e)"""


def _keyed(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_idx", "text",
                                     F.concat_ws(":", "doc_id", "chunk_idx").alias("key"))


@register("b1_seeded_shuffle", SHUFFLED_SQL + """
SELECT doc_id, chunk_idx, epoch::INTEGER AS epoch, pos::BIGINT AS pos FROM s""")
def b1_seeded_shuffle(spark, sf):
    from quarry.operators.batching import replicate_epochs, seeded_shuffle
    s = seeded_shuffle(replicate_epochs(_keyed(spark, sf).drop("text"), 2), "key")
    return s.select("doc_id", "chunk_idx", "epoch", F.col("pos").cast("long").alias("pos"))


@register("b4_device_shards", SHUFFLED_SQL + """,
n AS (SELECT count(*) AS n, ceil(count(*) / 64.0) AS steps FROM k),
b AS (SELECT doc_id, chunk_idx, pos // 64 AS step, pos % 64 AS slot FROM s WHERE epoch = 0)
SELECT doc_id, chunk_idx, step::BIGINT AS step, slot::BIGINT AS slot,
       floor(slot / ceil((CASE WHEN step = steps - 1 THEN n - (steps - 1) * 64 ELSE 64 END) / 3.0))::BIGINT AS device
FROM b, n""")
def b4_device_shards(spark, sf):
    from quarry.plans.training import plan_rows
    rows, _ = plan_rows(_keyed(spark, sf).drop("text"), "key", epochs=1, batch_size=64, devices=3)
    return rows.select("doc_id", "chunk_idx", "step", "slot", "device")


@register("b4_device_files", ORACLE["b4_device_shards"])
def b4_device_files(spark, sf):
    """The shards as written, one directory a device, each read on its own."""
    from quarry.operators.batching import write_shards
    from quarry.plans.training import plan_rows
    rows, _ = plan_rows(_keyed(spark, sf).drop("text"), "key", epochs=1, batch_size=64, devices=3)
    path = _folder(spark, "b4")
    write_shards(rows.select("doc_id", "chunk_idx", "step", "slot", "device"), path)
    parts = [spark.read.parquet(f"{path}/device={d}").withColumn("device", F.lit(d).cast("long")) for d in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("b3_collate", SHUFFLED_SQL + """
SELECT (pos // 64)::BIGINT AS step, count(*)::BIGINT AS n_rows, string_agg(key, ' ' ORDER BY pos % 64) AS keys
FROM s WHERE epoch = 0 GROUP BY pos // 64""")
def b3_collate(spark, sf):
    from quarry.operators.batching import collate
    from quarry.plans.training import plan_rows
    rows, _ = plan_rows(_keyed(spark, sf).drop("text"), "key", epochs=1, batch_size=64)
    c = collate(rows, ["key"])
    return c.select("step", F.size("key").cast("long").alias("n_rows"), F.array_join("key", " ").alias("keys"))


@register("b7_lr_schedule", f"""
WITH n AS (SELECT ceil(count(*) / 64.0)::BIGINT AS total FROM ({CHUNKS_SQL})),
g AS (SELECT unnest(range(total + 3)) AS it, total FROM n)
SELECT it::BIGINT AS it, round(CASE WHEN it < 10 THEN 2e-4 * it / 10
                          WHEN it > total THEN 2e-5
                          ELSE 2e-5 + 0.5 * (1.0 + cos(pi() * ((it - 10) / (total - 10)))) * (2e-4 - 2e-5) END, 12) AS lr
FROM g""")
def b7_lr_schedule(spark, sf):
    from quarry.functions.schedule import lr_at
    total = _chunks(spark, sf).agg(F.ceil(F.count("*") / 64).alias("total"))
    its = total.select("total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") + 2)).alias("it"))
    return its.select("it", F.round(lr_at(F.col("it"), F.col("total"), 2e-4, 10), 12).alias("lr"))


@register("b9_training_plan", SHUFFLED_SQL + """,
n AS (SELECT ceil(count(*) / 64.0)::BIGINT AS steps FROM k),
r AS (SELECT epoch, pos // 64 AS step, least(1 + octet_length(encode(text)), 512) - 1 AS lt FROM s),
p AS (SELECT epoch, step, count(*) AS n_rows, sum(lt) AS loss_tokens FROM r GROUP BY epoch, step)
SELECT epoch::INTEGER AS epoch, step::BIGINT AS step, (epoch * steps + step)::BIGINT AS global_step,
       n_rows::BIGINT AS n_rows, loss_tokens::BIGINT AS loss_tokens,
       round(CASE WHEN epoch * steps + step > 2 * steps THEN 2e-5
                  ELSE 2e-5 + 0.5 * (1.0 + cos(pi() * ((epoch * steps + step) / (2.0 * steps)))) * (2e-4 - 2e-5) END, 12) AS lr,
       (step + 1) % 8 = 0 AS is_update, (step // 8)::BIGINT AS update_group,
       step % 100 = 0 AS is_log, (step + 1) % 1000 = 0 AS is_save, (step + 1) % 20000 = 0 AS is_snapshot
FROM p, n""")
def b9_training_plan(spark, sf):
    from quarry.plans.training import training_plan
    seqs = pretrain_sequences(_keyed(spark, sf).select("key", "text"))
    return training_plan(seqs, "key", epochs=2, batch_size=64)


# ---------------------------------------------------------------- B10
@register("b10_eta", """
WITH s AS (SELECT user_id, event_id, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
                  count(*) OVER (PARTITION BY user_id) AS steps, min(ts) OVER (PARTITION BY user_id) AS t0
           FROM events),
e AS (SELECT *, (epoch_us(ts) - epoch_us(t0)) / 1e6 AS el FROM s)
SELECT user_id, event_id, step::BIGINT AS step, steps::BIGINT AS steps, round(el, 6) AS elapsed_s,
       (floor(el / (step + 1) * steps / 60) - floor(el / 60))::BIGINT AS eta_min
FROM e""")
def b10_eta(spark, sf):
    from quarry.operators.batching import eta_minutes
    return eta_minutes(table(spark, sf, "events"))


# ---------------------------------------------------------------- A4 (+A1, A2), A5, G1-G4
POSITIONS_SQL = PRETRAIN_SQL + """,
z AS (SELECT lang, unnest(p[1:511]) AS x, unnest(p[2:512]) AS y, unnest(m[2:512]) AS m FROM p),
bg AS (SELECT x, y, count(*) AS n FROM z WHERE m = 1 GROUP BY x, y),
cx AS (SELECT x, sum(n) AS cx FROM bg GROUP BY x)"""


def _pretrain_lang(spark, sf):
    return pretrain_sequences(_chunks(spark, sf).select("lang", "text"))


@register("a4_ngram_nll", POSITIONS_SQL + """,
s AS (SELECT z.lang, z.m, CASE WHEN z.y = 0 THEN 0.0
             ELSE -ln((coalesce(bg.n, 0) + 1) / (coalesce(cx.cx, 0) + 261.0)) END AS nll
      FROM z LEFT JOIN bg ON z.x = bg.x AND z.y = bg.y LEFT JOIN cx ON z.x = cx.x)
SELECT lang, sum(m)::BIGINT AS loss_tokens, round(sum(nll * m) / sum(m), 6) AS mean_nll,
       round(exp(sum(nll * m) / sum(m)), 6) AS perplexity
FROM s GROUP BY lang""")
def a4_ngram_nll(spark, sf):
    from quarry.operators.scoring import ngram_nll
    return ngram_nll(_pretrain_lang(spark, sf), ["lang"], vocab_size=261)


NEXT_SQL = POSITIONS_SQL + """,
nt AS (SELECT x AS ctx, y AS token, n, ln(n) AS logit FROM bg)"""


@register("a5_next_token_table", NEXT_SQL + """
SELECT ctx, token, n::BIGINT AS n, round(logit, 6) AS logit FROM nt""")
def a5_next_token_table(spark, sf):
    from quarry.operators.scoring import next_token_table
    t = next_token_table(_pretrain_lang(spark, sf))
    return t.select("ctx", "token", "n", F.round("logit", 6).alias("logit"))


@register("g1_greedy", NEXT_SQL + """
SELECT ctx, token FROM (SELECT ctx, token, row_number() OVER (PARTITION BY ctx ORDER BY logit DESC, token) AS r FROM nt)
WHERE r = 1""")
def g1_greedy(spark, sf):
    from quarry.operators.sampling import greedy
    from quarry.operators.scoring import next_token_table
    return greedy(next_token_table(_pretrain_lang(spark, sf)))


@register("g2_top_k", NEXT_SQL + """
SELECT ctx, token, n::BIGINT AS n FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY logit DESC) AS r FROM nt)
WHERE r <= 3""")
def g2_top_k(spark, sf):
    from quarry.operators.sampling import top_k_with_ties
    from quarry.operators.scoring import next_token_table
    return top_k_with_ties(next_token_table(_pretrain_lang(spark, sf)), 3).select("ctx", "token", "n")


SOFT_SQL = NEXT_SQL + """,
tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY logit DESC) AS r FROM nt) WHERE r <= 5),
sm AS (SELECT ctx, token, exp((logit - max(logit) OVER (PARTITION BY ctx)) / 0.8) AS z FROM tk),
pr AS (SELECT ctx, token, z / sum(z) OVER (PARTITION BY ctx) AS p FROM sm)"""


def _softmax(spark, sf):
    from quarry.operators.sampling import temperature_softmax, top_k_with_ties
    from quarry.operators.scoring import next_token_table
    return temperature_softmax(top_k_with_ties(next_token_table(_pretrain_lang(spark, sf)), 5), 0.8)


@register("g3_temperature_softmax", SOFT_SQL + """
SELECT ctx, token, round(p, 6) AS p FROM pr""")
def g3_temperature_softmax(spark, sf):
    return _softmax(spark, sf).select("ctx", "token", F.round("p", 6).alias("p"))


@register("g4_seeded_draw", SOFT_SQL + """,
cu AS (SELECT ctx, token, sum(p) OVER (PARTITION BY ctx ORDER BY token ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
              ('0x' || substr(md5(ctx::VARCHAR || ':42'), 1, 8))::BIGINT / 4294967296.0 AS u FROM pr)
SELECT ctx, coalesce(min(token) FILTER (WHERE c >= u), max(token)) AS token FROM cu GROUP BY ctx""")
def g4_seeded_draw(spark, sf):
    from quarry.operators.sampling import seeded_draw
    return seeded_draw(_softmax(spark, sf))


# ---------------------------------------------------------------- K4-K7 (byte-level model), K1
@register("k4_encode", f"""
WITH c AS ({CHUNKS_SQL}), e AS (SELECT doc_id, chunk_idx, {sql_bytes('text')} AS ids FROM c)
SELECT doc_id, chunk_idx, {sql_text('ids')} AS input_ids, len(ids)::BIGINT AS attention_sum FROM e""")
def k4_encode(spark, sf):
    from quarry.operators.tokenizer import encode_table
    e = encode_table(_chunks(spark, sf).select("doc_id", "chunk_idx", "text"), with_attention=True)
    return e.select("doc_id", "chunk_idx", ids_text(F.col("input_ids")).alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("attention_sum"))


@register("k5_decode", f"SELECT doc_id, chunk_idx, text AS decoded FROM ({CHUNKS_SQL})")
def k5_decode(spark, sf):
    from quarry.operators.tokenizer import decode_table, encode_table
    e = encode_table(_chunks(spark, sf).select("doc_id", "chunk_idx", "text"))
    return decode_table(e, ids_col="input_ids").select("doc_id", "chunk_idx", "decoded")


@register("k6_roundtrip_report", """
SELECT lang, count(*)::BIGINT AS n_rows, count_if(octet_length(encode(text)) <= 256)::BIGINT AS n_equal,
       round(avg((octet_length(encode(text)) <= 256)::INTEGER), 6) AS equal_rate
FROM documents GROUP BY lang""")
def k6_roundtrip_report(spark, sf):
    """With ids cut at 256 (often inside a character), a text comes back whole only if it is short enough."""
    from quarry.operators.tokenizer import roundtrip_report
    return roundtrip_report(_docs(spark, sf), ["lang"], max_length=256)


@register("k7_tokenizer_stats", """
SELECT lang, count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS n_chars,
       sum(octet_length(encode(text)))::BIGINT AS n_tokens,
       round(sum(octet_length(encode(text))) / sum(length(text)), 6) AS tokens_per_char, 261 AS vocab_size,
       0 AS unk_id, 3 AS bos_id, 4 AS eos_id, 4 AS pad_id
FROM documents GROUP BY lang""")
def k7_tokenizer_stats(spark, sf):
    from quarry.operators.tokenizer import tokenizer_stats
    return tokenizer_stats(_docs(spark, sf), ["lang"])


# DuckDB has no lookahead: the last blank of a run before a word is marked, so that a run stops short of it
_PRETOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d|\x01? ?\pL+|\x01? ?\pN+|\x01? ?[^\s\pL\pN\x01]+|\x01?\s+").replace("'", "''")
PRETOKENS_SQL = rf"""SELECT doc_id, replace(w, chr(1), '') AS word
FROM (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '(\s)(\S)', chr(1) || '\1\2', 'g'), '{_PRETOKENS}')) AS w
      FROM documents)"""
WORDS_SQL = f"SELECT word, count(*)::BIGINT AS freq FROM ({PRETOKENS_SQL}) GROUP BY word"


@register("k1_pretoken_counts", WORDS_SQL)
def k1_pretoken_counts(spark, sf):
    from quarry.operators.tokenizer import pretoken_counts
    return pretoken_counts(_docs(spark, sf))


MERGES = 39  # merges of the trained queries: a vocabulary of 300


def bpe_sql(merges: int) -> str:
    """Byte-pair training as one materialised step per merge: p<i> is the merge, s<i> the words after it."""
    steps = [f"""w AS MATERIALIZED ({WORDS_SQL}),
s0 AS MATERIALIZED (SELECT word, freq, array_to_string(list_transform({sql_bytes('word')}, lambda i: chr(57344 + i)), '') AS s FROM w)"""]
    for i in range(1, merges + 1):
        steps.append(f"""p{i} AS MATERIALIZED (SELECT substr(s, k, 2) AS pr FROM (SELECT s, freq, unnest(range(1, length(s))) AS k FROM s{i - 1})
  GROUP BY pr ORDER BY sum(freq) DESC, pr LIMIT 1),
s{i} AS MATERIALIZED (SELECT word, freq, replace(s, (SELECT pr FROM p{i}), chr({57344 + 260 + i})) AS s FROM s{i - 1})""")
    return "WITH " + ",\n".join(steps)


@register("k3_train_bpe", bpe_sql(MERGES) + "\n" + "\nUNION ALL ".join(
    f"SELECT {i - 1}::INTEGER AS rank, (unicode(substr(pr, 1, 1)) - 57344)::INTEGER AS left_id, "
    f"(unicode(substr(pr, 2, 1)) - 57344)::INTEGER AS right_id, {260 + i}::INTEGER AS new_id FROM p{i}"
    for i in range(1, MERGES + 1)))
def k3_train_bpe(spark, sf):
    from quarry.operators.tokenizer import merges_table, train_bpe
    return merges_table(spark, train_bpe(_docs(spark, sf).select("text"), vocab_size=261 + MERGES))


@register("k4_k5_trained_words", bpe_sql(MERGES) + f"""
SELECT word, array_to_string(list_transform(string_split(s, ''), lambda c: unicode(c) - 57344), ',') AS ids,
       word AS decoded FROM s{MERGES}""")
def k4_k5_trained_words(spark, sf):
    """Every distinct pre-token encoded with a trained vocabulary, and decoded again."""
    from quarry.operators.tokenizer import decode_table, encode_table, pretoken_counts, train_bpe
    model = train_bpe(_docs(spark, sf).select("text"), vocab_size=261 + MERGES)
    e = encode_table(pretoken_counts(_docs(spark, sf)).select("word"), model, text_col="word")
    d = decode_table(e, model, ids_col="input_ids")
    return d.select("word", ids_text(F.col("input_ids")).alias("ids"), "decoded")


@register("k4_dictionary_encode", bpe_sql(MERGES) + f""",
d AS (SELECT doc_id, list_transform(regexp_extract_all(regexp_replace(text, '(\\s)(\\S)', chr(1) || '\\1\\2', 'g'),
                                    '{_PRETOKENS}'), lambda x: replace(x, chr(1), '')) AS words FROM documents),
o AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS k FROM d)
SELECT doc_id, string_agg(array_to_string(list_transform(string_split(s, ''), lambda c: unicode(c) - 57344), ','), ',' ORDER BY k)
       AS input_ids FROM o JOIN s{MERGES} USING (word) GROUP BY doc_id""")
def k4_dictionary_encode(spark, sf):
    """Every whole text encoded with a trained vocabulary through one dictionary of all pre-tokens."""
    from quarry.operators.tokenizer import encode_with_dictionary, train_bpe
    docs = _docs(spark, sf).select("doc_id", "text")
    model = train_bpe(docs.select("text"), vocab_size=261 + MERGES)
    out = encode_with_dictionary(docs.where(F.length("text") > 0), model)
    return out.select("doc_id", ids_text(F.col("input_ids")).alias("input_ids"))


# ---------------------------------------------------------------- C1-C6, C8 standalone
@register("c6_render_chat", """
WITH t AS (SELECT conv_id, turn, text,
                  CASE WHEN role = 'user' THEN 'user' WHEN role = 'assistant' THEN 'assistant' END AS r
           FROM conversations)
SELECT conv_id, '<|im_start|>system' || chr(10) || '你是一个AI助手<|im_end|>' || chr(10)
       || coalesce(string_agg('<|im_start|>' || r || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)
                   FILTER (WHERE r IS NOT NULL), '') AS text,
       (count(r) + 1)::BIGINT AS n_messages
FROM t GROUP BY conv_id""")
def c6_render_chat(spark, sf):
    from quarry.functions.chat import prepend_system, render_chat
    from quarry.plans.sft import assemble_messages
    from quarry.sources.tables import raw_turns
    m = assemble_messages(raw_turns(table(spark, sf, "conversations")))
    msgs = prepend_system(F.col("messages"))
    return m.select("conv_id", render_chat(msgs).alias("text"), F.size(msgs).cast("long").alias("n_messages"))


@register("c4_c5_turn_roles", """
WITH t AS (SELECT conv_id, turn,
                  CASE WHEN role = 'user' THEN 'human'
                       WHEN role = 'assistant' THEN CASE WHEN conv_id % 2 = 1 THEN 'gpt' ELSE 'assistant' END
                       ELSE role END AS frm FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
             first_value(frm) OVER (PARTITION BY conv_id ORDER BY turn) AS ff FROM t)
SELECT conv_id, turn, frm AS raw_from, CASE WHEN frm = 'assistant' THEN 'assistant' ELSE 'human' END AS role
FROM f WHERE NOT (rn = 1 AND ff <> 'human')""")
def c4_c5_turn_roles(spark, sf):
    from quarry.functions.chat import turn_role
    from quarry.operators.conversations import drop_leading_non_human_rows
    from quarry.sources.tables import raw_turns
    kept = drop_leading_non_human_rows(raw_turns(table(spark, sf, "conversations")))
    return kept.select("conv_id", "turn", F.col("from").alias("raw_from"), turn_role(F.col("from")).alias("role"))


# ---------------------------------------------------------------- Q10, Q11
@register("q10_q11_crop_and_stop", f"""
WITH c AS ({CHUNKS_SQL}), e AS (SELECT doc_id, chunk_idx, {sql_bytes('text')} AS ids FROM c),
s AS (SELECT doc_id, chunk_idx, ids, CASE WHEN len(ids) > 512 THEN ids[len(ids) - 511:] ELSE ids END AS crop,
             list_position(ids, {46 - 28}) AS sp FROM e)
SELECT doc_id, chunk_idx, {sql_text('crop')} AS cropped,
       {sql_text("ids[1:least(coalesce(sp - 1, len(ids)), 256)]")} AS generated FROM s""")
def q10_q11_crop_and_stop(spark, sf):
    from quarry.functions.arrays import cut_at_stop, left_crop
    from quarry.functions.bytes import byte_ids
    from quarry.functions.literal import encode_literal
    stop = encode_literal(".")[0]
    e = _chunks(spark, sf).select("doc_id", "chunk_idx", byte_ids(F.col("text")).alias("ids"))
    return e.select("doc_id", "chunk_idx", ids_text(left_crop(F.col("ids"), 512)).alias("cropped"),
                    ids_text(cut_at_stop(F.col("ids"), stop, 256)).alias("generated"))


# ---------------------------------------------------------------- S1, S2, S3, S6 (lines derived from the tables)
@register("s1_read_jsonl", "SELECT doc_id, text FROM documents")
def s1_read_jsonl(spark, sf):
    from quarry.sources.jsonl import parse_jsonl
    line = F.to_json(F.struct("text"))  # S6 serialisation
    junk = F.explode(F.array(line, *[F.concat(line, F.lit(tail)) for tail in ("] }", '],[{"x":1}', "] junk}", ',"y":1}')],
                             F.concat(F.lit("["), line, F.lit("]"))))
    return parse_jsonl(_docs(spark, sf).select("doc_id", junk.alias("value")), keep=["doc_id"])


@register("s2_reject_report", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id)::BIGINT AS line_num,
       CASE WHEN doc_id % 3 = 1 THEN 'missing_key' WHEN doc_id % 3 = 2 THEN 'malformed' END AS reason,
       CASE WHEN doc_id % 3 = 0 THEN text END AS text
FROM documents""")
def s2_reject_report(spark, sf):
    """Lines: every document as {"text":...}, every third one without the key, every
    third one cut short or with a tail (not valid JSON); line numbers in doc_id order."""
    from quarry.operators.index import with_row_index
    from quarry.sources.jsonl import split_report
    docs = _docs(spark, sf)
    full = F.to_json(F.struct("text"))
    value = (F.when(F.col("doc_id") % 3 == 1, F.to_json(F.struct(F.col("lang").alias("x"))))
             .when(F.col("doc_id") % 6 == 2, F.concat(full, F.lit('],[{"x":1}')))
             .when(F.col("doc_id") % 6 == 5, F.expr("substring(to_json(struct(text)), 1, 5)"))
             .otherwise(full))
    lines = with_row_index(docs.select("doc_id", value.alias("value")), ["doc_id"], "line_num") \
        .withColumn("line_num", F.col("line_num") + 1)
    rows, rejects = split_report(lines)
    return rows.select("doc_id", "line_num", F.lit(None).cast("string").alias("reason"), "text") \
        .unionByName(rejects.select("doc_id", "line_num", "reason", F.lit(None).cast("string").alias("text")))


@register("s3_json_array_lines", """
SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(text, '' ORDER BY turn) AS joined FROM conversations
GROUP BY conv_id""")
def s3_json_array_lines(spark, sf):
    """A JSON array file, one conversation object per line with a trailing comma,
    between '[' and ']' lines, parsed back with S3."""
    from quarry.sources.jsonl import parse_json_array_lines
    from quarry.sources.tables import raw_turns
    t = raw_turns(table(spark, sf, "conversations"))
    conv = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "from", "value"))).alias("c"))
    obj = F.to_json(F.struct("conv_id", F.transform("c", lambda x: F.struct(x["from"].alias("from"),
                                                                            x["value"].alias("value")))
                             .alias("conversations")))
    lines = conv.select(F.concat(F.lit("  "), obj, F.lit(",")).alias("value")) \
        .unionByName(spark.range(1).select(F.explode(F.array(
            F.lit("["), F.lit('{"conv_id":-1,"conversations":[]},'), F.lit('{"conv_id":-2},'))).alias("value"))) \
        .unionByName(spark.range(1).select(F.lit("]").alias("value")))
    parsed = parse_json_array_lines(lines, keep_fields={"conv_id": "bigint"})
    return parsed.select("conv_id", F.size("conversations").cast("long").alias("n_turns"),
                         F.array_join(F.transform("conversations", lambda x: x["value"]), "").alias("joined"))


# ---------------------------------------------------------------- U1 (+U2 with two shards)
@register("u1_map_batches", f"""
WITH c AS ({CHUNKS_SQL}), i AS (SELECT doc_id, chunk_idx, length(text) AS n,
                                       row_number() OVER (ORDER BY doc_id, chunk_idx) - 1 AS idx,
                                       count(*) OVER () AS total FROM c),
s AS (SELECT *, total // 2 + total % 2 AS first_size FROM i),
b AS (SELECT doc_id, chunk_idx, n, CASE WHEN idx < first_size THEN 0 ELSE 1 END AS shard,
             CASE WHEN idx < first_size THEN idx ELSE idx - first_size END AS local FROM s)
SELECT doc_id, chunk_idx, n::BIGINT AS n_chars, shard::BIGINT AS shard, (local // 1000)::BIGINT AS batch,
       sum(n) OVER (PARTITION BY shard, local // 1000)::BIGINT AS batch_chars FROM b""")
def u1_map_batches(spark, sf):
    from quarry.operators.batchfn import map_batches

    def fn(batch: dict) -> dict:  # a user batch function: per-row and per-batch values
        n = [len(t) for t in batch["text"]]
        return {"n_chars": n, "batch_chars": [sum(n)] * len(n), "shard": batch["_shard"], "batch": batch["_batch"]}

    c = _chunks(spark, sf).select("doc_id", "chunk_idx", "text")
    out = map_batches(c, fn, "n_chars long, batch_chars long, shard long, batch long",
                      ["doc_id", "chunk_idx"], batch_size=1000, num_proc=2, remove_columns=["text"])
    return out.select("doc_id", "chunk_idx", "n_chars", "shard", "batch", "batch_chars")


# ---------------------------------------------------------------- K2 on a plain space split, A1 per document
@register("k2_pair_counts", f"""
WITH w AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents),
f AS (SELECT word, count(*) AS freq FROM w WHERE word <> '' GROUP BY word),
b AS (SELECT freq, {sql_bytes('word')} AS ids FROM f),
p AS (SELECT freq, unnest(list_transform(range(len(ids) - 1), lambda i: ids[i + 1] * 100000 + ids[i + 2])) AS pr
      FROM b WHERE len(ids) > 1)
SELECT (pr // 100000)::INTEGER AS left_id, (pr % 100000)::INTEGER AS right_id, sum(freq)::BIGINT AS cnt
FROM p GROUP BY pr""")
def k2_pair_counts(spark, sf):
    from quarry.operators.tokenizer import pair_counts, word_symbols
    words = _docs(spark, sf).select(F.explode(F.split("text", " ")).alias("word")).where(F.col("word") != "") \
        .groupBy("word").agg(F.count("*").alias("freq"))
    pc = pair_counts(word_symbols(words))
    cp = lambda i: F.ascii(F.substring("pair", i, 1)) - 0xE000  # noqa: E731  (symbol chars are U+E000 + id)
    return pc.select(cp(1).cast("int").alias("left_id"), cp(2).cast("int").alias("right_id"), "cnt")


@register("a1_masked_mean_by_doc", POSITIONS_SQL + """,
s AS (SELECT z.doc_id, z.m, CASE WHEN z.y = 0 THEN 0.0
             ELSE -ln((coalesce(bg.n, 0) + 1) / (coalesce(cx.cx, 0) + 261.0)) END AS nll
      FROM (SELECT doc_id, unnest(p[1:511]) AS x, unnest(p[2:512]) AS y, unnest(m[2:512]) AS m FROM p) z
      LEFT JOIN bg ON z.x = bg.x AND z.y = bg.y LEFT JOIN cx ON z.x = cx.x)
SELECT doc_id, sum(m)::BIGINT AS loss_tokens, round(sum(nll * m) / sum(m), 6) AS mean_nll,
       round(exp(sum(nll * m) / sum(m)), 6) AS perplexity
FROM s GROUP BY doc_id""")
def a1_masked_mean_by_doc(spark, sf):
    """A1 per document over the token-level bigram loss (A4 with A2), token-weighted."""
    from quarry.operators.scoring import ngram_nll
    return ngram_nll(pretrain_sequences(_chunks(spark, sf).select("doc_id", "text")), ["doc_id"], vocab_size=261)


# ---------------------------------------------------------------- T3
_ASCII = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,|"
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _ASCII)  # the full-width forms


@register("t3_nfkc", "SELECT doc_id, text, length(text)::BIGINT AS n_chars FROM documents")
def t3_nfkc(spark, sf):
    """NFKC of whole documents, those with an odd id written in full-width letters and signs."""
    from quarry.functions.text import nfkc
    wide = F.when(F.col("doc_id") % 2 == 1, F.translate("text", _ASCII, _WIDE)).otherwise(F.col("text"))
    d = _docs(spark, sf).select("doc_id", nfkc(wide).alias("text"))
    return d.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"))


# ---------------------------------------------------------------- T4, T6
@register("t4_pretokenize", f"""
SELECT doc_id, count(*)::BIGINT AS n_words, max(length(word))::BIGINT AS longest FROM ({PRETOKENS_SQL}) GROUP BY doc_id""")
def t4_pretokenize(spark, sf):
    from quarry.functions.text import pretokenize
    w = _docs(spark, sf).select("doc_id", F.explode(pretokenize(F.col("text"))).alias("w"))
    return w.groupBy("doc_id").agg(F.count("*").alias("n_words"), F.max(F.length("w")).cast("long").alias("longest"))


@register("t6_split_specials", f"""
WITH d AS (SELECT doc_id, lang, text FROM documents)
SELECT doc_id, '<s>' || chr(31) || text || chr(31) || '<|im_end|>' || chr(31) || '<unk>' || chr(31) || lang AS pieces,
       '1,' || {sql_text(sql_bytes('text'))} || ',4,0,' || {sql_text(sql_bytes('lang'))} AS ids
FROM d WHERE length(text) > 0""")
def t6_split_specials(spark, sf):
    """Texts with special strings around and between them, split and encoded."""
    from quarry.functions.encode import encode
    from quarry.functions.text import split_specials
    t = F.concat(F.lit("<s>"), "text", F.lit("<|im_end|><unk>"), "lang")
    d = _docs(spark, sf).where(F.length("text") > 0).select("doc_id", t.alias("t"))
    return d.select("doc_id", F.array_join(split_specials(F.col("t")), "\x1f").alias("pieces"),
                    ids_text(encode(F.col("t"))).alias("ids"))


# ---------------------------------------------------------------- A1, A2
@register("a1_masked_mean", """
SELECT source, round(sum(n_chars * (doc_id % 3)) / sum(doc_id % 3), 6) AS loss FROM documents GROUP BY source""")
def a1_masked_mean(spark, sf):
    from quarry.operators.scoring import masked_mean
    d = _docs(spark, sf).select("source", F.col("n_chars").cast("double").alias("loss"), (F.col("doc_id") % 3).alias("mask"))
    return masked_mean(d, ["source"]).select("source", F.round("loss", 6).alias("loss"))


A2_SQL = PRETRAIN_SQL.replace("[3] || " + sql_bytes("text"), "[3] || (CASE WHEN doc_id % 2 = 0 THEN [0] ELSE [] END) || " + sql_bytes("text"))


@register("a2_ignored_targets", A2_SQL + """,
z AS (SELECT lang, unnest(p[1:511]) AS x, unnest(p[2:512]) AS y, unnest(m[2:512]) AS m FROM p),
bg AS (SELECT x, y, count(*) AS n FROM z WHERE m = 1 GROUP BY x, y),
cx AS (SELECT x, sum(n) AS cx FROM bg GROUP BY x),
s AS (SELECT z.lang, z.m, CASE WHEN z.y = 0 THEN 0.0
             ELSE -ln((coalesce(bg.n, 0) + 1) / (coalesce(cx.cx, 0) + 261.0)) END AS nll
      FROM z LEFT JOIN bg ON z.x = bg.x AND z.y = bg.y LEFT JOIN cx ON z.x = cx.x)
SELECT lang, sum(m)::BIGINT AS loss_tokens, round(sum(nll * m) / sum(m), 6) AS mean_nll,
       round(exp(sum(nll * m) / sum(m)), 6) AS perplexity
FROM s GROUP BY lang""")
def a2_ignored_targets(spark, sf):
    """A4 over chunks of which every second document's start with the ignored token."""
    from quarry.operators.scoring import ngram_nll
    c = _chunks(spark, sf)
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<unk>"), "text")).otherwise(F.col("text"))
    return ngram_nll(pretrain_sequences(c.select("lang", text.alias("text"))), ["lang"], vocab_size=261)


# ---------------------------------------------------------------- B8, B4 on write, S8 lookup, SFT plan
@register("b8_event_flags", f"""
WITH s AS (SELECT row_number() OVER (ORDER BY doc_id, chunk_idx) - 1 AS step FROM ({CHUNKS_SQL}))
SELECT step::BIGINT AS step, step % 7 = 0 AS is_log, (step + 1) % 30 = 0 AS is_save, (step + 1) % 200 = 0 AS is_snapshot
FROM s""")
def b8_event_flags(spark, sf):
    from quarry.functions.schedule import event_flags
    from quarry.operators.index import with_row_index
    s = with_row_index(_chunks(spark, sf).select("doc_id", "chunk_idx"), ["doc_id", "chunk_idx"], "step")
    return s.select("step", *event_flags(F.col("step"), 7, 30, 200))


@register("s8_lookup", f"""
SELECT doc_id, chunk_idx, idx FROM (
  SELECT doc_id, chunk_idx, (row_number() OVER (ORDER BY doc_id, chunk_idx) - 1)::BIGINT AS idx FROM ({CHUNKS_SQL}))
WHERE idx IN (SELECT event_id * 3 FROM events)""")
def s8_lookup(spark, sf):
    """Chunks at the positions that a table names."""
    from quarry.operators.index import rows_at, with_row_index
    idx = with_row_index(_chunks(spark, sf).select("doc_id", "chunk_idx"), ["doc_id", "chunk_idx"])
    return rows_at(idx, table(spark, sf, "events").select(F.col("event_id") * 3)).select("doc_id", "chunk_idx", "idx")


@register("s8_stored_lookup", f"""
SELECT doc_id, chunk_idx, idx FROM (
  SELECT doc_id, chunk_idx, (row_number() OVER (ORDER BY doc_id, chunk_idx) - 1)::BIGINT AS idx FROM ({CHUNKS_SQL}))
WHERE idx IN (SELECT event_id * 3 FROM events WHERE event_id < 100)""")
def s8_stored_lookup(spark, sf):
    """Chunks at the positions that a table names, from a stored index: only their folders are read."""
    from quarry.operators.file_index import StoredIndex
    index = StoredIndex(_folder(spark, "s8"), rows_per_part=500).write(_chunks(spark, sf).select("doc_id", "chunk_idx"), ["doc_id", "chunk_idx"])
    return index.at(table(spark, sf, "events").where("event_id < 100").select(F.col("event_id") * 3)).select("doc_id", "chunk_idx", "idx")


@register("s9_file_offsets", """
WITH l AS (SELECT source, doc_id, doc_id || ' ' || replace(coalesce(text, ''), chr(10), ' ') AS line FROM documents),
o AS (SELECT source, row_number() OVER w - 1 AS line, sum(octet_length(encode(line)) + 1) OVER w AS byte_end,
             octet_length(encode(line)) + 1 AS n FROM l WINDOW w AS (PARTITION BY source ORDER BY doc_id))
SELECT source, line::BIGINT AS line, (byte_end - n)::BIGINT AS byte_start, byte_end::BIGINT AS byte_end FROM o""")
def s9_file_offsets(spark, sf):
    """Offsets of the lines of text files, one file a source."""
    from quarry.operators.file_index import file_line_offsets
    path = _folder(spark, "s9")
    line = F.concat_ws(" ", "doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")))
    _docs(spark, sf).select("source", "doc_id", line.alias("value")).repartition("source").sortWithinPartitions("source", "doc_id") \
        .select("source", "value").write.partitionBy("source").text(path)
    got = file_line_offsets(spark, path)
    return got.select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source"), "line", "byte_start", "byte_end")


@register("b9_sft_plan", SFT_SQL + """,
kk AS (SELECT conv_id::VARCHAR AS key, length(replace(replace(loss_mask, ',', ''), '0', '')) AS lt FROM m),
ss AS (SELECT lt, row_number() OVER (ORDER BY md5(key || ':0:42'), key) - 1 AS pos FROM kk)
SELECT (pos // 16)::BIGINT AS step, count(*)::BIGINT AS n_rows, sum(lt)::BIGINT AS loss_tokens FROM ss GROUP BY pos // 16""")
def b9_sft_plan(spark, sf):
    """The training plan over chat sequences."""
    from quarry.plans.training import training_plan
    seqs = sft_sequences(table(spark, sf, "conversations")).select(F.col("conv_id").cast("string").alias("key"), "loss_mask")
    return training_plan(seqs, "key", batch_size=16).select("step", "n_rows", "loss_tokens")


@register("q13_long_conversations", SFT_SQL.replace(
    "FROM conversations", "FROM (SELECT conv_id % 10 AS conv_id, conv_id * 1000 + turn AS turn, role, text FROM conversations)")
    + f"""
SELECT p.conv_id, n_tokens::BIGINT AS n_tokens, {sql_text('p[1:511]')} AS x, m.loss_mask
FROM p JOIN m ON p.conv_id = m.conv_id""")
def q13_long_conversations(spark, sf):
    """Chat sequences of conversations with many more turns than fit (n_tokens counts them all)."""
    c = table(spark, sf, "conversations").select(
        (F.col("conv_id") % 10).alias("conv_id"), (F.col("conv_id") * 1000 + F.col("turn")).alias("turn"), "role", "text")
    s = sft_sequences(c)
    return s.select("conv_id", F.col("n_tokens").cast("long").alias("n_tokens"), ids_text(F.col("x")).alias("x"),
                    ids_text(F.col("loss_mask")).alias("loss_mask"))


# ---------------------------------------------------------------- S4, S7, S10, V1-V4 (files written from the tables)
def _folder(spark, name: str) -> str:
    """A new folder next to the checkpoints, which all executors share."""
    import uuid

    from quarry.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _line_files(spark, sf) -> str:
    """Documents as JSON lines, in files whose names follow doc_id."""
    from quarry.sources.jsonl import write_jsonl
    path = _folder(spark, "lines")
    write_jsonl(_docs(spark, sf).orderBy("doc_id").select("text"), path)
    return path


@register("s4_read_json_files", "SELECT doc_id, lang, text FROM documents")
def s4_read_json_files(spark, sf):
    from quarry.sources.jsonl import read_json_files, write_jsonl
    paths = [_folder(spark, "json"), _folder(spark, "json")]
    for k, p in enumerate(paths):
        write_jsonl(_docs(spark, sf).where(F.col("doc_id") % 2 == k).select("doc_id", "lang", "text"), p)
    return read_json_files(spark, paths, "doc_id long, lang string, text string")


@register("s4_inferred_columns", """
SELECT doc_id, lang, n_chars, CASE WHEN doc_id % 2 = 1 THEN source END AS source, 'bigint,string,bigint,string' AS kinds
FROM documents""")
def s4_inferred_columns(spark, sf):
    """Columns and types from the files; a column that only some files have is null in the others."""
    from quarry.sources.jsonl import read_json_files, write_jsonl
    paths = [_folder(spark, "json"), _folder(spark, "json")]
    for k, (p, cols) in enumerate(zip(paths, (["doc_id", "lang", "n_chars"], ["doc_id", "lang", "n_chars", "source"]))):
        write_jsonl(_docs(spark, sf).where(F.col("doc_id") % 2 == k).select(*cols), p)
    got = read_json_files(spark, paths).select("doc_id", "lang", "n_chars", "source")
    return got.withColumn("kinds", F.lit(",".join(t for _, t in got.dtypes)))


@register("s7_source_if_exists", "SELECT text AS value FROM documents")
def s7_source_if_exists(spark, sf):
    """An absent source gives no rows; a present one is read."""
    from quarry.sources.jsonl import parse_jsonl, source_if_exists
    absent = source_if_exists(spark, _folder(spark, "absent"), "value string")
    return parse_jsonl(absent.unionByName(source_if_exists(spark, _line_files(spark, sf), "value string"))) \
        .withColumnRenamed("text", "value")


@register("s10_observe_ingest", """
SELECT count(*)::BIGINT AS lines, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes FROM documents""")
def s10_observe_ingest(spark, sf):
    from quarry.sources.jsonl import observe_ingest
    lines, seen = observe_ingest(_docs(spark, sf).select(F.col("text").alias("value")))
    lines.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["lines"], seen.get["bytes"])], "lines long, bytes long")


def _run_stream(writer, spark) -> None:
    writer.option("checkpointLocation", _folder(spark, "stream")).trigger(availableNow=True).start().awaitTermination()


@register("v1_chunk_stream", f"SELECT text FROM ({CHUNKS_SQL})")
def v1_chunk_stream(spark, sf):
    from quarry.streaming.streams import chunk_stream, read_lines
    out = _folder(spark, "v1")
    _run_stream(chunk_stream(read_lines(spark, _line_files(spark, sf), 2)).select("text").writeStream.format("parquet")
                .option("path", out), spark)
    return spark.read.parquet(out)


def _conversation_lines(spark, sf) -> DataFrame:
    """One JSON object per conversation, and one without turns."""
    from quarry.sources.tables import raw_turns
    t = raw_turns(table(spark, sf, "conversations"))
    conv = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "from", "value"))).alias("c"))
    turns = F.transform("c", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    return conv.select(F.to_json(F.struct("conv_id", turns.alias("conversations"))).alias("value")) \
        .unionByName(spark.range(1).select(F.lit('{"conv_id":-1,"conversations":[]}').alias("value")))


@register("v2_chat_stream", ORACLE["c6_render_chat"].replace("SELECT conv_id, '<|im_start|>system'", "SELECT '<|im_start|>system'")
          .replace(" AS text,\n       (count(r) + 1)::BIGINT AS n_messages", " AS text"))
def v2_chat_stream(spark, sf):
    from quarry.streaming.streams import chat_stream, read_lines
    lines, out = _folder(spark, "lines"), _folder(spark, "v2")
    _conversation_lines(spark, sf).write.text(lines)
    _run_stream(chat_stream(read_lines(spark, lines), render=True).writeStream.format("parquet").option("path", out), spark)
    return spark.read.parquet(out)


@register("v3_pretoken_count_stream", WORDS_SQL)
def v3_pretoken_count_stream(spark, sf):
    """Running counts over several micro-batches, each of which writes the changed words only."""
    from quarry.streaming.streams import latest_counts, pretoken_count_stream, read_lines, write_changed_counts
    out = _folder(spark, "v3")
    counts = pretoken_count_stream(read_lines(spark, _line_files(spark, sf), 4))
    write_changed_counts(counts, out, _folder(spark, "stream")).awaitTermination()
    return latest_counts(spark, out)


@register("s10_ingest_stream", """
SELECT count(*)::BIGINT AS lines, sum(octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS bytes, true AS several
FROM documents""")
def s10_ingest_stream(spark, sf):
    """Lines and bytes of a stream, added up over the rows that the listener stored for its micro-batches."""
    from quarry.sources.jsonl import observe_ingest
    from quarry.streaming.streams import IngestLog, read_lines
    path = _folder(spark, "lines")
    _docs(spark, sf).select(F.translate(F.coalesce("text", F.lit("")), "\n\r", "  ").alias("value")).repartition(6) \
        .write.text(path)
    log = IngestLog(spark, _folder(spark, "s10"))
    spark.streams.addListener(log)
    lines, _ = observe_ingest(read_lines(spark, path, 2))
    query = lines.select("value").writeStream.format("parquet").option("path", _folder(spark, "s10-lines")) \
        .option("checkpointLocation", _folder(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = log.table(query)
    spark.streams.removeListener(log)
    return rows.agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"), (F.count("*") > 2).alias("several"))


@register("v4_pack_stream", f"""
WITH u AS (SELECT doc_id, unnest(ids) AS id, unnest(range(len(ids))) AS k FROM (SELECT doc_id, {sql_bytes('text')} AS ids FROM documents)),
g AS (SELECT id, row_number() OVER (ORDER BY doc_id, k) - 1 AS pos, count(*) OVER () AS total FROM u)
SELECT (pos // 2048)::BIGINT AS block, string_agg(id::VARCHAR, ',' ORDER BY pos) AS input_ids
FROM g WHERE total < 2048 OR pos < (total // 2048) * 2048 GROUP BY pos // 2048""")
def v4_pack_stream(spark, sf):
    """All files in one micro-batch, packed in the order of the documents."""
    from quarry.streaming.streams import pack_stream, read_lines
    out = _folder(spark, "v4")
    pack_stream(read_lines(spark, _line_files(spark, sf)), out, _folder(spark, "stream")).awaitTermination()
    return spark.read.parquet(out).select("block", ids_text(F.col("input_ids")).alias("input_ids"))
