"""Queries of the numbered operators: thin wrappers that derive the result columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (hard_negatives, line_templates, lz_fingerprint, minhash_dedup, mixing, packing, pitman_yor,
                        secret_scan, suffix_dedup, toxicity, url_filter, weak_quality, whitening)
from quarry.llm.keys import fold
from quarry.sources.tables import table


def tokenizer_path() -> str:
    """The public word-level BPE file (a parameter of the packing operator)."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """The network fitted to labelled rows outside the held-out fold."""
    return toxicity.train_on(*toxicity.sample_rows(docs, labels.where(fold("doc_id") != 0), "doc_id", "text", "toxic"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights proportional to the square root of their rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.temperature_weights(docs))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edited_pairs(table(spark, sf_dir, "documents"))


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs, counts=True)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector that takes part and component; rows without a usable vector give none."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    of = F.array(*[F.lit(e) for e in model.explained]) if model and len(model.values) else F.array().cast("array<double>")
    return whitening.whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_i", "whitened")) \
        .select("vec_id", (F.col("_i") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                "deviation", "whitened", F.get(of, F.col("_i")).alias("explained"),
                F.lit(model.identity_error if model else None).cast("double").alias("identity_error"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: base counts and digest, all spans, and what the cost model added."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != "guess")

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"), n("guess"),
                        F.array_max(F.transform("costed", lambda v: v["bits"])).alias("guess_bits"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 100; ids divisible by 7 take the next label of ten first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_quality, op3_minhash_dedup, op4_toxicity, op5_fingerprint, op6_pitman_yor, op7_packing,
    op8_suffix_dedup, op9_url_filter, op10_line_templates, op11_whitening, op12_secrets, op13_hard_negatives)}

#: Shares by largest remainder, the earliest-deadline-first simulation of one period as a recursion, then arithmetic.
_MIXING_SQL = """
WITH RECURSIVE c AS (SELECT source, sqrt(count(*)) AS w FROM documents GROUP BY source),
n AS (SELECT greatest(1000, 64 * count(*))::BIGINT AS p FROM c),
x AS (SELECT source, w / (SELECT sum(w) FROM c) * p AS exact FROM c, n),
f AS (SELECT source, greatest(1, floor(exact))::BIGINT AS low, row_number() OVER (ORDER BY greatest(1, floor(exact)) - exact, source) AS r FROM x),
sh AS (SELECT source, low + (r <= (SELECT p FROM n) - (SELECT sum(low) FROM f))::BIGINT AS share,
              row_number() OVER (ORDER BY source) AS i FROM f),
l AS (SELECT list(share ORDER BY i) AS shares FROM sh),
sim AS (
  SELECT -1::BIGINT AS t, 0::BIGINT AS pick, list_transform(shares, lambda v: 0::BIGINT) AS done FROM l
  UNION ALL
  SELECT t + 1, pick, list_transform(done, lambda d, i: d + (i = pick)::BIGINT)
  FROM (SELECT t, done, list_position(due, list_min(due))::BIGINT AS pick
        FROM (SELECT t, done, list_transform(done, lambda d, i:
                CASE WHEN d < shares[i] AND (d * p) // shares[i] <= t + 1
                     THEN ((d + 1) * p + shares[i] - 1) // shares[i] ELSE 1000000000 END) AS due
              FROM sim, l, n WHERE t < p - 1))),
slots AS (SELECT pick AS i, t, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k FROM sim WHERE t >= 0),
ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id)) - 1 AS rank FROM documents),
b AS (SELECT doc_id, source, rank, rank // 16 AS block, share, i FROM ranked JOIN sh USING (source))
SELECT doc_id, source, block::BIGINT AS block, ((block * p) // share)::BIGINT AS release,
       (((block + 1) * p + share - 1) // share)::BIGINT AS deadline,
       ((block // share) * p + t)::BIGINT AS slot, (rank % 16)::BIGINT AS slot_offset
FROM n, b JOIN slots ON slots.i = b.i AND slots.k = block % share"""

#: All pairs that share a shingle, counted, and the closure of the links.
_DEDUP_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE
          list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reach = e.x),
g AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT g.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, g.doc_id = component_id AS kept
FROM g LEFT JOIN n USING (doc_id)"""

#: Every anchor against all rows, ranked; windows by their limits.
_NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

ORACLE: dict[str, str] = {"op1_mixing": _MIXING_SQL, "op3_minhash_dedup": _DEDUP_SQL, "op13_hard_negatives": _NEGATIVES_SQL}
