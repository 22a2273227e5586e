"""JSON-lines sources and sinks.

Parsing works on a DataFrame of lines, so the same functions serve batch
reads (``spark.read.text``) and streams (``spark.readStream.text``).  A line
is parsed strictly (plain JSON parsing accepts trailing junk): the line and, as a
second element, its own md5 are parsed as one JSON array.  A line that closes the
array itself loses that marker, and no line can contain its own md5.  The first
element must be an object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.chat import RAW_TURNS_TYPE
from quarry.operators.index import with_row_index

_WS_END = r"\}[ \t\r\n]*$"


def _variant(line: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit(',"'), F.md5(line), F.lit('"]')))


def json_reason(line: Column, key: str | None = None) -> Column:
    """NULL for a good object line, else malformed / not_object / missing_key / not_string."""
    return _reason(_variant(line), line, key)


def _reason(v: Column, line: Column, key: str | None = None) -> Column:
    first = F.schema_of_variant(F.variant_get(v, "$[0]", "variant"))
    whole = F.try_variant_get(v, "$[1]", "string").eqNullSafe(F.md5(line))
    r = (F.when(v.isNull() | first.isNull() | ~whole, F.lit("malformed"))
         .when(~first.startswith("OBJECT") | ~line.rlike(_WS_END), F.lit("not_object")))
    if key is not None:
        kt = F.schema_of_variant(F.variant_get(v, f"$[0].{key}", "variant"))
        r = r.when(kt.isNull(), F.lit("missing_key")).when(kt != "STRING", F.lit("not_string"))
    return r


def parse_jsonl(lines: DataFrame, key: str = "text", missing: str = "", line_col: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """S1 on lines: one object per line; malformed lines dropped; absent key -> ``missing``.

    A present key whose value is not a string is dropped as well.
    """
    keep = keep or []
    line = F.col(line_col)

    def read(v: Column) -> Column:
        kt = F.schema_of_variant(F.variant_get(v, f"$[0].{key}", "variant"))
        val = F.when(kt.isNull(), F.lit(missing)).otherwise(F.try_variant_get(v, f"$[0].{key}", "string"))
        return F.struct(val.alias(key), (_reason(v, line).isNull() & (kt.isNull() | (kt == "STRING"))).alias("_good"))

    # a line is parsed once: a filter would be pushed down to the lines with the parsing in it
    found = F.filter(F.transform(F.array(_variant(line)), read), lambda r: r["_good"])
    return lines.select(*keep, F.inline(found)).drop("_good")


def read_jsonl(spark: SparkSession, paths, key: str = "text", missing: str = "") -> DataFrame:
    """Read JSON-lines files into a one-column table."""
    return parse_jsonl(spark.read.text(paths), key, missing)


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """1-based line number of each line within its file (file order, distributed)."""
    tagged = lines.select("value", F.col("_metadata.file_path").alias("file"),
                          F.col("_metadata.file_block_start").alias("_blk"),
                          F.monotonically_increasing_id().alias("_pos"))
    return with_row_index(tagged, ["_blk", "_pos"], "line_num", group_cols=["file"]) \
        .withColumn("line_num", F.col("line_num") + 1).drop("_blk", "_pos")


def split_report(numbered: DataFrame, key: str = "text", line_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S2 on numbered lines: (rows, rejects(file, line_num, reason)); absent key is a reject."""
    reason = json_reason(F.col(line_col), key)
    tagged = numbered.withColumn("_reason", reason)
    rows = tagged.where(F.col("_reason").isNull()).select(
        *[c for c in numbered.columns if c != line_col],
        F.try_variant_get(_variant(F.col(line_col)), f"$[0].{key}", "string").alias(key))
    rejects = tagged.where(F.col("_reason").isNotNull()).select(
        *[c for c in numbered.columns if c != line_col], F.col("_reason").alias("reason"))
    return rows, rejects


def read_jsonl_report(spark: SparkSession, paths, key: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows plus a reject report with 1-based line numbers."""
    return split_report(with_line_numbers(spark.read.text(paths)), key)


def parse_json_array_lines(lines: DataFrame, line_col: str = "value", keep_fields: dict | None = None) -> DataFrame:
    """S3 on lines: strip; skip blank, '[', ']', '],'; drop one trailing comma; parse
    strictly; return the ``conversations`` list (absent or empty -> no row, C3)."""
    stripped = F.regexp_replace(F.col(line_col), r"(?U)^\s+|\s+$", "")
    body = F.regexp_replace(stripped, ",$", "")
    pre = lines.select(stripped.alias("_s"), body.alias("_b")).where(~F.col("_s").isin("", "[", "]", "],"))
    v = _variant(F.col("_b"))
    ok = json_reason(F.col("_b")).isNull()
    conv = F.try_variant_get(v, "$[0].conversations", RAW_TURNS_TYPE)
    extra = [F.try_variant_get(v, f"$[0].{k}", t).alias(k) for k, t in (keep_fields or {}).items()]
    out = pre.where(ok).select(*extra, conv.alias("conversations"))
    return out.where(F.size(F.coalesce(F.col("conversations"), F.array())) > 0)


def read_json_array_lines(spark: SparkSession, paths, keep_fields: dict | None = None) -> DataFrame:
    """S3: raw conversation records from JSONL or one-object-per-line JSON arrays."""
    return parse_json_array_lines(spark.read.text(paths), keep_fields=keep_fields)


def read_json_files(spark: SparkSession, paths: list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Many JSON-lines files; columns inferred unless a schema is given (prefer one at scale)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths)


def to_json_lines(df: DataFrame, value: Column | None = None) -> DataFrame:
    """S6 as a DataFrame: one JSON text per row (non-ASCII kept raw)."""
    value = value if value is not None else F.to_json(F.struct(*df.columns))
    return df.select(value.alias("value"))


def write_jsonl(df: DataFrame, path: str, value: Column | None = None, mode: str = "overwrite",
                compression: str | None = None) -> None:
    """Write JSON lines (``{"text": ...}`` by default, or any JSON column such as a message array)."""
    w = to_json_lines(df, value).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) if any(ch in path for ch in "*?[") else fs.exists(p)


def source_if_exists(spark: SparkSession, path: str, schema: T.StructType | str, reader=None) -> DataFrame:
    """Absent input -> notice and an empty table of the declared schema (no failure)."""
    if path_exists(spark, path):
        return reader(path) if reader else spark.read.text(path)
    print(f"notice: input {path} not found, skipping")
    return spark.createDataFrame([], schema)


def observe_ingest(lines: DataFrame, name: str = "ingest", line_col: str = "value",
                   stripped: bool = False) -> tuple[DataFrame, Observation | str]:
    """Lines and bytes consumed, collected as observed metrics of the same job.

    ``stripped`` counts the stripped line + 1, as the conversation path does.
    Batch: returns an ``Observation``; streams: metrics appear in each
    progress' ``observedMetrics`` under ``name``.
    """
    text = F.regexp_replace(F.col(line_col), r"(?U)^\s+|\s+$", "") if stripped else F.col(line_col)
    metrics = [F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length(text) + 1).alias("bytes")]
    if lines.isStreaming:
        return lines.observe(name, *metrics), name
    obs = Observation(name)
    return lines.observe(obs, *metrics), obs
