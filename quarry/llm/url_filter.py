"""Operator 9: URL filters with host word segmentation and naive Bayes.

Allow and block rules decide first: a rule fits its host and all subdomains if the
path starts with the rule's, and the longest one wins.  URLs that no rule fits
are judged by multinomial naive Bayes, learned from the URLs that rules did decide:
its tokens are the words of the host labels (the top-level domain left out), split by
a Viterbi search over unigram word costs, and the words of the path, numbers
as one token.

The unigram counts of all words of the pages' text stay a Spark table.  The substrings of the
distinct parts of host labels are joined with it, and each part is split with the words that
were found in it, so that no word is left out and no dictionary travels.  Distinct (host,
path) pairs are scored, so frequent ones are worked on once; token counts
are partial aggregates, and the scores of undecided hosts and paths are equi-joins of
their tokens with the token weights.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

#: letters in a host label at most (DNS); longer runs, which no host has, are split in pieces of so many
LABEL = 63
#: (verdict, host, path)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
_AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, _AFTER, 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(url, _AFTER, 2))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as host + path, its verdict) of the longest fitting rule, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of all words (two letters or more) in the text, mark-up cut off."""
    text = F.lower(F.regexp_replace(F.coalesce(text_col, F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>|&\w+;", " "))
    words = pages.select(F.explode(F.regexp_extract_all(text, F.lit(rf"(\p{{L}}{{2,}})"), 1)).alias("word"))
    return cut_lineage(words.groupBy("word").agg(F.count("*").alias("n")))


class Segmenter:
    """Least-cost splits of letter strings into words; ``total``: of the counts of all words, if more than these."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: -math.log(n / self.total) for w, n in counts.items()}

    def unknown(self, length: int) -> float:
        """Cost of a string outside the dictionary: it falls tenfold with every letter."""
        return math.log(self.total) + length * math.log(10)

    def split(self, text: str) -> list[str]:
        """Viterbi over the end positions; the earlier start wins ties."""
        best, start = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = []
            for a in range(max(0, end - LABEL), end):
                word = text[a:end]
                options.append((best[a] + self.cost.get(word, self.unknown(end - a)), a))
            cost, a = min(options)
            best.append(cost)
            start.append(a)
        out, end = [], len(text)
        while end:
            out.append(text[start[end]: end])
            end = start[end]
        return out[::-1]


_WORDS = re.compile(r"[^\W\d_]+|\d+")


def host_parts(host: str) -> list[str]:
    """Runs of letters and of digits in the host labels but the last, in pieces of LABEL characters at most."""
    return [part[i: i + LABEL] for label in host.split(".")[:-1] for part in _WORDS.findall(label) for i in range(0, len(part), LABEL)]


def path_tokens(path: str) -> list[str]:
    return ["p:#" if part[0].isdigit() else f"p:{part}" for part in _WORDS.findall(path.lower())]


def part_tokens(part: str, split) -> list[str]:
    return ["h:#"] if part[0].isdigit() else [f"h:{w}" for w in split(part)]


def tokens(host: str, path: str, split) -> list[str]:
    """Tokens of a URL: ``h:`` words of the host labels but the last, ``p:`` words of the path; # for numbers."""
    return [t for part in host_parts(host) for t in part_tokens(part, split)] + path_tokens(path)


def host_tokens(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, token), a row per occurrence, for distinct hosts; ``counts`` has (word, n)."""

    def rows(cells, names, width):
        got = [pa.array(c, pa.string()) for c in zip(*cells)] or [pa.nulls(0, pa.string())] * width
        return pa.RecordBatch.from_arrays(got, names=names)

    def parts_of(batches):
        for batch in batches:
            yield rows([(h, part) for h in batch.column(0).to_pylist() for part in host_parts(h)], ["host", "part"], 2)

    def substrings(batches):
        for batch in batches:
            for part in batch.column(0).to_pylist():
                n = len(part)
                yield rows([(part, w) for w in {part[a:b] for a in range(n) for b in range(a + 2, n + 1)}],
                           ["part", "word"], 2)

    placed = cut_lineage(hosts.select("host").mapInArrow(parts_of, "host string, part string"))
    parts = placed.select("part").distinct()
    found = parts.mapInArrow(substrings, "part string, word string").join(counts, "word") \
        .groupBy("part").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("ns"))
    total = counts.agg(F.sum("n")).first()[0] or 0

    def split(batches):
        for batch in batches:
            part, words, ns = (batch.column(c).to_pylist() for c in range(3))
            got = [part_tokens(p, Segmenter(dict(zip(w or (), n or ())), total).split) for p, w, n in zip(part, words, ns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.string()))], names=["part", "tokens"])

    splits = parts.join(found, "part", "left").select("part", "words", "ns") \
        .mapInArrow(split, "part string, tokens array<string>")
    return placed.join(splits, "part").select("host", F.explode("tokens").alias("token"))


def with_path_tokens(pairs: DataFrame) -> DataFrame:
    """(all columns of ``pairs``, tokens array) for rows with the path second."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)

    def run(batches):
        for batch in batches:
            got = [path_tokens(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(got, pa.list_(pa.string()))],
                                             names=batch.schema.names + ["tokens"])

    return pairs.mapInArrow(run, f"{kinds}, tokens array<string>")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
          rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: id_col, host, path, rule, verdict, block_odds (log odds, null where a rule decided).

    ``verdict`` is the fitting rule's, else "block" for block_odds > 0 and "allow"
    otherwise; a class without any decided URL, or an empty table of decided URLs, gives
    odds of 0.  A null URL and one without ``://`` have empty host and path, no tokens,
    and are judged by the prior odds.  A letter run beyond LABEL, in no valid host, is split piece by piece.  Rows with null or repeated ids are each judged;
    other columns are ignored.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    pairs = ruled.groupBy("host", "path", "ruled").agg(F.count("*").alias("n"))
    words = with_path_tokens(pairs)
    in_hosts = cut_lineage(host_tokens(pairs.select("host").distinct(), word_counts(pages, text_col)))
    block = F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)
    allow = F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)
    by_host = pairs.where("ruled is not null").groupBy("host").agg(F.sum(block).alias("b"), F.sum(allow).alias("a"))
    by_token = words.where("ruled is not null").select(F.explode("tokens").alias("token"), block.alias("b"), allow.alias("a")) \
        .unionByName(in_hosts.join(by_host, "host").select("token", "b", "a")) \
        .groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    by_token = cut_lineage(by_token)
    urls = pairs.agg(F.sum(block), F.sum(allow)).first()
    kinds, all_b, all_a = by_token.agg(F.count("*"), F.sum("b"), F.sum("a")).first()
    if urls[0] and urls[1]:
        prior = math.log(urls[0] / urls[1])
        weight = F.log((F.col("b") + 1) / (all_b + kinds)) - F.log((F.col("a") + 1) / (all_a + kinds))
    else:
        prior, weight = 0.0, F.lit(0.0)
    weights = by_token.select("token", weight.alias("w"))
    undecided = words.where("ruled is null").select("host", "path", F.explode_outer("tokens").alias("token"))
    of_host = in_hosts.join(weights, "token").groupBy("host").agg(F.sum("w").alias("host_odds"))
    scored = undecided.join(weights, "token", "left") \
        .groupBy("host", "path").agg(F.sum(F.coalesce("w", F.lit(0.0))).alias("odds")).join(of_host, "host", "left") \
        .select("host", "path", (F.col("odds") + F.coalesce("host_odds", F.lit(0.0))).alias("odds"))
    out = ruled.join(scored.withColumnRenamed("host", "_h").withColumnRenamed("path", "_p"),
                     (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")) & F.col("ruled").isNull(), "left")
    odds = F.when(F.col("ruled").isNull(), prior + F.coalesce("odds", F.lit(0.0)))
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule",
                      F.coalesce("ruled", F.when(odds > 0, "block").otherwise("allow")).alias("verdict"),
                      odds.alias("block_odds"))
