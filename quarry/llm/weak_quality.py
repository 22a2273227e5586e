"""Operator 2: quality rules by weak supervision [native].

Each rule looks at one figure of a text and votes good (1) where it finds it clean, bad (-1) where it
finds junk, and abstains (0) in between.  No failed rule rejects by itself:
expectation-maximisation over all documents fits a mixture of good documents and of kinds of junk, each with
its share and with each rule's rate of bad votes among its votes, and a document's
quality is the posterior probability of "good" given all its votes.  Shares and rates are all
estimated; ``KINDS`` only says from which rules each kind starts.  Rules are premised to be no worse than
chance: their rate of bad votes in a kind of junk is at least that on good documents.  As junk of a kind
shows in several figures, a bad vote that the kind's other rules do not share is outvoted.

EM needs only the number of documents for each pattern of votes, which one partial aggregate yields: at most
3 ** number of rules rows (59,049 for these ten), in practice a few hundred.  That table comes to the
driver, where the steps are plain arithmetic.  All text figures
are built-in functions and array functions in one narrow pass; nothing about a
document is shuffled except its vote pattern's count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
SMOOTH = 1e-3  # of all documents, added to every count of votes
STEPS = 100
TOLERANCE = 1e-4
#: rules from which EM starts each kind of junk
KINDS = [["symbols", "symbol_runs", "word_size"], ["symbols", "bare_words"], ["capitals", "shouting"], ["repeats", "variety", "dup_lines"],
         ["length", "variety"]]
#: where EM starts: share of each kind, rate of bad votes of its rules, and of all other rules and on good documents
START = (0.03, 0.6, 0.01)


def _size(c) -> Column:
    return F.size(c).cast("long")


def _tail(array: str, start: int) -> Column:
    """The array from place ``start`` (from 1) on."""
    return F.slice(array, start, F.greatest(F.size(array) - (start - 1), F.lit(0)))


def text_figures(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` without its text plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and the figures that only the rules use (all long, prefix ``_q``).

    n_repeat_words: words in three-word windows that occur twice or more.  Windows are
    compared by 64-bit hash; sorting the (hash, place) pairs of one text brings equal
    windows together, so the cost is n log n in the text's words.
    """
    others = [c for c in docs.columns if c != text_col]
    step = docs.select(*others, F.coalesce(text_col, F.lit("")).alias("_t"))
    step = step.select(
        *others, F.regexp_extract_all("_t", F.lit(f"([^{SPACE}]+)"), 1).alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")).alias("_l"),
        F.char_length(F.regexp_replace("_t", f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.char_length(F.regexp_replace("_t", r"\P{Lu}+", "")).cast("long").alias("_qupper"),
        (F.char_length("_t") - F.char_length(F.regexp_replace("_t", rf"([{SYMBOLS}])\1\1+", ""))).cast("long").alias("_qruns"),
        F.regexp_count("_t", F.lit(rf"(?<![^{SPACE}])[^\p{{L}}\p{{N}}{SPACE}]+(?![^{SPACE}])")).cast("long").alias("_qbare"),
        (F.char_length("_t") - F.char_length(F.replace("_t", F.lit("!!"), F.lit("")))).cast("long").alias("_qshouts"))
    figures = [*others, "word_chars", "n_symbols", "_qupper", "_qruns", "_qbare", "_qshouts"]
    step = step.select(*figures, _size("_w").alias("n_words"), F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
                       _size("_l").alias("_qlines"),
                       (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"))
    figures += ["n_words", "_qlines", "n_dup_lines"]
    step = step.select(*figures, "_h", F.size(F.array_distinct("_h")).cast("long").alias("_qdistinct"),
                       F.zip_with("_h", _tail("_h", 2), lambda a, b: F.xxhash64(a, b)).alias("_h2"))
    figures += ["_qdistinct"]
    windows = F.zip_with(F.slice("_h2", 1, F.greatest(F.size("_h") - 2, F.lit(0))), _tail("_h", 3),
                         lambda a, b: F.xxhash64(a, b))
    step = step.select(*figures, F.sort_array(F.transform(windows, lambda x, i: F.struct(
        x.alias("k"), i.alias("p")))).alias("_s"))
    pairs = F.zip_with("_s", _tail("_s", 2), lambda a, b: F.when(a["k"] == b["k"], F.array(a["p"], b["p"])))
    step = step.select(*figures, F.sort_array(F.array_distinct(F.flatten(F.filter(
        pairs, lambda x: x.isNotNull())))).alias("_p"))
    covered = F.aggregate(F.zip_with("_p", _tail("_p", 2), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    return step.select(*figures, covered.alias("n_repeat_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes over the text figures.  On a text without words only the length rule votes."""
    n = F.col("n_words")

    def ratio(a, b=n):
        return F.try_divide(F.col(a), b)

    words, lines, upper = ratio("word_chars"), ratio("n_dup_lines", F.col("_qlines")), ratio("_qupper", F.col("word_chars"))
    return {
        "length": _vote(n < 20, n >= 100),
        "symbols": _vote(ratio("n_symbols") > 0.1, ratio("n_symbols") <= 0.02),
        "symbol_runs": _vote(ratio("_qruns") > 0.05, ratio("_qruns") <= 0.01),
        "bare_words": _vote(ratio("_qbare") > 0.2, ratio("_qbare") <= 0.05),
        "word_size": _vote((words < 3.2) | (words > 6.5), (words >= 4) & (words <= 6)),
        "dup_lines": _vote((F.col("n_dup_lines") >= 3) & (lines > 0.3), lines <= 0.05),
        "repeats": _vote(ratio("n_repeat_words") > 0.4, ratio("n_repeat_words") <= 0.1),
        "capitals": _vote(upper > 0.4, upper <= 0.1),
        "shouting": _vote(ratio("_qshouts") > 0.2, ratio("_qshouts") <= 0.02),
        "variety": _vote((n >= 20) & (ratio("_qdistinct") < 0.15), (n >= 50) & (ratio("_qdistinct") > 0.5)),
    }


def _likelihoods(names: list[str], shares: list[float], rates: dict) -> list[Column]:
    """log(share * P(votes | class)) of each class; an abstention says nothing."""
    out = []
    for k, share in enumerate(shares):
        total = F.lit(math.log(share))
        for name in names:
            bad = rates[name][k]
            total = total + F.when(F.col(f"_v_{name}") == 1, math.log(1 - bad)).when(
                F.col(f"_v_{name}") == -1, math.log(bad)).otherwise(0.0)
        out.append(total)
    return out


def posteriors(names: list[str], shares: list[float], rates: dict) -> list[Column]:
    """P(class | votes) of each class, good documents first."""
    logs = _likelihoods(names, shares, rates)
    most = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - most) for x in logs]
    whole = parts[0]
    for x in parts[1:]:
        whole = whole + x
    return [x / whole for x in parts]


def estimate(patterns: DataFrame, names: list[str], kinds: list[list[str]] | None = None) -> tuple[list[float], dict]:
    """EM over (votes, n) rows: (shares, {rule: rates of bad votes among its votes}), for good documents and each kind.

    Starts from ``START``.  The smoothing is a share of the number of documents, so the result does not depend on
    the table's size.  An empty table keeps the start.
    """
    kinds = KINDS if kinds is None else kinds
    share, own, other = START
    shares = [1 - share * len(kinds)] + [share] * len(kinds)
    rates = {r: [other] + [own if r in kind else other for kind in kinds] for r in names}
    rows = [([r[f"_v_{x}"] for x in names], r["n"]) for r in patterns.collect()]
    total = sum(n for _, n in rows)
    pad = SMOOTH * total
    for _ in range(STEPS if total else 0):
        weight = [0.0] * len(shares)
        cells = {r: [[0.0, 0.0] for _ in shares] for r in names}  # bad and good votes by class
        for votes, n in rows:
            p = list(shares)
            for r, v in zip(names, votes):
                if v:
                    p = [x * (b if v < 0 else 1 - b) for x, b in zip(p, rates[r])]
            whole = sum(p) / n
            for k, x in enumerate(p):
                weight[k] += x / whole
                for r, v in zip(names, votes):
                    if v:
                        cells[r][k][v > 0] += x / whole
        new_shares = [(w + pad) / (total + len(shares) * pad) for w in weight]
        new = {}
        for r in names:
            found = [(bad + pad) / (bad + good + 2 * pad) for bad, good in cells[r]]
            new[r] = [found[0]] + [max(x, found[0]) for x in found[1:]]
        moved = max(abs(a - b) for old, now in ((shares, new_shares), *((rates[r], new[r]) for r in names)) for a, b in zip(old, now))
        shares, rates = new_shares, new
        if moved < TOLERANCE:
            break
    return shares, rates


def quality(docs: DataFrame, text_col: str = "text", min_words: int = 50, max_repeat_percent: int = 50,
            votes: dict[str, Column] | None = None, kinds: list[list[str]] | None = None) -> DataFrame:
    """The rows of ``docs`` without the text, plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), quality (double, posterior of good), base_failed and kept (boolean).

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent``
    percent of them in repeated three-word windows.  ``kept``: not base_failed and a
    quality of at least 0.5.  A null text has no words.  Columns that carry one of the
    new names are replaced; null or repeated ids are passed on; an empty table gives
    no rows.  ``votes`` replaces the rules (columns of -1, 0, 1 over the text figures), and ``kinds`` the
    lists of rules from which EM starts each kind of junk.
    """
    votes = votes or rules()
    names = list(votes)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "quality", "base_failed", "kept"]
    plain = docs.select(*[c for c in docs.columns if c not in added])
    others = [c for c in plain.columns if c != text_col]
    voted = cut_lineage(text_figures(plain, text_col).select(
        *others, *added[:5], *[v.cast("int").alias(f"_v_{r}") for r, v in votes.items()]))
    patterns = voted.groupBy(*[f"_v_{r}" for r in names]).agg(F.count("*").alias("n"))
    shares, rates = estimate(patterns, names, kinds)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return voted.withColumn("quality", posteriors(names, shares, rates)[0]).select(
        *others, *added[:6], failed.alias("base_failed"), (~failed & (F.col("quality") >= 0.5)).alias("kept"))
