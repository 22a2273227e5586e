"""Operator 6: scoring texts with a hierarchical Pitman-Yor language model.

Tokens are words and one end mark per text.  The restaurant of a context serves the
next token; a context is the class of the token before (its hash modulo
``CONTEXTS - 1``, and one class for the start of a text).  All context restaurants
share one parent, the unigram restaurant, whose base is uniform over the known
tokens and one unknown token.  Customers are seated by Gibbs sweeps over the Chinese
restaurant process: a sweep re-seats all customers given the tables of the sweep
before, and the predictive probabilities of the last sweeps are averaged.  Every customer
is seated at its own odds: the first ``NEAR`` of a dish one by one, later ones by drawing the
next customer that opens a table from its exact law (a ratio of gamma functions).

Spark plan.  Tokens are dealt by a hash of the *word*, as one binary row per (block of
texts, shard): distinct words, and per occurrence its context class and text.  A shard
then knows every customer of its dishes, in all contexts and in the parent.  What
shards must share is only one table total per context (``CONTEXTS`` numbers), summed by
Spark after each sweep.  The dealt rows are written to the checkpoint folder once;
every sweep is one pass over them.  A seat's draw is a hash of the seed, the sweep, the
word, the context and the customer's number, so that scores are the same for any
partitioning, a lost task repeats exactly and no seating is stored.  The last pass turns
the occurrences into sums per text, which meet again by block.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import vec
from quarry.llm.keys import fold
from quarry.session import cut_lineage

CONTEXTS = 4096
SWEEPS = 3
SAMPLES = 2
NEAR = 32
STRENGTH = 1.0
BLOCK = 4 << 20  # bytes of text, and at most BLOCK_TEXTS texts (their numbers have 16 bits)
BLOCK_TEXTS = 50_000
_TRAIN = 1 << 15
_END = np.uint64(0x0E0D0E0D0E0D0E0D)
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---- dealing the tokens ------------------------------------------------------------------

def _token_block(words: vec.Words):
    """(token hashes, context classes, text of each token) with an end mark after each text."""
    n = np.diff(words.woff)
    text = np.repeat(np.arange(len(n)), n + 1)
    end = np.cumsum(n + 1) - 1
    token = np.empty(len(text), np.uint64)
    inner = np.ones(len(text), bool)
    inner[end] = False
    token[end] = _END
    token[inner] = words.hashes
    context = np.zeros(len(text), np.int64)
    context[1:] = 1 + (vec.mix64(token[:-1]) % np.uint64(CONTEXTS - 1)).astype(np.int64)
    context[np.r_[0, end[:-1] + 1] if len(end) else []] = 0
    return token, context, text


def deal(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """Rows (shard, block, ids, held, sizes | words, runs, contexts, texts), by shard.

    A block has one head row (its texts' ids, folds and token counts) and one row per
    shard that holds some of its tokens, sorted by word, context and text.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hasher = vec.Hasher()
        block = TaskContext.get().partitionId() << 32
        for batch in (b.slice(k, BLOCK_TEXTS) for b in batches for k in range(0, b.num_rows, BLOCK_TEXTS)):
            ids, held_all = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            for i, j, words in vec.word_chunks(batch.column(1), hasher, BLOCK):
                token, context, text = _token_block(words)
                held = held_all[i:j].astype(bool)
                shard = (vec.mix64(token ^ np.uint64(77)) % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((text, context, token, shard))
                token, context, text, shard = token[order], context[order], text[order], shard[order]
                marked = (context | np.where(held[text], 0, _TRAIN)).astype("<u2")
                cut = np.searchsorted(shard, np.arange(shards + 1))
                rows = [(block % shards, None, None, None, None)]
                for s in range(shards):
                    a, b = cut[s], cut[s + 1]
                    if a < b:
                        new = np.flatnonzero(np.r_[True, token[a + 1: b] != token[a: b - 1]])
                        runs = np.diff(np.r_[new, b - a])
                        rows.append((s, token[a:b][new].astype("<u8").tobytes(), runs.astype("<u4").tobytes(),
                                     marked[a:b].tobytes(), text[a:b].astype("<u2").tobytes()))
                m = len(rows)
                cols = list(zip(*rows))
                nothing = [None] * (m - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array([block] * m, pa.int64()),
                     pa.array([ids.slice(i, j - i).to_pylist()] + nothing, pa.list_(ids.type)),
                     pa.array([held.tolist()] + nothing, pa.list_(pa.bool_())),
                     pa.array([(np.diff(words.woff) + 1).tolist()] + nothing, pa.list_(pa.int64())),
                     *[pa.array(c, pa.binary()) for c in cols[1:]]], names=names)
                block += 1

    names = ["shard", "block", "ids", "held", "sizes", "words", "runs", "contexts", "texts"]
    schema = f"shard int, block long, ids array<{kind}>, held array<boolean>, sizes array<long>, " \
             "words binary, runs binary, contexts binary, texts binary"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (fold(id_col) == 1).alias("held"))
    return rows.mapInArrow(run, schema).repartition(shards, "shard")


# ---- one shard -----------------------------------------------------------------------------

class Shard:
    """The tokens of one shard: dishes, (dish, context) pairs, and where each occurs.

    A block's tokens are reduced to its distinct pairs before blocks are put together, so that
    a frequent word takes as much room as it has contexts.
    """

    def __init__(self, rows: list[tuple]):
        """rows: (block, words, runs, contexts, texts) binary rows."""
        rows = sorted(rows, key=lambda r: r[0])
        words, of_word, context, train, lens, n = [], [], [], [], [], 0
        self.blocks, self.texts, self.cuts = [r[0] for r in rows], [r[4] for r in rows], [0]
        for _, w, runs, marked, _ in rows:
            words.append(np.frombuffer(w, "<u8"))
            marked = np.frombuffer(marked, "<u2")
            first = np.cumsum(np.frombuffer(runs, "<u4"), dtype=np.int64) - np.frombuffer(runs, "<u4")
            new = np.zeros(len(marked), bool)
            new[first] = True
            new[1:] |= (marked[1:] ^ marked[:-1]) & (_TRAIN - 1) != 0
            begin = np.flatnonzero(new)
            of_word.append((np.searchsorted(first, begin, "right") - 1 + n).astype(np.int32))
            context.append(marked[begin] & (_TRAIN - 1))
            train.append(np.add.reduceat((marked >> 15).astype(np.int32), begin))
            lens.append(np.diff(begin, append=len(marked)).astype(np.int32))
            n += len(first)
            self.cuts.append(self.cuts[-1] + len(begin))

        def joined(parts, kind):
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        self.words, dish = np.unique(joined(words, np.uint64), return_inverse=True)
        pairs, at = np.unique(dish[joined(of_word, np.int32)] * CONTEXTS + joined(context, np.uint16), return_inverse=True)
        self.pair = at.astype(np.int32)  # of each distinct pair of each block
        self.lens = joined(lens, np.int32)  # and how often it occurs there
        self.dish, self.context = (pairs // CONTEXTS).astype(np.int32), (pairs % CONTEXTS).astype(np.int32)
        self.count = np.bincount(self.pair, joined(train, np.int32), len(pairs)).astype(np.int64)
        self.dishes = int(self.dish[-1]) + 1 if len(pairs) else 0
        self.dish_count = np.bincount(self.dish, self.count, self.dishes).astype(np.int64)
        # largest first, so that the pairs with an i-th customer are a prefix
        self.order = np.argsort(-self.count, kind="stable")

    def occurrences(self):
        """(block, text of each token, its pair) block by block."""
        for k, block in enumerate(self.blocks):
            a, b = self.cuts[k], self.cuts[k + 1]
            yield block, np.frombuffer(self.texts[k], "<u2"), np.repeat(self.pair[a:b], self.lens[a:b])

    def first_seating(self):
        """One table for each pair and dish with customers."""
        return (self.count > 0).astype(np.int64), (self.dish_count > 0).astype(np.int64)

    def parent_counts(self, tables: np.ndarray) -> np.ndarray:
        return np.bincount(self.dish, tables, self.dishes)

    def base(self, tables, parent_tables, total: dict) -> np.ndarray:
        """P(dish) in the parent restaurant."""
        floor = (STRENGTH + total["parent_discount"] * total["parent_tables"]) / (total["kinds"] + 1)
        seats = self.parent_counts(tables) - total["parent_discount"] * parent_tables
        return (seats + floor) / (STRENGTH + total["tables"].sum())

    def sweep(self, state, total: dict, seed: int, number: int):
        """Re-seat all customers, given the seating and the shared totals of the sweep before."""
        p = self.base(*state, total)
        open_rate = (STRENGTH + total["discount"] * total["tables"][self.context]) * p[self.dish]
        tables = np.empty_like(self.count)
        keys = draw_keys(self.words[self.dish], self.context, seed, number)
        tables[self.order] = seat(self.count[self.order], open_rate[self.order], total["discount"], keys[self.order])
        customers = self.parent_counts(tables).astype(np.int64)
        order = np.argsort(-customers, kind="stable")
        rate = (STRENGTH + total["parent_discount"] * total["parent_tables"]) / (total["kinds"] + 1)
        parent = np.empty_like(customers)
        keys = draw_keys(self.words, np.full(self.dishes, CONTEXTS), seed, number)
        parent[order] = seat(customers[order], np.full(len(order), rate), total["parent_discount"], keys[order])
        return tables, parent

    def predictive(self, state, total: dict) -> np.ndarray:
        """P(dish | context) for each pair."""
        p = self.base(*state, total)
        tables = state[0]
        shared = total["tables"][self.context]
        return (self.count - total["discount"] * tables
                + (STRENGTH + total["discount"] * shared) * p[self.dish]) / (STRENGTH + total["customers"][self.context])


def draw_keys(words: np.ndarray, contexts: np.ndarray, seed: int, number: int) -> np.ndarray:
    """One 64-bit key for each (word, context), seed and sweep."""
    salt = vec.mix64(np.array([seed], np.uint64) * _STEP + np.uint64(number))
    return vec.mix64(vec.mix64(words ^ salt) + contexts.astype(np.uint64) * _STEP)


def uniform(keys: np.ndarray, customer) -> np.ndarray:
    """The draw of a dish's customer (numbered from 0), in (0, 1)."""
    bits = vec.mix64(keys + np.asarray(customer).astype(np.uint64) * _STEP) >> np.uint64(12)
    return (bits.astype(np.float64) + 0.5) / (1 << 52)


def seat(count: np.ndarray, open_rate: np.ndarray, discount: float, keys: np.ndarray) -> np.ndarray:
    """Tables after seating ``count`` customers (descending) of each dish one after another.

    With i customers at t tables, the next one opens a table with odds
    open_rate : i - discount * t.
    """
    tables = (count > 0).astype(np.int64)
    for i in range(1, NEAR):
        m = int(np.searchsorted(-count, -i, "left"))  # dishes with more than i customers
        if m == 0:
            return tables
        odds = open_rate[:m] / (open_rate[:m] + i - discount * tables[:m])
        tables[:m] += uniform(keys[:m], i) < odds
    at = np.arange(int(np.searchsorted(-count, -NEAR, "left")))
    seated = np.full(len(at), NEAR, np.int64)
    while len(at):
        limit = np.log(uniform(keys[at], seated))
        low = seated - discount * tables[at]
        passed = _log_rise(low, open_rate[at])

        def opened_before(number, rows):
            """Whether a customer before ``number`` opens a table."""
            shift = low[rows] + (number - seated[rows])
            return passed[rows] - _log_rise(shift, open_rate[at[rows]]) < limit[rows]

        rows = np.flatnonzero(opened_before(count[at], slice(None)))
        a, b = seated[rows], count[at[rows]]  # opened before b, not before a
        rate = open_rate[at[rows]]
        with np.errstate(over="ignore"):
            probe = a + (low[rows] + (rate - 1) / 2) * np.expm1(-limit[rows] / rate)  # the law for many customers
        for tried in itertools.count():
            if not (b - a > 1).any():
                break
            probe = np.clip(probe if tried < 4 else (a + b) // 2, a + 1, b - 1).astype(np.int64)
            found = opened_before(probe, rows)
            a, b = np.where(found, a, np.maximum(a, probe)), np.where(found, probe, b)
            probe = np.where(found, b - 1, a + 1)
        at = at[rows]
        tables[at] += 1
        more = b < count[at]
        at, seated = at[more], b[more]
    return tables


def _log_rise(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """log(gamma(x + a) / gamma(x)) for positive x and a."""
    return _log_gamma(x + a) - _log_gamma(x)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, from eight places higher where it is exact to rounding."""
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    y = x + 8
    square = 1 / (y * y)
    series = (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(product)


def _shard_rows(batches):
    """The binary rows of a partition and its head rows."""
    rows, heads = [], []
    for batch in batches:
        block, words, runs, contexts, texts = (batch.column(batch.schema.get_field_index(n)).to_pylist()
                                               for n in ("block", "words", "runs", "contexts", "texts"))
        for k, w in enumerate(words):
            if w is None:
                heads.append(batch.slice(k, 1))
            else:
                rows.append((block[k], w, runs[k], contexts[k], texts[k]))
    return rows, heads


def _state_after(shard: Shard, totals: list[dict], seed: int):
    """The seatings after each of the sweeps whose totals are known."""
    state, out = shard.first_seating(), []
    for k, total in enumerate(totals):
        state = shard.sweep(state, total, seed, k)
        out.append(state)
    return out


def _summed(stored: DataFrame, figures) -> dict[int, tuple]:
    """Sums over all shards of figures(shard) -> (keys, a, b), by key (at most CONTEXTS + a few keys)."""

    def run(batches):
        rows, _ = _shard_rows(batches)
        if rows:
            keys, a, b = figures(Shard(rows))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(a, pa.int64()),
                                              pa.array(b, pa.int64())], names=["k", "a", "b"])

    got = stored.mapInArrow(run, "k int, a long, b long").groupBy("k").agg(F.sum("a"), F.sum("b")).collect()
    return {r[0]: (r[1], r[2]) for r in got}


def _vector(got: dict, col: int) -> np.ndarray:
    out = np.zeros(CONTEXTS)
    for k, v in got.items():
        if k < CONTEXTS:
            out[k] = v[col]
    return out


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones + twos else 0.5


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS,
          samples: int = SAMPLES, seed: int = 0) -> DataFrame:
    """One row per input row: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Learns from the rows whose crc32(id as text) mod 5 is not 1 (a null id counts as
    empty text) and scores all.  ``base_score``: log10 probability under add-half
    unigrams; ``score``: under this model, a probability over the known tokens and one
    unknown token; ``perplexity``: 10 ** (-score / n_tokens).  A null or empty text has
    one token, its end.  Rows with repeated ids are scored each.  Other columns are
    ignored; an empty table gives no rows, and with nothing to learn from every token is
    unknown.
    """
    spark = docs.sparkSession
    shards = -(-3 * int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    kind = docs.schema[id_col].dataType.simpleString()
    stored = cut_lineage(deal(docs, id_col, text_col, shards))

    def counts(shard: Shard):
        tables, parent = shard.first_seating()
        own = shard.parent_counts(tables)
        extra = [(parent.sum(), shard.count.sum()),
                 ((shard.count == 1).sum(), (shard.count == 2).sum()), ((own == 1).sum(), (own == 2).sum())]
        return (list(range(CONTEXTS + 3)),
                np.r_[np.bincount(shard.context, shard.count, CONTEXTS), [x[0] for x in extra]].astype(np.int64),
                np.r_[np.bincount(shard.context, tables, CONTEXTS), [x[1] for x in extra]].astype(np.int64))

    got = _summed(stored, counts)
    kinds, n = got.get(CONTEXTS, (0, 0))
    total = {"customers": _vector(got, 0), "tables": _vector(got, 1), "parent_tables": kinds, "kinds": kinds,
             "discount": _discount(*got.get(CONTEXTS + 1, (0, 0))),
             "parent_discount": _discount(*got.get(CONTEXTS + 2, (0, 0)))}
    totals = [total]
    for _ in range(sweeps):
        def tables_of(shard: Shard, totals=tuple(totals)):
            tables, parent = _state_after(shard, totals, seed)[-1]
            return (list(range(CONTEXTS + 1)),
                    np.r_[np.bincount(shard.context, tables, CONTEXTS), parent.sum()].astype(np.int64),
                    np.zeros(CONTEXTS + 1, np.int64))
        got = _summed(stored, tables_of)
        totals.append(total | {"tables": _vector(got, 0), "parent_tables": got.get(CONTEXTS, (0, 0))[0]})

    def sums(batches):
        rows, heads = _shard_rows(batches)
        for head in heads:
            ids, held, sizes = (head.column(head.schema.get_field_index(c)) for c in ("ids", "held", "sizes"))
            empty = pa.nulls(1, pa.binary())
            yield pa.RecordBatch.from_arrays([head.column(1), ids, held, sizes, empty, empty, empty, empty], names=names)
        if not rows:
            return
        shard = Shard(rows)
        states = _state_after(shard, totals[:-1], seed)
        use = list(zip(states, totals[1:]))[-samples:] or [(shard.first_seating(), totals[0])]
        logp = np.log10(sum(shard.predictive(s, t) for s, t in use) / len(use))
        known = shard.dish_count > 0
        base = np.log10((shard.dish_count + 0.5) / (n + 0.5 * (kinds + 1)))
        for block, text, pair in shard.occurrences():
            own, at = np.unique(text, return_inverse=True)
            dish = shard.dish[pair]
            found = np.bincount(at, known[dish])
            cols = [own.astype("<u2"), found.astype("<u2" if found.max() < 1 << 16 else "<u4"),
                    np.bincount(at, base[dish]).astype("<f8"), np.bincount(at, logp[pair]).astype("<f8")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.nulls(1, ids_type), pa.nulls(1, pa.list_(pa.bool_())),
                 pa.nulls(1, pa.list_(pa.int64())), *[pa.array([c.tobytes()], pa.binary()) for c in cols]], names=names)

    names = ["block", "ids", "held", "sizes", "texts", "known", "base", "logp"]
    ids_type = pa.list_(to_arrow(docs, id_col))
    partial = stored.mapInArrow(sums, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, "
                                      "texts binary, known binary, base binary, logp binary")

    def together(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["texts"] is None)
        m = len(head["ids"])
        known, base, logp = np.zeros(m, np.int64), np.zeros(m), np.zeros(m)
        for r in rows:
            if r["texts"] is not None:
                at = np.frombuffer(r["texts"], "<u2")
                known[at] += np.frombuffer(r["known"], f"<u{len(r['known']) // len(at)}")
                base[at] += np.frombuffer(r["base"], "<f8")
                logp[at] += np.frombuffer(r["logp"], "<f8")
        sizes = np.array(head["sizes"], np.int64)
        return pa.table({id_col: pa.array(head["ids"], ids_type.value_type), "held_out": pa.array(head["held"], pa.bool_()),
                         "n_tokens": sizes, "n_known": known, "train_tokens": np.full(m, n, np.int64),
                         "base_score": base, "score": logp, "perplexity": 10 ** (-logp / sizes)})

    return partial.groupBy("block").applyInArrow(
        together, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                  "base_score double, score double, perplexity double")


def to_arrow(docs: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(docs.schema[col].dataType)
