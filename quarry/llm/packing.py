"""Operator 7: cost-balanced packing of tokenised documents into sequences.

Each task tokenises its rows and packs them window by window, so nothing is
shuffled.  A document's ids are those of the tokenizer plus one end id.  Pieces of
``capacity`` ids fill sequences of their own; of the rest, a window of
``window`` sequences is filled at a time: documents in descending order of their
estimated cost (linear plus quadratic attention cost of their length) go to the
sequence of lowest cost that has room for them; a document that fits nowhere is
cut at the largest remaining room.  What does not fill a window's last sequence
moves on to the next window; the rest at the end of a task goes into sequences
whose lengths are powers of two, so no sequence needs padding.

Tokenising uses the fact that the tokenizer splits at white space and between letters
and punctuation: each distinct piece is encoded once and the ids are gathered
with numpy.  The table of pieces is bounded (about ``CACHE`` pieces, then it starts anew;
that changes nothing but speed).
"""

from __future__ import annotations

import hashlib
import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import vec

CAPACITY = 2048
WINDOW = 256
END_ID = 1
CACHE = 1_000_000


class PieceIds:
    """Token ids of word pieces; each distinct piece is encoded once while it is in the table.

    A piece is a word or, where a letter meets ASCII punctuation (other than ``'``), a part
    of one; the tokenizer splits there too.  Words with ``<`` stay whole.  Tokenizer and table are kept between the
    tasks of a Python worker.
    """

    def __init__(self, tokenizer_json: str):
        self.hasher, self.exact = vec.Hasher(), vec.Hasher(fold=False)
        self.letter = np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self.mark = np.zeros(256, bool)
        self.mark[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<"]] = True
        key = ("pieces", hashlib.sha256(tokenizer_json.encode()).hexdigest())
        self.table = vec.worker_store().setdefault(key, {})
        if not self.table:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer
            tok = Tokenizer.from_str(tokenizer_json)
            ids = tok.encode("a \x01 b", add_special_tokens=False).ids
            # the separator by which many pieces are encoded as one text; None: one by one
            self.table |= {"tok": tok, "sep": ids[1] if len(ids) == 3 else None}
            self._clear()

    def _clear(self):
        self.table |= {"known": np.zeros(0, np.uint64), "slot": np.zeros(0, np.int64),
                       "flat": np.zeros(0, np.uint32), "off": np.zeros(1, np.int64)}

    def pieces(self, words: vec.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, hashes) of the pieces, A-Z lower-cased unless a piece holds ``<``."""
        data = words.data
        after = self.letter[data]
        # two-byte letters of Latin-1 (not the signs at 0xD7 and 0xF7)
        after[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.mark[data[1:]] & after[:-1]
        cut[words.offsets] = False  # texts end there anyway
        breaks = np.flatnonzero(cut)
        special = np.concatenate([[0], np.cumsum(data == 60)])
        if special[-1]:  # words with a ``<`` may hold a special token and stay whole
            odd = special[words.ends] > special[words.starts]
            breaks = breaks[~odd[np.searchsorted(words.starts, breaks, "right") - 1]]
        starts = np.sort(np.concatenate([words.starts, breaks]))
        ends = np.sort(np.concatenate([words.ends, breaks]))
        hashes = self.hasher.spans(data, starts, ends)
        odd = special[ends] > special[starts]
        if odd.any():
            hashes[odd] = self.exact.spans(data, starts[odd], ends[odd]) ^ np.uint64(1)
        return starts, ends, hashes

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, number of each text's)."""
        tok, sep = self.table["tok"], self.table["sep"]
        if sep is None or any("\x01" in t or "<|" in t for t in texts):
            if len(texts) > 1:  # halve until the texts that need their own call stand alone
                a, b = self._encode(texts[: len(texts) // 2]), self._encode(texts[len(texts) // 2:])
                return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
            ids = np.array(tok.encode(texts[0], add_special_tokens=False).ids, np.uint32)
            return ids, np.array([len(ids)])
        joined = [" \x01 ".join(texts[k: k + 512]) for k in range(0, len(texts), 512)]
        ids = np.concatenate([np.array(e.ids + [sep], np.uint32) for e in tok.encode_batch_fast(joined, add_special_tokens=False)])
        return ids[ids != sep], np.diff(np.flatnonzero(ids == sep), prepend=-1) - 1

    def encode(self, words: vec.Words) -> list[np.ndarray]:
        """Ids of each text."""
        starts, ends, hashes = self.pieces(words)
        uniq, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        t = self.table
        if len(t["known"]) > CACHE:
            self._clear()
        at = np.searchsorted(t["known"], uniq)
        new = np.ones(len(uniq), bool)
        inside = at < len(t["known"])
        new[inside] = t["known"][at[inside]] != uniq[inside]
        if new.any():
            data = words.data.tobytes()
            texts = [data[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            ids, lens = self._encode(texts)
            n = len(t["off"]) - 1
            t["flat"] = np.concatenate([t["flat"], ids])
            t["off"] = np.concatenate([t["off"], t["off"][-1] + np.cumsum(lens)])
            t["slot"] = np.insert(t["slot"], at[new], np.arange(n, n + len(lens)))
            t["known"] = np.insert(t["known"], at[new], uniq[new])
        slots = t["slot"][np.searchsorted(t["known"], uniq)][inverse]
        start = t["off"][slots]
        size = t["off"][slots + 1] - start
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = t["flat"][np.repeat(start - (stop - size), size) + np.arange(total)]
        bounds = np.concatenate([[0], stop])[np.searchsorted(starts, words.offsets)]
        return [ids[bounds[i]: bounds[i + 1]] for i in range(len(words))]


def cost(length, linear: float, quadratic: float):
    """Estimated cost of attending over a piece of ``length`` ids."""
    return linear * length + quadratic * length * length


def assign(lengths: list[int], rooms: list[int], linear: float = 1.0,
           quadratic: float = 1 / CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Place pieces into sequences: (piece, start in it, length, sequence, offset in it).

    ``rooms`` are the sequences' capacities and sum to the pieces' total length.
    """
    room = np.array(rooms, np.int64)
    load = np.zeros(len(rooms))
    fill = [0] * len(rooms)
    heap = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(heap)
    out = []
    while heap:
        n, i, start = heapq.heappop(heap)
        n = -n
        s = int(np.where(room >= n, load, np.inf).argmin())
        take = n
        if room[s] < n:  # fits nowhere whole
            s = int(room.argmax())
            take = int(room[s])
            heapq.heappush(heap, (take - n, i, start + take))
        out.append((i, start, take, s, fill[s]))
        fill[s] += take
        room[s] -= take
        load[s] += cost(take, linear, quadratic)
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, window: int = WINDOW, linear: float = 1.0,
         quadratic: float = 1 / CAPACITY) -> DataFrame:
    """One row per piece: (id_col, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` holds the piece as little-endian unsigned 32-bit ids.  Every id of a
    document, its end id included, lies in exactly one piece; a sequence's pieces
    have gapless offsets from 0.  A null or empty text is the end id alone.  A null
    id is passed on; rows that share an id are packed as separate documents.  Other
    columns are ignored, an empty table gives no rows.  The tokenizer file is read on
    the driver and travels with the tasks; it must split at white space, and between letters
    and ASCII punctuation, and must not tell upper from lower case (A-Z).
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        pieces_of = PieceIds(tokenizer_json)
        base = TaskContext.get().partitionId() << 40
        made = 0
        waiting: list[tuple[object, int, int, np.ndarray]] = []  # (id, start, doc tokens, ids), all short of capacity
        held = 0
        out: list[tuple] = []

        def flush(rooms):
            """Fill sequences of the given capacities; return what is left, in arrival order."""
            nonlocal made
            left, spare = [], held - sum(rooms)
            while spare:  # the last arrivals wait for the next window
                key, start, n, ids = waiting.pop()
                keep = max(0, len(ids) - spare)
                left.append((key, start + keep, n, ids[keep:]))
                spare -= len(ids) - keep
                if keep:
                    waiting.append((key, start, n, ids[:keep]))
            for i, at, take, s, offset in assign([len(w[3]) for w in waiting], rooms, linear, quadratic):
                key, start, n, ids = waiting[i]
                out.append((key, start + at, take, ids[at: at + take].tobytes(), n, base + made + s, offset))
            made += len(rooms)
            waiting[:] = left[::-1]
            return sum(len(w[3]) for w in waiting)

        def rows():
            cols = list(zip(*out))
            out.clear()
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, j, words in vec.word_chunks(batch.column(1), pieces_of.hasher, hashed=False):
                keys = batch.column(0).slice(i, j - i).to_pylist()
                for key, ids in zip(keys, pieces_of.encode(words)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)
                    n = len(ids)
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):
                        out.append((key, start, capacity, ids[start: start + capacity].tobytes(), n, base + made, 0))
                        made += 1
                    if whole < n:
                        waiting.append((key, whole, n, ids[whole:]))
                        held += n - whole
                    if held >= window * capacity:
                        held = flush([capacity] * (held // capacity))
                if out:
                    yield rows()
        if held:
            tail = held % capacity
            held = flush([capacity] * (held // capacity) + [1 << b for b in range(tail.bit_length())[::-1] if tail >> b & 1])
            yield rows()

    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
