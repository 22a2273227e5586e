"""Operator 4: toxicity scores from a bidirectional gated recurrent network.

A word's input is its own embedding, those of its beginnings of ``PREFIXES`` bytes, and the
mean embedding of its byte trigrams.  Words and beginnings have rows of their own if they
were seen in at least ``MIN_DOCS`` sample documents; other words are read by their
characters.  Windows of ``WIDTH`` words, every ``STRIDE`` words (so that any run of
WIDTH - STRIDE + 1 words lies whole in one), run through a forward and a backward GRU; attention pools their states into one logit.  A
document's score is the largest window logit, calibrated to a probability.

The network is trained with numpy in one task from a bounded sample of labelled
rows (``SAMPLE`` per class and ``SAMPLE_BYTES`` in all, smallest hashes first).  From each sample document it
takes the windows whose words are most indicative of class 1 and, of class 0, evenly
spread ones too.  Embeddings of words and beginnings start from their smoothed log odds
in the sample.
Scoring is one pass over the documents without a shuffle; only the weights
(at most ``VOCAB`` word rows) travel to the tasks.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import vec

WIDTH, STRIDE = 24, 8
SAMPLE_BYTES = 64 << 20  # of the label sample's texts
SAMPLE = 2000
MIN_DOCS = 2
VOCAB = 50_000
CHARS = 4096
PREFIXES = (4, 5, 6, 8, 10)
EMB, HID = 8, 8
ODDS_DOCS = 6


# ---- text to inputs ----------------------------------------------------------------------

def trigram_rows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram table rows of words, flat, with each word's count (the word framed by marks)."""
    size = ends - starts
    total = int(size.sum())
    first = np.cumsum(size) - size
    at = np.repeat(starts - first, size) + np.arange(total)
    low = np.arange(256, dtype=np.uint64)
    low[65:91] += 32
    mid = low[data[at]] if total else np.zeros(0, np.uint64)
    left = np.empty_like(mid)
    right = np.empty_like(mid)
    left[1:], right[:-1] = mid[:-1], mid[1:]
    left[first], right[first + size - 1] = 1, 2
    code = vec.mix64((left << np.uint64(16)) | (mid << np.uint64(8)) | right)
    return (code % np.uint64(CHARS)).astype(np.int64), size


def prefix_hashes(hasher: vec.Hasher, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the beginnings of words (ascending), [words, len(PREFIXES)]; 0 where a word is not longer."""
    out = np.zeros((len(starts), len(PREFIXES)), np.uint64)
    for k, size in enumerate(PREFIXES):
        long = ends - starts > size
        out[long, k] = vec.mix64(hasher.spans(data, starts[long], starts[long] + size) + np.uint64(size)) | np.uint64(1)
    return out


def windows(woff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each window, word positions [n, WIDTH], mask) of all overlapping windows.

    A text has a window at every multiple of STRIDE until its end is covered; the
    last one is moved back to end with the text.  A text of fewer words has one
    window, padded; a text without words has one window that is all padding.
    """
    n = np.diff(woff)
    count = np.maximum(1, -(-(n - WIDTH) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(k * STRIDE, np.maximum(n[text] - WIDTH, 0))
    inner = start[:, None] + np.arange(WIDTH)
    mask = inner < n[text][:, None]
    return text, np.where(mask, woff[text][:, None] + inner, 0), mask


# ---- the network -------------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def init_params(vocab: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """``vocab``: rows for known words and beginnings; row 0 stands for unknown ones."""
    def draw(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)
    p = {"word": draw(vocab + 1, EMB, scale=0.1), "char": draw(CHARS, EMB, scale=0.1),
         "aw": draw(2 * HID, HID, scale=0.3), "av": draw(HID, scale=0.3),
         "ow": draw(2 * HID, scale=0.3), "ob": np.zeros(1, np.float32)}
    for d in "fb":
        p |= {f"w{d}": draw(EMB, 3 * HID, scale=0.35), f"u{d}": draw(HID, 3 * HID, scale=0.35),
              f"c{d}": np.zeros(3 * HID, np.float32)}
    return p


def gru(proj: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool = False):
    """States [n, steps, HID] of one direction over input projections [n, steps, 3 * HID]."""
    n, steps, _ = proj.shape
    h = np.zeros((n, HID), np.float32)
    out = np.empty((n, steps, HID), np.float32)
    saved = []
    for t in range(steps):
        g = h @ u
        zr = _sigmoid(proj[:, t, : 2 * HID] + g[:, : 2 * HID])
        z, r = zr[:, :HID], zr[:, HID:]
        c = np.tanh(proj[:, t, 2 * HID:] + r * g[:, 2 * HID:])
        new = np.where(mask[:, t, None], c + z * (h - c), h)
        if keep:
            saved.append((h, z, r, c, g[:, 2 * HID:]))
        h = new
        out[:, t] = h
    return out, saved


def gru_back(dout, mask, u, saved):
    """Gradients (projections, u) from the gradients of all states."""
    n, steps, _ = dout.shape
    dproj = np.zeros((n, steps, 3 * HID), np.float32)
    du = np.zeros_like(u)
    dh = np.zeros((n, HID), np.float32)
    for t in reversed(range(steps)):
        h, z, r, c, gn = saved[t]
        dh = dh + dout[:, t]
        live = dh * mask[:, t, None]
        dz = live * (h - c) * z * (1 - z)
        dc = live * (1 - z) * (1 - c * c)
        dr = dc * gn * r * (1 - r)
        dg = np.concatenate([dz, dr, dc * r], 1)
        dproj[:, t] = np.concatenate([dz, dr, dc], 1)
        du += h.T @ dg
        dh = np.where(mask[:, t, None], live * z, dh) + dg @ u.T
    return dproj, du


def forward(p, x_proj, mask, keep=False):
    """Logits of windows; ``x_proj``: projections of both directions [n, steps, 3 * HID]."""
    hf, sf = gru(x_proj[0], mask, p["uf"], keep)
    hb, sb = gru(x_proj[1][:, ::-1], mask[:, ::-1], p["ub"], keep)
    h = np.concatenate([hf, hb[:, ::-1]], 2)
    a = np.tanh(h @ p["aw"])
    e = np.where(mask, a @ p["av"], -1e9)
    e = np.exp(e - e.max(1, keepdims=True)) * mask
    att = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
    pooled = (att[:, :, None] * h).sum(1)
    logit = pooled @ p["ow"] + p["ob"][0]
    return logit, (sf, sb, h, a, att, pooled)


def gru_states(proj: np.ndarray, at: np.ndarray, mask: np.ndarray, u: np.ndarray, backward: bool) -> np.ndarray:
    """States [steps, HID, n] of one direction, without what training keeps.

    ``proj``: projections [words, 3 * HID]; ``at``, ``mask``: words and mask [steps, n].  Windows lie along the last,
    contiguous axis of all states.  Update and reset gates come with halved weights: sigmoid(x) = (1 + tanh(x / 2)) / 2.
    """
    steps, n = at.shape
    out = np.empty((steps, HID, n), np.float32)
    h = np.zeros((HID, n), np.float32)
    for t in reversed(range(steps)) if backward else range(steps):
        x = np.ascontiguousarray(proj.take(at[t], axis=0).T)
        g = u @ h
        gates = x[: 2 * HID]
        gates += g[: 2 * HID]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        c = g[2 * HID:]
        c *= gates[HID:]
        c += x[2 * HID:]
        np.tanh(c, out=c)
        new = out[t]
        np.subtract(h, c, out=new)
        new *= gates[:HID]
        new += c
        if not mask[t].all():
            np.copyto(new, h, where=~mask[t])
        h = new
    return out


def window_logits(p, proj: list[np.ndarray], at: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows for scoring, equal to those of ``forward``; ``proj``: both directions [words, 3 * HID], gates halved."""
    at, mask = np.ascontiguousarray(at.T), np.ascontiguousarray(mask.T)
    half = np.repeat(np.array([0.5, 0.5, 1], np.float32), HID)[:, None]
    hf, hb = (gru_states(proj[k], at, mask, half * p[u].T, k == 1) for k, u in enumerate(("uf", "ub")))
    steps, n = at.shape
    e, value = np.empty((steps, n), np.float32), np.empty((steps, n), np.float32)
    for t in range(steps):
        a = p["aw"][:HID].T @ hf[t]
        a += p["aw"][HID:].T @ hb[t]
        e[t] = p["av"] @ np.tanh(a, out=a)
        value[t] = p["ow"][:HID] @ hf[t] + p["ow"][HID:] @ hb[t]
    e = np.where(mask, e, np.float32(-1e9))
    e = np.exp(e - e.max(0)) * mask
    return (e * value).sum(0) / np.maximum(e.sum(0), 1e-9) + p["ob"][0]


def gradients(p, x, mask, y, weight):
    """Mean weighted log loss of windows and its gradients; ``x``: inputs [n, steps, EMB]."""
    proj = [x @ p["wf"] + p["cf"], x @ p["wb"] + p["cb"]]
    logit, (sf, sb, h, a, att, pooled) = forward(p, proj, mask, keep=True)
    prob = _sigmoid(logit)
    loss = -(weight * (y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9))).sum() / weight.sum()
    d = (weight * (prob - y) / weight.sum()).astype(np.float32)
    g = {"ow": pooled.T @ d, "ob": d.sum(keepdims=True)}
    dp = d[:, None] * p["ow"]
    datt = np.einsum("nh,nth->nt", dp, h)
    de = att * (datt - (att * datt).sum(1, keepdims=True))
    dh = att[:, :, None] * dp[:, None]
    g["av"] = np.einsum("nt,nth->h", de, a)
    da = de[:, :, None] * p["av"] * (1 - a * a)
    g["aw"] = np.einsum("nti,ntj->ij", h, da)
    dh = dh + da @ p["aw"].T
    df, g["uf"] = gru_back(dh[:, :, :HID], mask, p["uf"], sf)
    db, g["ub"] = gru_back(dh[:, ::-1, HID:], mask[:, ::-1], p["ub"], sb)
    db = db[:, ::-1]
    flat = x.reshape(-1, EMB)
    g |= {"wf": flat.T @ df.reshape(-1, 3 * HID), "wb": flat.T @ db.reshape(-1, 3 * HID),
          "cf": df.sum((0, 1)), "cb": db.sum((0, 1))}
    return loss, g, df @ p["wf"].T + db @ p["wb"].T


def adam(p, grads, state, step, rate=0.01):
    """One Adam step in place."""
    for k, g in grads.items():
        m, v = state.setdefault(k, (np.zeros_like(p[k]), np.zeros_like(p[k])))
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


# ---- the model ---------------------------------------------------------------------------

class Model:
    """Weights, the sorted hashes of known words and beginnings (rows 1..), and the calibration."""

    def __init__(self, known, params, scale=1.0, shift=0.0):
        self.known, self.params, self.scale, self.shift = known, params, scale, shift

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Embedding rows; 0 for unknown hashes and for 0."""
        at = np.searchsorted(self.known, hashes)
        at = np.minimum(at, max(len(self.known) - 1, 0))
        hit = self.known[at] == hashes if len(self.known) else np.zeros(hashes.shape, bool)
        return np.where(hit & (hashes != 0), at + 1, 0)

    def word_rows(self, words: vec.Words, at: np.ndarray, hasher: vec.Hasher) -> np.ndarray:
        """Rows of words at ascending places: the word's, then those of its beginnings."""
        starts = prefix_hashes(hasher, words.data, words.starts[at], words.ends[at])
        return self.rows(np.concatenate([words.hashes[at][:, None], starts], 1))

    def inputs(self, words: vec.Words, at: np.ndarray, hasher: vec.Hasher) -> np.ndarray:
        """Input vectors of the words at ascending places."""
        tri, size = trigram_rows(words.data, words.starts[at], words.ends[at])
        x = self.params["word"][self.word_rows(words, at, hasher)].sum(1)
        if len(at):
            x += np.add.reduceat(self.params["char"][tri], np.cumsum(size) - size, axis=0) / size[:, None]
        return x

    def text_logits(self, words: vec.Words, hasher: vec.Hasher, batch: int = 2048) -> np.ndarray:
        """Largest window logit of each text."""
        text, pos, mask = windows(words.woff)
        _, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        p = self.params
        x = np.zeros((max(len(first), 1), EMB), np.float32)
        order = np.argsort(first)
        x[order] = self.inputs(words, first[order], hasher)
        inverse = inverse if len(first) else np.zeros(1, np.int64)
        half = np.repeat(np.array([0.5, 0.5, 1], np.float32), HID)
        proj = [(x @ p["w" + d] + p["c" + d]) * half for d in "fb"]
        best = np.full(len(words), -np.inf)
        whole = np.argsort(~mask[:, -1], kind="stable")  # padded windows last
        text, pos, mask = text[whole], pos[whole], mask[whole]
        for i in range(0, len(text), batch):
            logit = window_logits(p, proj, inverse[pos[i: i + batch]], mask[i: i + batch])
            np.maximum.at(best, text[i: i + batch], logit)
        return best

    def score(self, words: vec.Words, hasher: vec.Hasher) -> np.ndarray:
        return _sigmoid(self.scale * self.text_logits(words, hasher) + self.shift).astype(np.float64)


def calibrate(logit: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Scale and shift of a weighted logistic fit with a small ridge (Newton steps)."""
    mean, dev = float(logit.mean()), float(logit.std()) + 1e-6
    x = np.stack([(logit - mean) / dev, np.ones_like(logit)], 1)
    b = np.zeros(2)
    for _ in range(rounds):
        q = _sigmoid(x @ b)
        step = np.linalg.solve((x.T * (weight * q * (1 - q))) @ x + 0.1 * np.eye(2), x.T @ (weight * (q - y)) + 0.1 * b)
        b -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(b[0] / dev), float(b[1] - b[0] * mean / dev)


def train(texts: list[str], labels: list[int], class_weight: tuple = (1.0, 1.0), epochs: int = 8, batch: int = 128,
          seed: int = 0) -> Model:
    """Fit the network on sample documents.

    Every fourth document of each class is first left out, to calibrate the logits; the final
    network is then fitted to all.  ``class_weight``: how many documents one of each class
    stands for, in the calibration.  With one class only, all scores are the smoothed
    share of class 1.
    """
    hasher = vec.Hasher()
    y_doc = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        model = Model(np.zeros(0, np.uint64), init_params(0, np.random.default_rng(seed)), scale=0.0)
        share = (sum(labels) + 0.5) / (len(labels) + 1) if labels else 1e-3
        model.shift = float(np.log(share / (1 - share)))
        return model
    parts = [w for i, j, w in vec.word_chunks(pa.array(texts, pa.string()), hasher)]
    everything = np.ones(len(texts), bool)
    learn = everything.copy()
    for y in (0, 1):
        learn[np.flatnonzero(y_doc == y)[3::4]] = False
    rest = ~learn
    if len(set(y_doc[rest].tolist())) < 2:
        learn = rest = everything
    model = fit(parts, y_doc, learn, hasher, epochs, batch, seed)
    logit = np.concatenate([model.text_logits(w, hasher) for w in parts])
    y = y_doc[rest].astype(np.float64)
    scale, shift = calibrate(logit[rest], y, np.where(y == 1, class_weight[1], class_weight[0]))
    model = fit(parts, y_doc, everything, hasher, epochs, batch, seed)
    model.scale, model.shift = scale, shift
    return model


def fit(parts: list[vec.Words], y_doc: np.ndarray, learn: np.ndarray, hasher: vec.Hasher, epochs: int, batch: int,
        seed: int) -> Model:
    """The network after training on the documents marked in ``learn``."""
    rng = np.random.default_rng(seed)
    # documents of each class by word and beginning, for the log odds
    seen: list[list[np.ndarray]] = [[], []]
    base = 0
    for w in parts:
        starts = prefix_hashes(hasher, w.data, w.starts, w.ends)
        for r in np.flatnonzero(learn[base: base + len(w)]):
            a, b = w.woff[r], w.woff[r + 1]
            seen[int(y_doc[base + r])].append(np.unique(np.concatenate([w.hashes[a:b], starts[a:b].ravel()])))
        base += len(w)
    del starts
    counts = []
    for y in (0, 1):
        counts.append(np.unique(np.concatenate(seen[y] or [np.zeros(0, np.uint64)]), return_counts=True))
        seen[y].clear()
    uniq = np.union1d(counts[0][0], counts[1][0])
    uniq = uniq[uniq != 0]
    neg, pos = np.zeros(len(uniq), np.int32), np.zeros(len(uniq), np.int32)
    for into, (keys, n) in zip((neg, pos), counts):
        into[np.searchsorted(uniq, keys[keys != 0])] = n[keys != 0]
    del counts
    freq = neg + pos
    # log odds over those of the sample, as if seen in ODDS_DOCS more documents of the sample's share
    share = y_doc[learn].mean()
    odds = np.log((pos + ODDS_DOCS * share) / (neg + ODDS_DOCS * (1 - share))) - np.log(share / (1 - share))
    use = np.flatnonzero(freq >= MIN_DOCS)
    if len(use) > VOCAB:
        use = use[np.argsort(-freq[use], kind="stable")[:VOCAB]]
        use.sort()
    known, odds = uniq[use], odds[use]
    params = init_params(len(known), rng)
    params["word"] *= 0.1
    params["word"][1:, 0] = np.clip(odds, -2, 4) / 2
    params["word"][0] = 0
    model = Model(known, params)
    # training windows: the most indicative ones and evenly spread ones of every document
    rows, chars, sizes, masks, ys = [], [], [], [], []
    base = 0
    for w in parts:
        text, at, mask = windows(w.woff)
        word = model.word_rows(w, np.arange(len(w.hashes)), hasher)
        value = np.concatenate([[0], np.clip(odds, 0, 3)])[word].max(1) if len(word) else np.zeros(1)
        gain = (value[at] * mask).sum(1) if len(word) else np.zeros(len(text))
        order = np.lexsort((-gain, text))
        cut = np.searchsorted(text[order], np.arange(len(w) + 1))
        for r in np.flatnonzero(learn[base: base + len(w)]):
            own = order[cut[r]: cut[r + 1]]
            label = y_doc[base + r]
            pick = own[:1] if label else np.concatenate([own[:2], own[2:][:: max(1, len(own) // 3)][:3]])
            for i in pick:
                live = at[i][mask[i]]
                t, s = trigram_rows(w.data, w.starts[live], w.ends[live])
                rows.append(np.where(mask[i][:, None], word[at[i]], 0) if len(word)
                            else np.zeros((WIDTH, 1 + len(PREFIXES)), np.int64))
                chars.append(t)
                sizes.append(s)
                masks.append(mask[i])
                ys.append(label)
        base += len(w)
    rows, masks, ys = np.array(rows), np.array(masks), np.array(ys, np.float32)
    weight = np.where(ys == 1, 0.5 / max(ys.sum(), 1), 0.5 / max((1 - ys).sum(), 1)).astype(np.float32) * len(ys)
    state: dict = {}
    step = 0
    for _ in range(epochs):
        for idx in np.array_split(rng.permutation(len(ys)), max(1, len(ys) // batch)):
            step += 1
            size = np.concatenate([sizes[i] for i in idx])
            flat = np.concatenate([chars[i] for i in idx])
            m = masks[idx]
            owner = np.repeat(np.flatnonzero(m.reshape(-1)), size)
            inv_size = np.repeat(1 / np.maximum(size, 1), size).astype(np.float32)[:, None]
            own = rows[idx]
            x = params["word"][own].sum(2).reshape(-1, EMB)
            np.add.at(x, owner, params["char"][flat] * inv_size)
            _, g, dx = gradients(params, x.reshape(len(idx), WIDTH, EMB), m, ys[idx], weight[idx])
            dx = (dx * m[:, :, None]).reshape(-1, EMB)
            g["word"] = np.zeros_like(params["word"])
            np.add.at(g["word"], own.reshape(len(dx), -1).T, dx)
            g["word"][0] = 0
            g["char"] = np.zeros_like(params["char"])
            np.add.at(g["char"], flat, dx[owner] * inv_size)
            adam(params, g, state, step)
    return model


def sample_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                per_class: int = SAMPLE) -> tuple[DataFrame, tuple[float, float]]:
    """(_t, _y, _h, _id) and class weights (labelled rows per sample row) of at most ``per_class`` rows of each class, smallest hashes of the id first.

    Labels that are null or neither 0 nor 1, null ids and repeated label rows are left
    out.  The picked ids are at most 2 * per_class rows, so the join broadcasts them.
    """
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y")) \
        .withColumn("_h", F.xxhash64(F.col("_id")))
    totals = {r["_y"]: r["count"] for r in marked.groupBy("_y").count().collect()}
    picked = None
    for y in (0, 1):
        # hashes up to a bound that leaves a few more rows than wanted, so that the sort is small
        share = min(1.0, (per_class + 10 * per_class**0.5 + 10) / max(1, totals.get(y, 0)))
        low = marked.where((F.col("_y") == y) & (F.col("_h") <= int(min(2**63 - 1, -(2**63) + share * 2**64))))
        part = low.orderBy("_h", "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_t")).join(
        F.broadcast(picked), "_id").select("_t", "_y", "_h", "_id")
    return rows, tuple(totals.get(y, 0) / max(1, min(per_class, totals.get(y, 0))) for y in (0, 1))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
           per_class: int = SAMPLE) -> tuple[list[str], list[int], tuple[float, float]]:
    """The rows of ``sample_rows`` as lists of texts and labels, and the class weights."""
    rows, weight = sample_rows(docs, labels, id_col, text_col, label_col, per_class)
    got = rows.orderBy("_h", "_id", "_t").collect()
    return [r["_t"] for r in got], [r["_y"] for r in got], weight


def train_on(rows: DataFrame, weight: tuple[float, float], most_bytes: int = SAMPLE_BYTES) -> Model:
    """``train`` on the rows of ``sample_rows`` inside one task: the texts never reach the driver, the weights do.

    Texts are taken in the sample's order while they have ``most_bytes`` bytes in all; others are left out of the sample.
    """

    def run(batches):
        texts, labels, size = [], [], 0
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if size + len(t) * 4 <= most_bytes or size + len(t.encode()) <= most_bytes:
                    size += len(t.encode())
                    texts.append(t)
                    labels.append(y)
        m = train(texts, labels, weight)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((m.known, m.params, m.scale, m.shift))], pa.binary())], names=["model"])

    one = rows.repartition(1).sortWithinPartitions("_h", "_id", "_t").select("_t", "_y")
    got = one.mapInArrow(run, "model binary").first()
    return Model(*pickle.loads(got["model"])) if got else train([], [], weight)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for every row; a null text counts as empty.  One pass, no shuffle.

    Rows with null or repeated ids are each scored; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hasher = vec.Hasher()
        for batch in batches:
            for i, j, words in vec.word_chunks(batch.column(1), hasher):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(model.score(words, hasher))],
                                                 names=[id_col, "score"])

    return docs.select(F.col(id_col), F.col(text_col).alias("_t")).mapInArrow(run, f"`{id_col}` {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score below ``limit``, all columns unchanged, in one pass."""
    at = docs.columns.index(text_col)

    def run(batches):
        hasher = vec.Hasher()
        for batch in batches:
            keep = [model.score(words, hasher) < limit for _, _, words in vec.word_chunks(batch.column(at), hasher)]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
