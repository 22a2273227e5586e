import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import vec

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \n\t\x0b\x1c漢", max_size=30)), max_size=8))
def test_words_match_the_pattern(texts):
    hasher = vec.Hasher()
    got, by_hash = [], {}
    for i, j, w in vec.word_chunks(pa.array(texts, pa.string()), hasher, 16):
        for r in range(j - i):
            a, b = w.woff[r], w.woff[r + 1]
            own = [w.data[s:e].tobytes().decode() for s, e in zip(w.starts[a:b], w.ends[a:b])]
            got.append(own)
            for h, x in zip(w.hashes[a:b].tolist(), own):
                assert by_hash.setdefault(h, fold(x)) == fold(x)
    assert got == [WORD.findall(t or "") for t in texts]
    assert len(by_hash) == len(set(by_hash.values()))


def test_hash_does_not_depend_on_the_segment(monkeypatch):
    text = " ".join(f"word{i % 50}" for i in range(500))
    one = vec.Hasher().words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])).hashes
    monkeypatch.setattr(vec, "SEG", 64)
    two = vec.Hasher().words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])).hashes
    assert (one == two).all() and len(set(one.tolist())) == 50


def test_one_permutation_estimates_jaccard():
    rng = np.random.default_rng(1)
    edges, orders = vec.bin_edges(512), vec.bin_orders(512)
    for n in (20, 300, 5000):
        pool = np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))
        a, b = np.sort(pool[: int(1.25 * n)]), np.sort(pool[int(0.25 * n): int(1.5 * n)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = (vec.one_permutation(a, edges, orders) == vec.one_permutation(b, edges, orders)).mean()
        assert abs(got - true) < 0.15
