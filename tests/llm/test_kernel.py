import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from turnloom.llm import kernel as K

from .cases import WORD, lower

TEXTS = st.lists(st.none() | st.text(alphabet=st.sampled_from("aAbZ é日\t\n\x0b\x0c\r\x1c\x85 "), max_size=30), max_size=6)


def split(texts, separator=K.SPACE):
    data, offsets, null = K.buffers(pa.array(texts, pa.string()))
    w = K.words(data, offsets, separator)
    found = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)]
    return w, [found[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words(texts):
    assert split(texts)[1] == [WORD.findall(lower(t or "")) for t in texts]


def test_slices_of_arrays():
    a = pa.array(["x y", None, "zz", "q"]).slice(1, 2)
    data, offsets, null = K.buffers(a)
    assert data.tobytes() == b"zz" and offsets.tolist() == [0, 0, 2] and null.tolist() == [True, False]
    assert K.buffers(pa.array([], pa.string()))[1].tolist() == [0]


def test_hashes_depend_on_the_word_alone():
    w, found = split(["ab cd ab", "zz ab", "é " + "pad " * 50 + "ab"])
    h = K.word_hashes(w)
    by = {}
    for word, value in zip([x for f in found for x in f], h.tolist(), strict=True):
        by.setdefault(word, set()).add(value)
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)


def test_row_grams():
    w, found = split(["a b c d", "a b", "", "x a b c d"])
    g, r = K.row_grams(K.word_hashes(w), w.first, 3)
    assert np.bincount(r, minlength=4).tolist() == [2, 1, 0, 3]
    assert set(g[r == 0]) <= set(g[r == 3]) and not set(g[r == 1]) & set(g[r == 0])


def test_sketch_fills_and_estimates():
    rng = random.Random(1)
    sets = [sorted(rng.sample(range(1 << 60), n)) for n in (1, 2, 40, 3000)]
    base = sorted(rng.sample(range(1 << 60), 1000))
    sets += [base, base[:800], []]
    values = K.mix(np.array([x for s in sets for x in s], np.uint64))
    sk = K.sketch(values, np.concatenate([[0], np.cumsum([len(s) for s in sets])]), 128)
    empty = np.iinfo(np.uint64).max
    assert not (sk[:6] == empty).any() and (sk[6] == empty).all()
    assert abs((sk[4] == sk[5]).mean() - 0.8) < 0.15
    assert (sk[0] >> np.uint64(54) < 256).all()


def test_chunks_cover_all_rows():
    offsets = np.array([0, 5, 5, 100, 101, 120])
    assert list(K.chunks(offsets, 10)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
