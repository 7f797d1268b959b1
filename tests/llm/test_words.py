import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import tokens as T
from larder.llm import words as W

texts = st.lists(st.text(alphabet=st.sampled_from("aAbZ é\t\n\x0b日!'<|>9  "), max_size=40), max_size=8)


def parts(some):
    return W.raw(pa.array(some, pa.large_string()))


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_are_the_runs_between_separators(some):
    body, off = parts(some)
    w = W.Words(body, off)
    data = body.tobytes()
    want = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode()) for t in some]
    assert [data[s:e] for s, e in zip(w.start, w.end, strict=True)] == [x for ws in want for x in ws]
    assert np.diff(w.first).tolist() == [len(x) for x in want]
    flat = [x for ws in want for x in ws]
    h = w.hashes()
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 4))
def test_runs_and_cover(some, width):
    w = W.Words(*parts(some))
    size = np.diff(w.first)
    assert W.run_inside(w.first, width).sum() == np.maximum(size - width + 1, 0).sum()
    h = W.shingles(w.hashes(), width)
    mask = np.zeros(len(h), bool)
    mask[: 1] = True
    got = W.covered(mask, width, len(w.start))
    assert got.sum() == (width if len(h) else 0)


def test_slices_cover_everything():
    _, off = parts(["a" * 10, "", "b" * 30, "c", ""])
    assert list(W.slices(off, 11)) == [(0, 2), (2, 3), (3, 5)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(["<|endoftext|>", "a<|startoftext|>b", "don't", "DON'T 'S", "x!!y12", "É́a", "İ K"])), max_size=6))
def test_ids_equal_the_library(some):
    import public_tokenizers

    encoder = T.shared_encoder(public_tokenizers.path("word_bpe_49k.json"))
    got = []
    for _, count, ids in encoder.ids(pa.array(some, pa.large_string())):
        got += np.split(ids, np.cumsum(count)[:-1])
    assert [g.tolist() for g in got] == [encoder.whole(t).tolist() for t in some]
