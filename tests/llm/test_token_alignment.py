import collections
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from larder.llm import token_alignment as ta
from larder.llm.words import raw

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    return ta.Encoders(A, B)


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def byte_ends(tokens):
    return np.cumsum([len(t) for t in tokens]).tolist()


def groups_of(text, encoders, library):
    """[(ids of A, ids of B)] of a text, by the libraries on the whole text and sets of ends."""
    if not text:
        return []
    a, b = library[0].encode(" " + text, add_special_tokens=False).ids, library[1].encode(text)
    tokens = [[encoders.bytes_a[i] for i in a], [encoders.bytes_b[i] for i in b]]
    if any(b"".join(t) != (" " + text).encode() for t in tokens):
        return []
    ends = [byte_ends(t) for t in tokens]
    out, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        ni, nj = ends[0].index(e) + 1, ends[1].index(e) + 1
        out.append((a[i:ni], b[j:nj]))
        i, j = ni, nj
    return out


def by_hand(rows, encoders, library):
    groups = [groups_of(t, encoders, library) for _, t in rows]
    links = [[(x, y) for p, q in g for x in p for y in q] for g in groups]
    count = collections.Counter(pair for one in links for pair in set(one))
    highest = collections.defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for (d, _), g, one in zip(rows, groups, links, strict=True):
        shown = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        out.append((d, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(one), sum(count[x] == highest[x[0]] for x in one),
                    sum(count[x] for x in one), hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


ODD = [" \n\nword  x", "a  b \n c", "▁x", "", None, " ", " a ", "\n", "x\r\n y\r z", "été  à  la　 mer", "tab\t\tx \n\n z",
       "日本語テキスト" * 50, "<|endoftext|> <s> <0x41>", "'s it's I'LL", "x" * 5000, "\x00\x1c \x85 \n", "a​ b   c   d",
       "1 22 333 4444\n55555", "  \n  lead", "q" * 3000 + "é" * 2000, "abc\n", "abc \n ", "\U0001f600" * 40, "a \n\nb"]


def run(df, **more):
    return sorted(map(tuple, ta.align(df, A, B, **more).collect()), key=str)


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 12, ta.CHUNK_BYTES])
def test_odd_texts(spark, encoders, library, chunk_bytes):
    rows = list(enumerate(ODD * 2))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, chunk_bytes=chunk_bytes) == by_hand(rows, encoders, library)


def test_messy_rows(make, messy_rows, encoders, library):
    rows = [r for r in messy_rows if r[0] not in (6, 7)] + [(6, "one two " * 30_000, "en")]
    assert run(make(rows)) == by_hand([(d, t) for d, t, _ in rows], encoders, library)


def test_nothing(nothing):
    assert run(nothing) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab .,'\n\t\r12é  　\u0085▁中<|>\x00"), max_size=40), min_size=1, max_size=4))
def test_pieces_are_the_whole_text(texts):
    encoders = test_pieces_are_the_whole_text.__dict__.setdefault("encoders", ta.Encoders(A, B))
    a = encoders.a
    (ids_a, n_a), (ids_b, n_b) = encoders.ids(*raw(pa.array(texts, pa.large_string())))
    at = bt = 0
    for text, x, y in zip(texts, n_a, n_b, strict=True):
        whole = encoders.b.encode(text) if text else []
        same = b"".join(encoders.bytes_b[i] for i in whole) == (" " + text).encode()
        assert ids_a[at : at + x].tolist() == (a.encode(" " + text, add_special_tokens=False).ids if text and same else [])
        assert ids_b[bt : bt + y].tolist() == (whole if text and same else [])
        at, bt = at + x, bt + y


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 200), min_size=1), st.lists(st.integers(0, 200)), st.integers(0, 1000))
def test_gallop_from_anywhere(ends, wanted, seed):
    ends, wanted = np.array(sorted(ends)), np.array(wanted, np.int64)
    start = np.random.default_rng(seed).integers(0, len(ends), len(wanted))
    assert ta.gallop(ends, wanted, start).tolist() == np.searchsorted(ends, wanted).tolist()


def test_large_groups_are_counted_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 9, 500), rng.integers(0, 7, 400)]
    cuts = [np.array([0, 120, 499]), np.array([3, 300, 399])]
    size = [np.diff(c, prepend=-1) for c in cuts]
    start = [c - s + 1 for c, s in zip(cuts, size, strict=True)]
    text = np.array([0, 0, 2])
    few = ta.linked_pairs(ids, start, size, text)
    monkeypatch.setattr(ta, "SPELT_OUT", 1 << 40)
    want = ta.linked_pairs(ids, start, size, text)
    assert all((x == y).all() for x, y in zip(few, want, strict=True)) and want[1].sum() == (size[0] * size[1]).sum()
