import hashlib
import random
import re

import pytest

from larder.llm import substring_dedup as S


def brute(rows, width):
    """The definition, window by window."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    first = {}
    for (i, *_), w in zip(rows, words, strict=True):
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, *_), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def passages(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz")
    shared = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(6)]
    rows = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts += [rng.choice(shared) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(parts), "en"))
    rows += [(200 + i, rows[3][1], "en") for i in range(80)]  # a large group of copies
    rows += [(300, "r s " * 60, "en"), (299, "r s " * 40, "en")]  # one window at many places
    return rows


@pytest.mark.parametrize("block_bytes", [600, 10_000_000])
def test_equals_brute_force(make, block_bytes):
    rows = passages()
    got = S.remove_repeats(make(rows), width=10, anchor=4, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 10)


def test_messy_rows(messy, messy_rows, nothing):
    got = sorted(map(tuple, S.remove_repeats(messy).collect()), key=str)
    assert got == brute(messy_rows, 50)
    assert S.remove_repeats(nothing).count() == 0


def test_anchor_window_must_fit(make):
    rows = [(2, " ".join(map(str, range(50))), "en"), (1, "x " + " ".join(map(str, range(50))), "en")]
    got = {r["doc_id"]: (r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in S.remove_repeats(make(rows)).collect()}
    assert got[2] == (50, hashlib.sha256(b"").hexdigest()) and got[1][0] == 0
