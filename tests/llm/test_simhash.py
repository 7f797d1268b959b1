import re

import numpy as np
import pytest
import xxhash

from larder.llm import simhash
from larder.llm.words import U64


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in hashes) > len(hashes))


def classes(codes):
    """For each code the first place of its component."""
    codes, parent = np.array(codes, U64), list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1 :]) <= 2):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            parent[b] = a
    return [find(i) for i in range(len(codes))]


def clustered(rng, n):
    """Codes around a few centres, one of them with a dense ball, and some anywhere."""
    centres = rng.integers(0, 1 << 63, 6, U64)
    picked = centres[rng.integers(0, 6, n)]
    picked[: n // 3] = centres[0]
    for _ in range(3):
        picked = picked ^ np.where(rng.random(n) < 0.8, U64(1) << rng.integers(0, 64, n, U64), U64(0))
    picked[-n // 10 :] = rng.integers(0, 1 << 63, n // 10, U64) * U64(2)
    return np.unique(picked)


def test_gray_order(spark):
    codes = [0, 1, 3, 2, 6, 7, 5, 4, 12, 1 << 63, (1 << 63) | (1 << 62)]
    rank = simhash.gray_rank(np.array(codes, U64))
    assert rank[:8].tolist() == list(range(8)) and (rank ^ (rank >> U64(1))).tolist() == codes
    df = spark.createDataFrame([(int(np.array(c, U64).view(np.int64)),) for c in codes], "fp long")
    ordered = [r.fp for r in df.orderBy(simhash.gray_order(df.fp)).collect()]
    assert [int(np.array(f).view(U64)) for f in ordered] == [codes[i] for i in np.argsort(rank)]


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 65, 3000])
def test_search_finds_all_and_prunes(n):
    codes = clustered(np.random.default_rng(n), max(n, 10))[:n]
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(codes, codes)
    got = {(int(a), int(b)) for q, item in index.search(codes, np.arange(n)) for a, b in zip(q, item, strict=True)}
    want = {(i, i + 1 + int(j)) for i in range(n) for j in np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1 :]) <= 2)}
    assert got == want
    if n == 3000:
        assert index.visited < n * n / 4  # all pairs would be half of n * n


def test_upper_bits_are_compared_once():
    codes = np.sort(np.random.default_rng(1).integers(0, 1 << 20, 500, U64))
    index = simhash.GrayIndex(codes, codes)
    below = np.arange(len(codes))
    seen = np.zeros(len(codes), U64)
    for _, mask in index.nodes:
        assert not (seen & mask[below]).any()
        seen |= mask[below]
        below = below // simhash.FAN
    assert (seen == ~U64(0)).all()


@pytest.mark.parametrize(("ranges", "visitors"), [(1, 1 << 20), (20, 1 << 20), (20, 50)])
def test_links_over_ranges_and_copies(spark, ranges, visitors):
    codes = clustered(np.random.default_rng(5), 1500)
    nodes = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    edges = simhash.links(nodes, least_ranges=ranges, visitors=visitors).collect()
    place = {int(c): i for i, c in enumerate(codes.view(np.int64))}
    assert all(a != b for a, b in edges)
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(place[a]), find(place[b])))
        root[y] = x
    assert [find(i) for i in range(len(codes))] == classes(codes)


def test_texts(make, messy_rows):
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{k}" for k in rng.integers(0, 400, 300)) for _ in range(4)]
    rows = messy_rows + [(100 + i, base[i % 4] + (f" tail{i}" if i % 3 else ""), "en") for i in range(60)] + [(200 + i, "A b\tC", "en") for i in range(50)]
    df = make(rows)
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    codes = [fingerprint(t) for _, t, _ in rows]
    least = {}
    for c, (d, _, _) in zip(classes(codes), rows, strict=True):
        least[c] = min((x for x in (least.get(c), d) if x is not None), default=None)
    want = [(d, f"{f:016x}", least[c]) for (d, _, _), f, c in zip(rows, codes, classes(codes), strict=True)]
    assert got == sorted(want, key=str)


def test_nothing(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
