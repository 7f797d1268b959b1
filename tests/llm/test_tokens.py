import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import fingerprint as D
from larder.llm import packing as P
from larder.llm import sharding as M
from larder.llm import token_files as T
from larder.llm.tokens import Encoder


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---- token files ---------------------------------------------------------

@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=300), st.randoms())
def test_select_gives_back_any_sequence(values, rnd):
    values = np.array(sorted(values), np.int64)
    s = T.Sequence(memoryview(T.encode_sequence(values)))
    assert s.n == len(values) and (s.select(np.arange(len(values))) == values).all()
    some = np.array(sorted(rnd.sample(range(len(values)), len(values) // 2)), np.int64)
    assert (s.select(some) == values[some]).all()


def test_near_minimal_space():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 2000, 50_000))
    assert len(T.encode_sequence(ends)) * 8 / len(ends) < 2.5 + np.log2(ends[-1] / len(ends))


def test_block_round_trip():
    ids = np.array([70_000, 1, 2, 1], np.uint32)
    b = T.Block(T.encode_block([None, -5, -5], np.array([2, 0, 2]), ids))
    assert b.doc_ids() == [None, -5, -5] and [v.tolist() for v in b.bounds([0, 2])] == [[0, 2], [2, 4]] and b.ids.tolist() == ids.tolist()


@pytest.mark.parametrize("block_tokens", [50, 1 << 21])
def test_files(spark, messy, messy_rows, nothing, vocabulary, block_tokens):
    encoder = Encoder(vocabulary)
    ordered = sorted(messy_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, at = [], 0
    for i, t, _ in ordered:
        ids = [*encoder.whole(t or "").tolist(), T.END_ID]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    got = T.read(T.write(messy, vocabulary, block_tokens=block_tokens)).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    assert T.read(T.write(nothing, vocabulary)).count() == 0


# ---- packing -------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_seats_every_piece_once(histogram):
    rows = P.plan(histogram, 40)
    used, seats = dict.fromkeys(histogram, 0), set()
    for x, first, ranks, copies, sequence, offset in rows:
        assert first == used[x]
        used[x] += ranks
        for r in range(ranks):
            for place in range(x):
                seats.add((sequence + r // copies, offset + r % copies * x + place))
    assert used == histogram and len(seats) == sum(k * v for k, v in histogram.items())
    for s in {s for s, _ in seats}:
        places = {p for q, p in seats if q == s}
        assert places == set(range(len(places))) and len(places) <= 40


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=6))
def test_fullest_is_the_best_with_the_longest(counts):
    chosen = P.fullest(counts, 30)
    items = [x for x, n in counts.items() for _ in range(n)]
    top = max(items)
    items.remove(top)
    sums = {top}
    for x in items:
        sums |= {s + x for s in sums if s + x <= 30}
    assert sum(x * k for x, k in chosen.items()) == max(sums) and all(k <= counts[x] for x, k in chosen.items())


def test_pack(messy, messy_rows, nothing, vocabulary):
    encoder = Encoder(vocabulary)
    want = []
    for i, t, _ in messy_rows:
        ids = [*encoder.whole(t or "").tolist(), P.END_ID]
        want += [(i, k, s, len(ids[s : s + 512]), crc(ids[s : s + 512])) for k, s in enumerate(range(0, len(ids), 512))]
    got = P.pack(messy, vocabulary, 512).collect()
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(want, key=str)
    rows = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    end = {}
    for s, o, n in rows:
        assert end.get(s, 0) == o
        end[s] = o + n
    assert max(end.values()) <= 512 and len(end) <= -(-sum(r[3] for r in want) // 512) + 1
    assert P.pack(nothing, vocabulary).count() == 0


def test_one_length_over_many_salts(make, vocabulary):
    got = P.pack(make([(i, "same text", "en") for i in range(500)]), vocabulary, 10).collect()
    seats = {(r["sequence_id"], r["offset"]) for r in got}
    assert len(seats) == 500 and {o for _, o in seats} == {0, 3, 6} and len({s for s, _ in seats}) == 167


# ---- fingerprints --------------------------------------------------------

def test_digests(messy, messy_rows, nothing):
    import hashlib

    got = D.compare_with_next(messy).collect()
    order = sorted(messy_rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    want = []
    for k, (i, t, _) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        want.append((i, len(t), hashlib.sha256((t[: len(t) - m] + after[:m]).encode()).hexdigest()))
    assert sorted((tuple(r[:3]) for r in got), key=str) == sorted(want, key=str)
    marks = {}
    for r in got:
        marks.setdefault((r["n_chars"], r["doc_id"] in (4, 5, None) and r["n_chars"] == 3), set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(marks[(3, True)]) == 1
    assert D.compare_with_next(nothing).count() == 0


def test_every_row_meets_its_next(make):
    rows = [(i * 7 % 400, f"text {i} " * (i % 9), "en") for i in range(400)]
    texts = {i: t for i, t, _ in rows}
    for r in D.compare_with_next(make(rows)).collect():
        mark = D.digests_of([texts[(r["doc_id"] - 1) % 400]])
        own = D.digests_of([texts[r["doc_id"]]])
        assert r["near_next"] == D.likeness(own, mark)[0] and r["fingerprint"] == own[0].tobytes().hex()


def test_ranges_without_rows_and_ranges_of_one_row(make, monkeypatch):
    """More ranges than rows: every next row is in another range, and some ranges are empty."""
    monkeypatch.setattr(D.ranges, "bucket_count", lambda docs: 40)
    for n in (1, 2, 9, 60):
        rows = [(5 if i < 4 else i * 3, f"{'same ' * 20} {i} " * (i % 5 + 1), "en") for i in range(n)]
        order = sorted(rows, key=lambda r: (-r[0], r[1]))
        want = sorted((r[0], D.likeness(D.digests_of([r[1]]), D.digests_of([order[(k + 1) % n][1]]))[0]) for k, r in enumerate(order))
        assert sorted((r["doc_id"], r["near_next"]) for r in D.compare_with_next(make(rows)).collect()) == want


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=300), st.text(max_size=300))
def test_difference_is_a_bounded_score(x, y):
    a, b = D.digests_of([x]), D.digests_of([y])
    assert D.difference(a, a)[0] == 0 and 0 <= D.difference(a, b)[0] == D.difference(b, a)[0] <= D.UNLIKE


def test_digest_counts_triplets():
    """A digest by plain loops."""
    text = "the quick brown fox, the quick brown fox. é!".encode() * 3
    count = [0] * 128
    for k, (a, b, c) in enumerate(((0, 1, 2), (0, 1, 3), (0, 2, 3))):
        for i in range(len(text) - c):
            h = (int(D._SEED[k, 0][text[i + a]]) + int(D._SEED[k, 1][text[i + b]])) % 2**32 ^ int(D._SEED[k, 2][text[i + c]])
            count[(h * 0x9E3779B1 % 2**32) >> 25] += 1
    q = [sorted(count)[k] for k in (31, 63, 95)]
    code = [sum(c > x for x in q) for c in count]
    mark = D.digests_of([text.decode()])[0]
    assert [int(mark[2 + i // 4]) >> (i % 4 * 2) & 3 for i in range(128)] == code


# ---- sharding ------------------------------------------------------------

def brute_table(shards, slots):
    prefer = []
    for s in shards:
        offset, skip = M._number(f"{s}|offset") % slots, M._number(f"{s}|skip") % (slots - 1) + 1
        prefer.append([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for i, order in enumerate(prefer):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = i
    return [table[s] for s in range(slots)]


def test_lookup_table():
    names = [f"s{i}" for i in range(7)]
    table = M.lookup_table(names, 211)
    assert table == brute_table(names, 211)
    assert max(map(table.count, range(7))) - min(map(table.count, range(7))) <= 1
    fewer = M.lookup_table(names[:-1], 211)
    assert sum(a != b for a, b in zip(table, fewer, strict=True)) < 211 * 0.4
    for bad in (210, 5):
        with pytest.raises(ValueError):
            M.lookup_table(names, bad)


def test_place(messy, nothing):
    names = ["a", "b", "c"]
    table = M.lookup_table(names)
    got = M.place(messy, names)
    assert got.count() == messy.count() and set(got.columns) == set(messy.columns)
    for r in got.collect():
        slot = M._number("" if r["doc_id"] is None else str(r["doc_id"])) % M.SLOTS
        assert (r["slot"], r["shard"]) == (slot, names[table[slot]])
    assert M.place(nothing, names).count() == 0


def test_whole_rows_are_written_by_shard(messy, nothing):
    names = ["a=1", "b/2", "c", "d d"]
    placed, written = M.place(messy, names), M.write(messy, names, file_bytes=1000)
    assert written.columns == placed.columns
    assert sorted(map(str, written.collect())) == sorted(map(str, placed.collect()))
    files = {f.split("/shard=")[1].split("/")[0] for f in written.inputFiles()}
    assert len(files) == placed.select("shard").distinct().count()
    assert M.write(nothing, names).count() == 0
