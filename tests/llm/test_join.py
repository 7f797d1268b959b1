import random
import re

import numpy as np
import pyarrow as pa
import pytest

from larder.llm import components as C
from larder.llm import ngram_join as N


def brute(rows):
    """The definition, pair by pair."""
    sets = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                old = group[i]
                group = [group[j] if g == old else g for g in group]
    least = {}
    for (i, *_), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, len(s), least.get(g)) for (i, *_), s, g in zip(rows, sets, group, strict=True)), key=str)


def families(seed=11):
    """Chains of edits, large groups of near copies, shared lines and exact copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijkl") + rng.choice("mnopqrst") + rng.choice("uvwxyz")
    line = " ".join(word() for _ in range(9))
    rows, i = [], 0
    for _ in range(14):
        base = [word() for _ in range(rng.randint(3, 160))]
        for _ in range(rng.randint(1, 8)):
            base = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                base[rng.randrange(len(base))] = word()
            rows.append((i, line + " " + " ".join(base) if rng.random() < 0.4 else " ".join(base), "en"))
            i += 1
    hot = [word() for _ in range(120)]
    for _ in range(60):
        copy = list(hot)
        copy[rng.randrange(120)] = word().upper()
        rows.append((i, " ".join(copy), "en"))
        i += 1
    rows += [(i + k, line, "en") for k in range(30)] + [(i + 100 + k, "x y z"[: k], "en") for k in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("leaf,shard_bytes,shared,box", [(4096, 24 << 20, 16, 32), (4, 2000, 2, 32), (2, 2000, 0, 2)])
def test_equals_brute_force(make, monkeypatch, leaf, shard_bytes, shared, box):
    monkeypatch.setattr(N, "LEAF", leaf)
    monkeypatch.setattr(N, "LEAF_SHINGLES", N.LEAF_SHINGLES if leaf > 4 else 600)
    monkeypatch.setattr(N, "BOX", box)
    monkeypatch.setattr(N, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(N, "SHARED_NODES", shared)
    rows = families()
    assert sorted(map(tuple, N.near_duplicates(make(rows)).collect()), key=str) == brute(rows)


def test_messy_rows(messy, messy_rows, nothing):
    assert sorted(map(tuple, N.near_duplicates(messy).collect()), key=str) == brute(messy_rows)
    assert N.near_duplicates(nothing).count() == 0


def test_one_of_each(make, messy):
    rows = [(3, "a b c d e f", "en"), (1, "A b c d e f", "en"), (2, "q", "en"), (4, None, "en"), (5, "", "en")]
    assert sorted(r["doc_id"] for r in N.one_of_each(make(rows)).collect()) == [1, 2, 4, 5]
    assert N.one_of_each(messy).columns == messy.columns


def test_one_row_of_each_where_ids_repeat(make):
    rows = [
        (7, "a b c d e f", "en"), (7, "only this one has these words", "en"), (3, "A b c d e f", "en"),  # an id of two groups
        (5, "p q r s t u", "en"), (5, "p q r s t u", "en"), (5, "P q r s t u", "fr"),  # copies of one id
        (None, "k l m n o", "en"), (None, "k l m n o", "en"), (None, "w x y z", "de"), (None, "a b c d e f", "en"), (9, "w x y z", "de"),
        (8, "", "en"), (8, None, None), (8, "p q r s t u", "en"), (None, "", "en"), (None, " ", "en"), (2, "free", "en"), (2, "other", "en"),
    ]
    want = [(7, rows[1][1]), (3, rows[2][1]), (5, "P q r s t u"), (None, "k l m n o"), (9, "w x y z"), (8, ""), (8, None), (None, ""),
            (None, " "), (2, "free"), (2, "other")]
    got = N.one_of_each(make(rows))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == make([]).columns
    assert N.one_of_each(make([])).count() == 0


def test_one_row_of_each_of_messy_rows(messy, messy_rows):
    """As many rows with words stay as there are groups, by the definition without ids."""
    names = {i: k for k, i in enumerate(dict.fromkeys(r[0] for r in messy_rows))}
    groups = {least for _, n, least in brute([(names[i] * 100 + k, t, g) for k, (i, t, g) in enumerate(messy_rows)]) if n}
    got = [r["text"] for r in N.one_of_each(messy).collect()]
    worded = lambda t: bool(re.search(r"[^\x20\x09-\x0D]", t or ""))
    assert sum(map(worded, got)) == len(groups)
    assert sum(not worded(t) for t in got) == sum(not worded(t) for _, t, _ in messy_rows)


def test_tree_bound_never_loses_a_pair():
    rng = np.random.default_rng(0)
    sets = []
    for _ in range(40):
        base = rng.choice(5000, rng.integers(1, 200), replace=False)
        sets += [np.unique(np.where(rng.random(len(base)) < p, rng.integers(0, 5000, len(base)), base)).astype(np.uint64) for p in (0, 0.03, 0.1, 0.3)]
    hashes, start = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    tree = N.CountTree(N.count_points(hashes, start), np.diff(start))
    for i in range(len(sets)):
        a = sets[tree.order[i]]
        near = {j for j in range(i + 1, len(sets)) if 100 * len(np.intersect1d(a, sets[tree.order[j]])) >= 80 * len(np.union1d(a, sets[tree.order[j]]))}
        assert near <= set(tree.search(i).tolist())


def test_search_leaves_out_branches(monkeypatch):
    """A tree of four levels over sets of many sizes: a search visits few of its boxes and points."""
    monkeypatch.setattr(N, "BOX", 8)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 48, n).astype(np.uint64)) for n in rng.integers(30, 3000, 2000)]
    start = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    tree = N.CountTree(N.count_points(np.concatenate(sets), start), np.diff(start))
    assert len(tree.levels) == 5
    for i in range(2000):
        tree.search(i)
    assert tree.visited < 2000 * 2000 / 2 / 4


@pytest.mark.parametrize("box,n", [(2, 1), (2, 3), (2, 13), (3, 40), (32, 40)])
def test_pairs_of_leaves_by_boxes(spark, monkeypatch, box, n):
    """Two clusters of leaves whose numbers begin anywhere: the pairs that remain are those that the bound leaves."""
    monkeypatch.setattr(N, "BOX", box)
    rng = np.random.default_rng(n)
    rows = []
    for cluster, at in ((5, 17), (9, 17 + n)):
        sizes = np.sort(rng.integers(20, 400, 2 * n)).reshape(-1, 2)
        for k in range(n):
            rows.append((cluster, at + k, int(sizes[k, 0]), int(sizes[k, 1]), bytearray(rng.multinomial(sizes[k, 1] + 5, np.ones(64) / 64).astype("<u4").tobytes())))
    got = {tuple(r) for r in N.box_pairs(N.materialize(spark.createDataFrame(rows, N.BOXES))).collect()}
    want = set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[1] < y[1]:
                p, q = (N._from_bytes([r[4]])[0] for r in (x, y))
                if any(100 * min(a, b) >= 80 * max(a, b) and np.minimum(p, q).sum() >= N.least_overlap(a, b)
                       for a in range(x[2], x[3] + 1) for b in range(y[2], y[3] + 1)):
                    want.add((x[0], x[1], y[1]))
    assert got >= want and len(got) <= len(want) + max(2, n)


def test_stars_are_linear_in_what_shares_a_key(spark):
    """Near copies in one group: a few rows a node, whatever their number."""
    rows = {}
    for n in (16, 64, 256):
        words = [f"w{k}" for k in range(200)]
        texts = [" ".join([*words[:50], f"x{i}", *words[50:]]) for i in range(n)]
        routed = spark.createDataFrame([(t,) for t in texts], "text string").mapInArrow(N._routed(1, 80), N.PIECE)
        stars = routed.groupBy("shard").applyInArrow(N._stars, "a long, b long, keys long")
        rows[n] = stars.count()
    assert all(rows[n] <= 4 * n for n in rows)  # 256 copies have 32,640 pairs


def near_copies(n, at=50):
    words = [f"w{k}" for k in range(200)]
    return [" ".join([*words[:at], f"x{i}", *words[at:]]) for i in range(n)]


def test_stars_grow_with_nodes_whatever_the_shards(make):
    """Near copies share keys in all shards, but are one family there: the rows of the stars don't multiply by the shards."""
    rng = random.Random(4)
    rows, nodes = {}, 0
    for n, shards in ((64, 1), (64, 64), (256, 64)):
        texts = [*near_copies(n), *near_copies(n, 120), *(" ".join(f"{rng.randrange(10**6)}" for _ in range(100)) for _ in range(n))]
        docs = make([(i, t, "en") for i, t in enumerate(texts)])
        table = N.set_table(docs)
        nodes = N.materialize(table.selectExpr("node", "doc_id AS rep", "n", "common", "bands"))
        family = N.families(nodes)
        stars = N.key_stars(docs, nodes, family, shards)
        rows[n, shards] = stars.count()
        clusters = [r["count"] for r in N.candidates(stars, nodes, family).groupBy("component").count().collect()]
        assert clusters == [2 * n]  # texts of the two kinds of copies are linked, too
    assert rows[64, 64] <= 128 and rows[256, 64] <= 512, rows


def test_bytes_of_a_key_whatever_the_shards():
    """What is sent for a key stays about the same where each key of a text goes to a shard of its own."""
    rng = random.Random(8)
    batch = pa.record_batch({"text": [" ".join(f"{rng.randrange(10**6)}" for _ in range(400)) for _ in range(600)]})
    bytes_of = {}
    for shards in (1, 20, 2000):
        sent = [r for b in N._routed(shards, 80)(iter([batch])) for r in b.to_pylist()]
        keys = sum(len(r["key"] or b"") for r in sent) // N.KEY_BYTES
        bytes_of[shards] = sum(len(v) for r in sent for v in r.values() if isinstance(v, bytes)) / keys
    assert keys > 100_000 and all(x < N.KEY_BYTES + 1.2 for x in bytes_of.values()), bytes_of


@pytest.mark.parametrize("top", [0, 1, 255, 256, 70_000, 1 << 33])
def test_steps(top):
    at = np.sort(np.r_[top, np.random.default_rng(top).integers(0, top + 1, 50)])
    assert (N._ascending(N._steps(at), len(at)) == at).all()
    assert (N._ascending(N._steps(at[-1:]), 1) == top).all()


@pytest.mark.parametrize("shards", [1, 300])
def test_stars_name_nodes_whatever_task_they_come_from(make, shards):
    """Sets that share keys but no band, in several tasks: stars are told in nodes, not in the numbers of a task's pieces."""
    rows = [(i, " ".join([*(f"w{k}" for k in range(30)), *(f"y{i}x{k}" for k in range(60))]), "en") for i in range(40)] * 2
    docs = make([(i, f"{t} {t}" if i % 2 else t, g) for i, t, g in rows]).repartition(5)
    nodes = N.materialize(N.set_table(docs).groupBy("node").agg(*[N.F.min(c).alias(a) for c, a in (("doc_id", "rep"), ("common", "common"), ("bands", "bands"))], N.F.count("*").alias("copies")))
    family = N.families(nodes)
    got = N.key_stars(N.materialize(docs), nodes, family, shards, repeated=nodes.filter("copies > 1").select("node")).collect()
    names = {r["node"] for r in nodes.collect()} - {r["node"] for r in family.collect()} | {r["family"] for r in family.collect()}
    assert got and {r[c] for r in got for c in "ab"} <= names
    once = N.key_stars(N.materialize(docs.dropDuplicates(["doc_id"])), nodes, family, shards).collect()
    count = lambda rows: sum(r["keys"] for r in rows)
    assert count(once) == count(got) and {r["keys"] > 0 for r in got} == {True}


def test_texts_are_dealt_out_at_all_sizes(spark):
    rows = spark.createDataFrame([(1, 5), (None, 6), (3, 7)], "rep long, node long")
    texts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "rep long, text string")
    got = N.joined_texts(rows, texts).select("node", "text")
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, got.collect())) == [(5, "a"), (6, "c")]


@pytest.mark.parametrize("bits", [8, 1 << 16])
def test_bitmap_of_nodes(spark, monkeypatch, bits):
    monkeypatch.setattr(N, "FILTER_BITS", bits)
    nodes = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 4000, np.int64)
    some = N.node_bitmap(spark.createDataFrame([(int(x),) for x in [*nodes[:1000], -1, 0, 1, -(1 << 63), (1 << 63) - 1]], "node long"))
    assert N.marked(some, nodes[:1000]).all() and N.marked(some, np.array([-1, 0, 1, -(1 << 63), (1 << 63) - 1])).all()
    assert N.marked(some, nodes[1000:]).mean() < 0.1
    assert N.node_bitmap(spark.createDataFrame([], "node long")) is None and not N.marked(None, nodes).any()


def test_equals_brute_force_where_the_bitmap_is_full(make, monkeypatch):
    """Sets of no family that the bitmap has are routed with the families."""
    monkeypatch.setattr(N, "FILTER_BITS", 8)
    monkeypatch.setattr(N, "marked", lambda bits, node: np.ones(len(node), bool) if bits is not None else np.zeros(len(node), bool))
    rows = families(7)
    rows += [(rows[0][0], "a text of another row with this doc_id", "en"), (rows[1][0], rows[2][1], "en")]
    assert sorted(map(tuple, N.near_duplicates(make(rows)).collect()), key=str) == brute(rows)


def test_bands():
    h = np.array([5, 9, 11, 5, 9, 11, 7], np.uint64)
    bands = N.band_values(h, np.array([0, 0, 3, 3, 6, 7, 7]))
    assert (bands[[0, 2, 5]] == 0).all() and (bands[1] == bands[3]).all() and not (bands[1] == bands[4]).any()
    assert len(set(bands[1].tolist())) == N.BANDS
    assert N.band_values(h[:0], np.array([0, 0])).tolist() == [[0] * N.BANDS]


def test_linked_sets_have_a_key_in_common_and_room_in_their_points():
    rng = np.random.default_rng(1)
    sets = []
    for n in [*range(1, 40), *rng.integers(40, 4000, 40)]:
        base = rng.integers(0, 1 << 48, n).astype(np.uint64)
        for gone, new in ((n // 5, 0), (0, n // 4), (n // 10, n // 10), (1, 0), (0, 1)):
            sets += [np.unique(base), np.unique(np.concatenate([base[gone:], rng.integers(0, 1 << 48, new).astype(np.uint64)]))]
    start = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    key, who = N.group_keys(np.concatenate(sets), start, np.ones(len(sets), bool))
    points = N.count_points(np.concatenate(sets), start)
    common = N.least_common(np.concatenate(sets), start)
    linked = 0
    for i in range(0, len(sets), 2):
        a, b = sets[i], sets[i + 1]
        both = len(np.intersect1d(a, b))
        assert np.minimum(points[i], points[i + 1]).sum() >= both
        if both and 100 * both >= 80 * len(np.union1d(a, b)):
            met = np.intersect1d(key[who == i], key[who == i + 1]).size
            assert met >= max(common[i], common[i + 1])
            linked += 1
    assert linked > 250


def test_wanted_texts(spark):
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(2000)] + [(None, "none")], "rep long, text string")
    some = spark.createDataFrame([(i,) for i in range(0, 2000, 7)] + [(None,)], "rep long")
    got = {r["rep"] for r in N.wanted(texts, some).collect()}
    assert {*range(0, 2000, 7), None} <= got and len(got) < 300
    assert {r["rep"] for r in N.wanted(texts, some, 1 << 15).collect()} >= got


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)] + [(7, 7), (-5, 2000)]
    group = {}
    for a, b in edges:
        group.setdefault(a, a), group.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    want = {k: v for k, v in group.items() if any(k in e and e[0] != e[1] for e in edges)}
    for per_task in (500_000, 30):
        got = C.components(spark.createDataFrame(edges, "a long, b long"), per_task).collect()
        assert len(got) == len(want) and {r["node"]: r["component"] for r in got} == want
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
