import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.operators import cooccurrence as CO
from larder.operators import graph as G
from larder.operators import pairs


@pytest.fixture(scope="module")
def brands(spark):
    rows = spark.createDataFrame(
        [("item1", "a"), ("item1", "b"), ("item2", "b"), ("item2", "c"), ("item3", "a")], "upc_nbr string, attr_id string"
    )
    history = spark.createDataFrame(
        [("hh1", "a", 10.0), ("hh1", "b", 5.0), ("hh2", "b", 8.0), ("hh2", "c", 3.0)],
        "household_id string, attr_id string, hist_score double",
    )
    return rows, history


def cells(df):
    return {(r["src"], r["dst"]): r["w"] for r in df.collect()}


def test_counts_and_sppmi(brands):
    rows, history = brands
    edges = CO.item_cooccurrence(rows)
    assert cells(edges) == {("a", "b"): 1, ("b", "c"): 1}
    full = CO.mirror(edges)
    assert {r["attr_id"]: r["total"] for r in CO.marginals(full).collect()} == {"a": 1, "b": 2, "c": 1}
    assert CO.sppmi(full, 1.0).count() == 0
    values = cells(CO.sppmi(full, 0.0))
    assert len(values) == 4 and all(v == pytest.approx(math.log(2)) for v in values.values())
    got = cells(CO.household_cooccurrence(history))
    assert got[("a", "b")] == pytest.approx(math.sqrt(50)) and got[("b", "c")] == pytest.approx(math.sqrt(24))
    with pytest.raises(ValueError):
        CO.sppmi(full, -0.1)


def test_empty_cells(spark, brands):
    rows, _ = brands
    lonely = rows.where("upc_nbr = 'item3'")
    none = CO.mirror(CO.item_cooccurrence(lonely))
    assert CO.sppmi(none, 0.0).count() == 0
    stats = CO.matrix_stats(none, G.attribute_vocabulary(lonely)).first()
    assert (stats["attributes"], stats["cells"], stats["sparsity_pct"]) == (1, 0, 100.0)


def random_rows(groups, keys, seed):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        for k in rng.choice(keys, rng.integers(1, keys + 1), replace=False):
            out.append((f"g{g}", f"k{k:03d}", float(rng.random())))
    return out


def brute(rows):
    want = {}
    for _, part in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        for (_, a, x), (_, b, y) in itertools.combinations(list(part), 2):
            want[(a, b)] = want.get((a, b), 0.0) + x * y
    return want


@pytest.mark.parametrize("wide, blocks", [(4000, 32), (5, 4), (1, 1)])
def test_pair_sums_equal_brute_force(spark, wide, blocks):
    rows = random_rows(25, 30, seed=wide)
    df = spark.createDataFrame(rows + rows[:7], "g string, k string, v double")
    got = cells(pairs.pair_sums(df, "g", "k", F.col("v"), wide=wide, key_blocks=blocks))
    want = brute(rows)
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p]) for p in want)


@pytest.mark.parametrize("tile", [8, 64])
@pytest.mark.parametrize("chunk", [10, 100_000])
def test_task_kernels_in_small_slices(monkeypatch, tile, chunk):
    monkeypatch.setattr(pairs, "TILE", tile)
    monkeypatch.setattr(pairs, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(pairs, "SLICE_CELLS", 50)
    rows = sorted(random_rows(20, 25, seed=3))
    pdf = pd.DataFrame(rows, columns=["grp", "key", "val"])
    batches = [pdf.iloc[i : i + 13] for i in range(0, len(pdf), 13)]
    out = pd.concat(pairs._within_groups(iter(batches))).groupby(["src", "dst"])["w"].sum()
    want = brute(rows)
    assert set(out.index) == set(want)
    assert all(out[p] == pytest.approx(want[p]) for p in want)


def test_cells_leave_a_task_about_once(monkeypatch):
    """Many groups over a vocabulary far above the dense limit."""
    monkeypatch.setattr(pairs, "TILE", 64)
    monkeypatch.setattr(pairs, "CHUNK_ROWS", 500)
    monkeypatch.setattr(pairs, "SLICE_CELLS", 3000)
    rng = np.random.default_rng(3)
    rows = [(f"g{g:04d}", f"k{k}", float(1 + k % 3)) for g in range(400) for k in np.unique(rng.zipf(1.3, 12) % 500)]
    frame = pd.DataFrame(rows, columns=["grp", "key", "val"])
    out = list(pairs._within_groups(iter([frame.iloc[i : i + 300] for i in range(0, len(frame), 300)])))
    want = {}
    for _, part in frame.groupby("grp"):
        for i, (k, v) in enumerate(zip(part["key"], part["val"], strict=True)):
            for j, w in zip(part["key"].iloc[:i], part["val"].iloc[:i], strict=True):
                pair = (min(k, j), max(k, j))
                want[pair] = want.get(pair, 0.0) + v * w
    sent = pd.concat(out)
    assert len(sent) == len(want)
    assert {(r.src, r.dst): r.w for r in sent.itertuples()} == pytest.approx(want)
    monkeypatch.setattr(pairs, "MOST_CELLS", 1000)
    again = pd.concat(pairs._within_groups(iter([frame]))).groupby(["src", "dst"])["w"].sum()
    assert again.to_dict() == pytest.approx(want)


def test_graph_weights(shop):
    got = cells(G.undirected_edges(shop["map_item_attribute"], shop["hh_attr_history"], min_cooccur=1))
    want = {
        ("brand_a", "health_organic"): 1 + 0.5 * math.sqrt(50), ("brand_b", "health_organic"): 1 + 0.5 * math.sqrt(24),
        ("category_dairy", "health_organic"): 2, ("brand_a", "category_dairy"): 1, ("brand_b", "category_dairy"): 1,
        ("brand_c", "category_snacks"): 1, ("brand_a", "health_vegan"): 1,
    }
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    for low, entries, edges in ((1, 21, 7), (3, 11, 2)):
        graph = G.build_attribute_graph(shop["map_item_attribute"], shop["hh_attr_history"], min_cooccur=low)
        stats = G.graph_stats(graph).first()
        assert (stats["nodes"], stats["entries"], stats["undirected_edges"]) == (7, entries, edges)


def test_node_features(shop, spark):
    vocabulary = G.attribute_vocabulary(shop["map_item_attribute"])
    rows = {r["attr_id"]: r["features"] for r in
            G.build_node_features(vocabulary, shop["attr_meta"], shop["map_item_attribute"]).collect()}
    assert len(rows) == 7 and rows["brand_a"] == pytest.approx([1, 0, 0, math.log(3), math.log(3)])
    assert rows["category_dairy"][:3] == [0, 1, 0] and rows["health_vegan"][:3] == [0, 0, 1]
    nutrition = spark.createDataFrame([("item1", 10.0), ("item2", None)], "upc_id string, calories double")
    scored = {r["attr_id"]: r["nutrition"][0] for r in
              G.nutrition_features(vocabulary, shop["map_item_attribute"], nutrition).collect()}
    means = np.array([10.0 if a in ("brand_a", "category_dairy", "health_organic") else 0.0 for a in sorted(scored)])
    want = (means - means.mean()) / (means.std() + 1e-6)
    assert [scored[a] for a in sorted(scored)] == pytest.approx(list(want))


def test_random_views_keep_the_right_share(shop, spark):
    edges = spark.range(4000).selectExpr("cast(id AS string) AS src", "'x' AS dst", "1.0D AS w")
    assert abs(G.drop_edges(edges, 0.2, 1, 1).count() / 4000 - 0.8) < 0.03
    assert G.drop_edges(edges, 0.2, 1, 1).exceptAll(G.drop_edges(edges, 0.2, 1, 1)).count() == 0
    assert G.drop_edges(edges, 0.2, 1, 1).exceptAll(G.drop_edges(edges, 0.2, 1, 2)).count() > 0
    nodes = spark.createDataFrame([("a", [1.0] * 2000)], "attr_id string, features array<double>")
    masked = G.mask_features(nodes, 0.1, 1, 1).first()["features"]
    assert abs(sum(masked) / 2000 - 0.9) < 0.03


def test_neighbor_mean_of_isolated_node(spark):
    nodes = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "attr_id string, features array<double>")
    edges = spark.createDataFrame([("a", "b", 0.5)], "src string, dst string, w double")
    got = {r["attr_id"]: r["neighbors"] for r in G.neighbor_mean(edges, nodes, 2).collect()}
    assert got == {"a": [0.0, 0.0], "b": [0.5, 1.0]}


@pytest.mark.parametrize("chunk, batch", [(100_000, 10_000), (7, 5), (40, 1)])
def test_repeated_keys_count_once_with_their_largest_value(monkeypatch, chunk, batch):
    """Groups over the borders of batches and chunks; a null value is less than any other."""
    monkeypatch.setattr(pairs, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(8)
    df = pd.DataFrame({"grp": [f"g{g:02d}" for g in np.sort(rng.integers(0, 30, 400))], "key": [f"k{k}" for k in rng.integers(0, 9, 400)], "val": rng.random(400)})
    df.loc[df.duplicated(["grp", "key"]) & (rng.random(400) < 0.3), "val"] = None
    once = df.groupby(["grp", "key"])["val"].max().unstack().fillna(0.0)
    batches = pa.Table.from_pandas(df, preserve_index=False).to_batches(batch)
    out = pa.Table.from_batches(list(pairs._numbered(iter(batches)))).to_pandas().groupby(["src", "dst"])["w"].sum()
    for a in once:
        for b in once:
            if a < b:
                assert out[a, b] == pytest.approx((once[a] * once[b]).sum())
