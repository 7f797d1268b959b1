import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions.hashing import hash_uniform
from larder.operators import graph as G
from larder.operators import graph_encoder as GE
from larder.operators import neighborhoods as N
from larder.operators import params as PA
from larder.operators import sampled_encoder as SE
from larder.session import Scratch

SMALL = SE.SAMPLED_DEFAULTS | {"dim": 3, "hidden_dim": 4, "n_layers": 2}
STILL = {"drop_edge_prob": 0.0, "drop_feat_prob": 0.0, "dropout": 0.0}


@pytest.fixture(scope="module")
def graph(spark):
    """210 nodes in a ring with chords, and a hub that all nodes point to."""
    rng = np.random.default_rng(2)
    name = [f"a{i:03d}" for i in range(210)]
    pairs = {(i, (i + 1) % 210) for i in range(210)} | {(int(a), int(b)) for a, b in rng.integers(0, 210, (300, 2)) if a != b} | {(i, 7) for i in range(210)}
    edges = spark.createDataFrame([(name[a], name[b], float(1 + (a + b) % 5)) for a, b in sorted(pairs)], "src string, dst string, w double")
    features = spark.createDataFrame([(name[i], rng.normal(size=5).tolist()) for i in range(210)], "attr_id string, features array<double>")
    vocabulary = spark.createDataFrame([(name[i], i) for i in range(210)], "attr_id string, idx long")
    return edges.cache(), features.cache(), vocabulary.cache()


def batches(graph, spark, fans, batch_nodes, turn=0):
    edges, features, vocabulary = graph
    scratch = Scratch(spark)
    seeds = N.seed_batches(vocabulary, 210, batch_nodes, 42, turn)
    members, arcs = N.walk(edges, seeds, fans, 42, turn, scratch)
    return members, arcs, scratch.keep(N.packed_batches(members, arcs, features, len(fans)))


def test_fan_outs_stay_within_the_budget():
    for n in (1, 50, 190, 3000, 10**5, 10**8):
        fans, reached = N.fan_outs(n, 3, 1024, 1 << 18), min(n, 1024)
        for fan in fans:
            assert reached * fan <= max(1 << 18, reached)
            reached = min(n, reached * (1 + fan))
        assert reached <= 1 << 20
    assert min(N.fan_outs(190, 3, 1024, 1 << 18)) > 190 and N.fan_outs(10**8, 3, 1024, 1 << 18) == [5, 6, 6]


def test_masks_are_the_rules_of_the_graph(spark):
    edges = spark.createDataFrame([(f"s{i % 9}", f"d{i}", 1.0) for i in range(40)], "src string, dst string, w double")
    ids = sorted({r.src for r in edges.collect()} | {r.dst for r in edges.collect()})
    rows = [(ids.index(r.src), ids.index(r.dst)) for r in edges.collect()]
    kept = SE.kept_edges(ids, *map(np.array, zip(*rows, strict=True)), 0.3, "42|5", 2)
    want = {(r.src, r.dst) for r in G.drop_edges(edges, 0.3, "42|5", 2).collect()}
    assert {(ids[a], ids[b]) for (a, b), k in zip(rows, kept, strict=True) if k} == want and 0 < kept.sum() < 40
    nodes = spark.createDataFrame([(i, [1.0] * 6) for i in ids], "attr_id string, features array<double>")
    masked = {r.attr_id: r.features for r in G.mask_features(nodes, 0.4, "42|5", 1).collect()}
    assert (SE.kept_features(ids, 6, 0.4, "42|5", 1) == np.array([masked[i] for i in ids])).all()
    assert spark.range(1).select(hash_uniform(F.lit(1), F.lit("x"))).first()[0] == SE.uniform(1, "x")


def test_every_node_is_a_seed_once_and_batches_are_full(graph, spark):
    for turn in (0, 1):
        sizes = sorted(r["count"] for r in N.seed_batches(graph[2], 210, 32, 42, turn).groupBy("batch").count().collect())
        assert sizes == [18] + [32] * 6


def test_walk_keeps_the_first_edges_of_each_node(graph, spark):
    members, arcs, _ = batches(graph, spark, [4, 2], 32)
    depth = {(r.batch, r.node): r.depth for r in members.collect()}
    assert len(depth) == members.count()
    incoming = {}
    for r in graph[0].withColumn("h", N.hash_hex(F.lit(42), F.lit(0), F.col("src"), F.col("dst"))).collect():
        incoming.setdefault(r.dst, []).append((r.h, r.src, r.w))
    got = {}
    for r in arcs.collect():
        got.setdefault((r.batch, r.dst), set()).add((r.src, r.w))
    for (b, node), d in depth.items():
        want = {(s, w) for _, s, w in sorted(incoming.get(node, []))[: [4, 2][d]]} if d < 2 else set()
        assert got.pop((b, node), set()) == want
        assert all(depth[b, s] <= d + 1 for s, _ in want)
    assert not got


def test_one_batch_without_limits_is_the_full_step(graph, spark):
    edges, features, vocabulary = graph
    params = GE.init_params(5, 4, 3, 2, 7)
    cfg = SMALL | STILL
    _, _, packed = batches(graph, spark, [1000, 1000], 1024)
    sums = SE.train_epoch(packed, params, 210, 5, cfg, 0)
    run = GE._Pass(GE.edge_cells(edges, vocabulary, 64), GE.node_blocks(features, vocabulary, 64), spark.sparkContext.broadcast(params),
                   5, 2, 64, cfg | {"batch_blocks": 8, "drop_edge_prob": -1.0, "drop_feat_prob": -1.0}, 0, Scratch(spark))
    flat, loss, stats = GE.contrastive_gradient(run, 210)
    assert sums["loss"][0] == pytest.approx(loss)
    got, want = PA.shaped(sums, params), PA.shaped(flat, params)
    assert all(np.allclose(got[k], want[k], atol=1e-10) for k in params)
    assert np.allclose(sums["mean2.1"], stats[1][1][0]) and np.allclose(sums["var1.2"] * 209 / 210, stats[0][2][1])


def test_gradient_by_finite_difference(graph, spark):
    _, _, packed = batches(graph, spark, [4, 2], 32)
    row = next(packed.toPandas().itertuples())
    batch, params = SE.Batch(row, 5), GE.init_params(5, 4, 3, 2, 7)
    grads, _, _ = batch.step(params, SMALL, 3)
    way = {k: np.random.default_rng(1).normal(size=np.shape(a)) for k, a in params.items()}
    up, down = (batch.step({k: params[k] + s * 1e-6 * way[k] for k in params}, SMALL, 3)[1] for s in (1, -1))
    assert (up - down) / 2e-6 == pytest.approx(sum(float((grads[k] * way[k]).sum()) for k in params), rel=1e-3)


def test_step_does_not_depend_on_partitions(graph, spark):
    _, _, packed = batches(graph, spark, [4, 2], 32)
    params = GE.init_params(5, 4, 3, 2, 7)
    one, many = (SE.train_epoch(p, params, 210, 5, SMALL, 1) for p in (packed.coalesce(1), packed.repartition(7)))
    assert one.keys() == many.keys() and all(np.allclose(one[k], many[k], atol=1e-12) for k in one)


def test_training_on_many_batches(graph):
    """Seven batches of 32 seeds, of which none holds the graph: losses fall and neighbours in the ring end up alike."""
    cfg = {"dim": 8, "hidden_dim": 16, "n_layers": 2, "epochs": 12, "lr": 0.01, "batch_nodes": 32, "hop_edges": 256, "resample": 4}
    vectors, params, losses = SE.fit_sampled_encoder(*graph, cfg)
    assert len(losses) == 12 and losses[-1] < losses[0]
    rows = vectors.collect()
    assert len(rows) == 210 and np.linalg.norm([r["vector"] for r in rows], axis=1) == pytest.approx(np.ones(210))
    assert params["mean1"].any() and SE.fit_sampled_encoder(*graph, cfg | {"epochs": 1})[2][0] == pytest.approx(losses[0])


def test_unknown_settings_are_errors(graph):
    with pytest.raises(ValueError, match="batch_blocks"):
        SE.fit_sampled_encoder(*graph, {"batch_blocks": 3})
