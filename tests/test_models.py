import numpy as np
import pytest

from larder.operators import alignment as AL
from larder.operators import autoencoder as AE
from larder.operators import cooccurrence as CO
from larder.operators import graph as G
from larder.operators import graph_encoder as GE
from larder.operators import params as PA
from larder.plans import providers as PR
from larder.session import Scratch


def numeric(f, params, name, at, eps=1e-6):
    out = []
    for sign in (1, -1):
        moved = {k: np.array(v, dtype=float) for k, v in params.items()}
        moved[name][at] += sign * eps
        out.append(f(moved))
    return (out[0] - out[1]) / (2 * eps)


def spots(rng, a, n=3):
    return [tuple(rng.integers(0, s) for s in np.shape(a)) for _ in range(n)]


# ---- autoencoder ----------------------------------------------------------------------------------

def test_autoencoder_gradient():
    rng = np.random.default_rng(0)
    params = AE.init_params(6, 5, 3, 1)
    x = rng.random((6, 6))
    keep = (rng.random((6, 5)) > 0.2) / 0.8
    args = (x, x * (rng.random(x.shape) > 0.2), keep, keep[::-1], 36.0)
    grads, _ = AE.gradient(params, *args)
    for name, a in params.items():
        for at in spots(rng, a):
            assert grads[name][at] == pytest.approx(numeric(lambda p: AE.gradient(p, *args)[1], params, name, at), abs=1e-7)


@pytest.fixture(scope="module")
def sparse_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(f"g{g}", f"k{k}") for g in range(30) for k in rng.choice(12, 4, replace=False)]
    df = spark.createDataFrame(rows, "upc_nbr string, attr_id string")
    cells = CO.sppmi(CO.mirror(CO.item_cooccurrence(df)), 0.0)
    return cells, G.indexed_vocabulary(G.attribute_vocabulary(df))


def test_autoencoder_step_does_not_depend_on_partitions(sparse_rows):
    rows = AE.matrix_rows(*sparse_rows)
    params = AE.init_params(12, 8, 4, 0)
    one, loss_one = AE.train_epoch(rows.coalesce(1), params, 12, 0.2, 42, 1)
    many, loss_many = AE.train_epoch(rows.repartition(6), params, 12, 0.2, 42, 1)
    assert loss_one == pytest.approx(loss_many)
    assert all(np.allclose(one[k], many[k], atol=1e-12) for k in params)


def test_autoencoder_learns(sparse_rows):
    vectors, _, losses = AE.fit_autoencoder(*sparse_rows, {"latent_dim": 8, "hidden_dim": 16, "epochs": 12, "lr": 0.01})
    assert losses[-1] < losses[0]
    rows = vectors.collect()
    assert len(rows) == 12 and all(len(r["vector"]) == 8 for r in rows)
    assert np.linalg.norm([r["vector"] for r in rows], axis=1) == pytest.approx(np.ones(12))


def test_autoencoder_on_all_zero_matrix(spark):
    rows = spark.createDataFrame(
        [("item1", "a"), ("item1", "b"), ("item2", "b"), ("item2", "c"), ("item3", "a")], "upc_nbr string, attr_id string"
    )
    provider = PR.CooccurrenceProvider({"source": "item", "latent_dim": 8, "hidden_dim": 16, "epochs": 3})
    provider.fit({"map_item_attribute": rows})
    assert provider.vectors().count() == 3
    with pytest.raises(ValueError):
        PR.CooccurrenceProvider({"source": "x"}).fit({"map_item_attribute": rows})


# ---- alignment -----------------------------------------------------------------------------------------

def test_alignment_gradient():
    rng = np.random.default_rng(1)
    params = AL.init_params(4, 6, 5, 2)
    item, pos, neg = rng.normal(size=(7, 5)), rng.normal(size=(7, 4)), rng.normal(size=(14, 4))
    masks = [(rng.random((m, 6)) > 0.2) / 0.8 for m in (7, 14)]
    grads, _, _ = AL.train_gradient(params, item, pos, neg, *masks)
    for name in grads:
        for at in spots(rng, params[name]):
            want = numeric(lambda p: AL.train_gradient(p, item, pos, neg, *masks)[1], params, name, at)
            assert grads[name][at] == pytest.approx(want, abs=1e-5, rel=1e-4)


@pytest.fixture(scope="module")
def alignable(spark):
    """Items whose vector is the mean of their attributes' vectors, rotated."""
    rng = np.random.default_rng(5)
    attrs, turn = rng.normal(size=(20, 8)), np.linalg.qr(rng.normal(size=(8, 8)))[0]
    held = [rng.choice(20, 3, replace=False) for _ in range(200)]
    item_attrs = spark.createDataFrame([(f"i{i}", f"a{k:02d}") for i, h in enumerate(held) for k in h], "upc_nbr string, attr_id string")
    items = spark.createDataFrame([(f"i{i}", (attrs[h].mean(0) @ turn).tolist()) for i, h in enumerate(held)], "item_id string, vector array<double>")
    vectors = spark.createDataFrame([(f"a{k:02d}", attrs[k].tolist()) for k in range(20)], "attr_id string, vector array<double>")
    return item_attrs, items, vectors


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_alignment_learns(alignable, limit):
    cfg = {"epochs": 4, "hidden_dim": 32, "output_dim": 8, "batch_size": 32, "lr": 0.01}
    out = AL.train_alignment(*alignable, cfg, partitions=2, limit_bytes=limit)
    history = out["history"].orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == [1, 2, 3, 4]
    assert history[-1]["train_loss"] < history[0]["train_loss"]
    assert out["metrics"]["best_val_loss"] == min(r["val_loss"] for r in history)
    assert history[-1]["val_acc"] > 1 / 6


def test_alignment_gives_one_model_for_any_partitions_and_path(alignable):
    cfg = {"epochs": 2, "hidden_dim": 8, "output_dim": 8, "batch_size": 32}
    first = None
    for partitions, limit in ((1, 1 << 20), (3, 1 << 20), (8, 0), (2, 0)):
        out = AL.train_alignment(*alignable, cfg, partitions=partitions, limit_bytes=limit, shard_rows=150)
        first = first or out
        for part in ("best", "final"):
            for name in out[part]:
                assert out[part][name] == pytest.approx(first[part][name], rel=1e-9, abs=1e-12)
        assert out["metrics"] == pytest.approx(first["metrics"], rel=1e-9)
    assert AL.best_epoch(first["history"]).first()["val_loss"] == pytest.approx(first["metrics"]["best_val_loss"])


def test_alignment_without_validation_rows_keeps_the_last_epoch(alignable, tmp_path):
    cfg = {"epochs": 2, "hidden_dim": 8, "output_dim": 8, "train_ratio": 1.0}
    out = AL.train_alignment(*alignable, cfg)
    assert all(np.array_equal(out["best"][n], out["final"][n]) for n in out["final"])
    assert not np.array_equal(out["best"]["w1"], AL.init_params(8, 8, 8, 42)["w1"])
    assert out["metrics"]["best_val_loss"] is None and out["metrics"]["final_val_acc"] is None
    assert AL.best_epoch(out["history"]).first()["epoch"] == 2
    AL.write_training(out, str(tmp_path / "h"), str(tmp_path / "m"))


def test_alignment_rejects_unknown_settings(alignable):
    with pytest.raises(ValueError, match="epohcs"):
        AL.train_alignment(*alignable, {"epohcs": 1})


def test_alignment_rejects_a_width_that_does_not_match(alignable):
    with pytest.raises(ValueError):
        AL.train_alignment(*alignable, {"epochs": 1, "output_dim": 64})


def test_params_round_trip_and_sums(spark, tmp_path):
    params = AL.init_params(4, 6, 5, 2) | {"long": np.arange(20000.0)}
    PA.write_params(spark, params, str(tmp_path / "p"))
    back = PA.read_params(spark, str(tmp_path / "p"))
    assert back.keys() == params.keys()
    assert all(np.array_equal(back[k], params[k]) and back[k].shape == np.shape(params[k]) for k in params)

    def emit(batches):
        for _ in batches:
            pass
        yield PA.as_chunks({"x": np.arange(9000.0)})

    for two_levels in (True, False):
        total = PA.sum_over_tasks(spark.range(10).repartition(5).mapInPandas(emit, PA.SUM_SCHEMA), two_levels)
        assert np.array_equal(total["x"], 5 * np.arange(9000.0))


# ---- graph encoder --------------------------------------------------------------------------------------

SMALL = GE.GRAPH_DEFAULTS | {"dim": 3, "hidden_dim": 4, "n_layers": 2}


@pytest.fixture(scope="module")
def graph(shop, spark):
    vocabulary = G.indexed_vocabulary(G.attribute_vocabulary(shop["map_item_attribute"]))
    edges = G.build_attribute_graph(shop["map_item_attribute"], shop["hh_attr_history"], min_cooccur=1)
    features = G.build_node_features(vocabulary.select("attr_id"), shop["attr_meta"], shop["map_item_attribute"])
    return edges.cache(), features.cache(), vocabulary.cache()


def dense(graph):
    edges, features, vocabulary = graph
    at = {r["attr_id"]: r["idx"] for r in vocabulary.collect()}
    a, x = np.zeros((7, 7)), np.zeros((7, 5))
    for r in edges.collect():
        a[at[r["src"]], at[r["dst"]]] = r["w"]
    for r in features.collect():
        x[at[r["attr_id"]]] = r["features"]
    return at, a, x


@pytest.mark.parametrize("block", [1024, 3])
def test_encoder_equals_dense_computation(graph, block):
    at, a, x = dense(graph)
    params, running = GE.init_params(5, 4, 3, 2, 7), None
    running = GE.init_running(params, 2)
    running["mean1"] += 0.1
    running["var2"] += 0.5
    h = np.maximum(x @ params["w0"] + params["b0"], 0)
    for i in (1, 2):
        near = a.T @ h / np.maximum(a.sum(0), 1)[:, None]
        p = h @ params[f"ws{i}"] + params[f"bs{i}"] + near @ params[f"wn{i}"] + params[f"bn{i}"]
        y = (p - running[f"mean{i}"]) / np.sqrt(running[f"var{i}"] + 1e-5)
        h = h + np.maximum(y, 0) if i == 1 else y
    edges, features, vocabulary = graph
    cells, nodes = GE.edge_cells(edges, vocabulary, block), GE.node_blocks(features, vocabulary, block)
    got = GE.graph_encode(cells, nodes, params, running, SMALL, 5, block).collect()
    assert len(got) == 7
    for r in got:
        assert r["vector"] == pytest.approx(list(h[at[r["attr_id"]]]))


def _step(graph, spark, params, block, cfg):
    edges, features, vocabulary = graph
    run = GE._Pass(GE.edge_cells(edges, vocabulary, block), GE.node_blocks(features, vocabulary, block),
                   spark.sparkContext.broadcast(params), 5, 2, block, cfg, 0, Scratch(spark))
    flat, loss, _ = GE.contrastive_gradient(run, 7)
    run.scratch.release()
    return PA.shaped(flat, params), loss


def test_contrastive_gradient_by_finite_difference(graph, spark):
    params = GE.init_params(5, 4, 3, 2, 7)
    rng = np.random.default_rng(3)
    grads, loss = _step(graph, spark, params, 4, SMALL)
    way = {k: rng.normal(size=np.shape(a)) for k, a in params.items()}
    eps = 1e-6
    up, down = (_step(graph, spark, {k: params[k] + s * eps * way[k] for k in params}, 4, SMALL)[1] for s in (1, -1))
    along = sum(float((grads[k] * way[k]).sum()) for k in params)
    assert (up - down) / (2 * eps) == pytest.approx(along, rel=1e-3)
    assert 0 < loss < 2 * np.log(13) + 4


def test_contrastive_step_does_not_depend_on_blocks(graph, spark):
    params = GE.init_params(5, 4, 3, 2, 7)
    still = SMALL | {"drop_edge_prob": -1.0, "drop_feat_prob": -1.0, "dropout": 0.0}
    one, loss_one = _step(graph, spark, params, 1024, still)
    many, loss_many = _step(graph, spark, params, 2, still)
    assert loss_one == pytest.approx(loss_many)
    assert all(np.allclose(one[k], many[k], atol=1e-9) for k in params)


def test_weighted_sums_of_edges(monkeypatch):
    monkeypatch.setattr(GE, "SLICE_EDGES", 7)
    rng = np.random.default_rng(0)
    s, d, w, m = rng.integers(0, 9, 60), rng.integers(0, 6, 60), rng.random(60), rng.normal(size=(9, 3))
    dense = np.zeros((9, 6))
    np.add.at(dense, (s, d), w)
    assert np.allclose(GE._weighted_sum(d, s, w, m), (dense.T @ m)[: d.max() + 1])
    assert GE._weighted_sum(d[:0], s[:0], w[:0], m).shape == (0, 3)


@pytest.mark.parametrize("n_blocks", [1, 2, 9, 20])
def test_batches_deal_every_block_once(spark, n_blocks):
    run = GE._Pass(None, None, None, 1, 1, 2, {"batch_blocks": 4, "seed": 3}, 5)
    left = spark.createDataFrame([(v, b, b"x") for v in (1, 2) for b in range(n_blocks)], "view int, blk int, m binary")
    met = {}
    for r in GE._met_blocks(run, left, n_blocks).collect():
        met.setdefault((r["view"], r["blk"]), []).append((r["o_view"], r["o_blk"]))
    assert len(met) == 2 * n_blocks
    groups = {tuple(sorted(v)) for v in met.values()}
    assert sorted(x for g in groups for x in g) == sorted(met) and len(groups) == -(-n_blocks // 4)
    assert all(len(set(v)) == len(v) and k in v for k, v in met.items())


def test_loss_over_batches_of_many_blocks(spark):
    """Twenty-one blocks of two nodes in batches of three, against the dense definition."""
    rng = np.random.default_rng(4)
    z = [rng.normal(size=(42, 5)) for _ in (1, 2)]
    cfg = {"dim": 5, "temperature": 0.5, "batch_blocks": 3, "seed": 3}
    blocks = spark.createDataFrame([(v, b, bytearray(GE._bytes(z[v - 1][2 * b : 2 * b + 2]))) for v in (1, 2) for b in range(21)], GE.NODE)
    run = GE._Pass(None, None, spark.sparkContext.broadcast({}), 1, 1, 2, cfg, 1, GE.Scratch(spark))
    parts = GE._loss_parts(run, blocks, 42).toPandas()
    a, _, c = GE.dealt(21, 3, 3, 1)
    batch = np.array([(a * (i // 2) + c) % 21 // 3 for i in range(42)] * 2)
    u = np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True) for x in z])

    def loss(u):
        sim = u @ u.T / 0.5
        sim[batch[:, None] != batch[None]] = -np.inf
        np.fill_diagonal(sim, -np.inf)
        partner = np.r_[np.arange(42) + 42, np.arange(42)]
        return np.mean(np.log(np.exp(sim).sum(1)) - sim[np.arange(84), partner])

    assert parts["loss"].sum() == pytest.approx(loss(u))
    got = np.zeros((84, 5))
    for r in parts.itertuples():
        at = (r.view - 1) * 42 + 2 * r.blk
        got[at : at + 2] += GE._rows(r.m, 5)
    for i, j in ((0, 0), (50, 3), (83, 4)):
        up, down = u.copy(), u.copy()
        up[i, j] += 1e-6
        down[i, j] -= 1e-6
        assert got[i, j] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-6)


def test_graph_provider(shop):
    """Views are drawn anew each epoch, so single losses of seven nodes go up and down: means of ten are compared."""
    provider = PR.GraphProvider({"dim": 16, "hidden_dim": 32, "n_layers": 2, "epochs": 40, "lr": 0.01, "min_cooccur": 1})
    provider.fit(shop)
    rows = provider.vectors().collect()
    assert len(rows) == 7 and len(provider.losses) == 40 and np.mean(provider.losses[-10:]) < np.mean(provider.losses[:10]) - 0.05
    assert np.linalg.norm([r["vector"] for r in rows], axis=1) == pytest.approx(np.ones(7))
