import numpy as np
import pytest

from larder.operators import autoencoder as AE
from larder.operators import blocked_autoencoder as BA
from larder.operators import cooccurrence as CO
from larder.operators import graph as G
from larder.operators.params import Adam

CFG = AE.AE_DEFAULTS | {"hidden_dim": 6, "latent_dim": 4, "lr": 0.01}


@pytest.fixture(scope="module")
def sparse(spark):
    rng = np.random.default_rng(4)
    rows = [(f"g{g}", f"k{k:02d}") for g in range(40) for k in rng.choice(23, 3, replace=False)] + [("alone", "k99")]
    df = spark.createDataFrame(rows, "upc_nbr string, attr_id string")
    cells = CO.sppmi(CO.mirror(CO.item_cooccurrence(df)), 0.0).cache()
    vocabulary = G.indexed_vocabulary(G.attribute_vocabulary(df)).cache()
    return cells, vocabulary, vocabulary.count()


def in_blocks(spark, params, entries, n, block):
    """A whole model as blocks."""
    xsum = np.zeros(n)
    for r in entries.collect():
        xsum[r.cb * block + r.c] += r.w
    rows = []
    for b in range(-(-n // block)):
        at = slice(b * block, (b + 1) * block)
        rows.append((b, bytearray(BA.pack([params["w1"][at], params["w4"].T[at], params["b4"][at], xsum[at]])), None))
    return spark.createDataFrame(rows, BA.PLACED)


@pytest.mark.parametrize("block", [1, 5, 24, 512])
def test_steps_equal_those_of_the_whole_model(spark, sparse, monkeypatch, block):
    """Three steps with noise and dropout: losses, inner layers and vectors; column runs are cut into slices."""
    monkeypatch.setattr(BA, "HELD_ENTRIES", 7)
    cells, vocabulary, n = sparse
    params = AE.init_params(n, 6, 4, 1)
    entries = BA.sparse_entries(cells, vocabulary, block).cache()
    inner = {k: params[k] for k in ("b1", "w2", "b2", "w3", "b3")}
    trainer = BA.Trainer(entries, in_blocks(spark, params, entries, n, block), inner, n, CFG, block)
    rows, adam = AE.matrix_rows(cells, vocabulary).cache(), Adam(CFG["lr"])
    for epoch in range(3 if block > 1 else 1):
        grads, loss = AE.train_epoch(rows, params, n, CFG["noise_prob"], CFG["seed"], epoch)
        adam.step(params, grads)
        assert trainer.step(epoch) == pytest.approx(loss, rel=1e-9)
    assert all(np.allclose(trainer.inner[k], params[k], atol=1e-10) for k in inner)
    want = {r.attr_id: r.vector for r in AE.encode(rows, params, n).collect()}
    got = {r.attr_id: r.vector for r in trainer.encode().join(vocabulary, "idx").collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-9) for k in want)
    trainer.release()


def test_large_vocabularies_are_trained_in_blocks(sparse, monkeypatch):
    cells, vocabulary, n = sparse
    monkeypatch.setattr(AE, "MODEL_BYTES", 0)
    vectors, _, losses = AE.fit_autoencoder(cells, vocabulary, {"hidden_dim": 16, "latent_dim": 8, "epochs": 6, "lr": 0.01})
    assert len(losses) == 6 and losses[-1] < losses[0]
    rows = vectors.collect()
    assert len(rows) == n and np.linalg.norm([r["vector"] for r in rows], axis=1) == pytest.approx(np.ones(n))
