"""Contrastive training of the graph encoder on sampled neighbourhoods: a batch of seeds is a task's unit.

A batch's row holds all that its step needs, so an epoch is one pass over the batches: each task computes two random views of
its batches, forward and backward, and adds up their gradients; the sums meet on the executors and one copy of the model
reaches the driver. Batch norm takes its moments from the nodes of a batch, negatives are its other seeds. With all nodes
in one batch and no edge left out, a step is the full-graph step of graph_encoder. Neighbourhoods are drawn anew every `resample` epochs.
Inference walks the whole graph, block by block.
"""

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize
from ..session import Scratch, materialize
from . import graph_encoder as GE
from .alignment import BN_EPS, BN_MOMENTUM
from .neighborhoods import fan_outs, packed_batches, seed_batches, walk
from .params import SUM_SCHEMA, Adam, Params, as_chunks, known_settings, shaped, sum_over_tasks

SAMPLED_DEFAULTS = {k: v for k, v in GE.GRAPH_DEFAULTS.items() if k != "batch_blocks"} | {
    "batch_nodes": 1024, "hop_edges": 1 << 18, "resample": 10,
}

DENSE = 8  # cells of a matrix for each of its edges, up to which it is held whole
FEW = 16


def uniform(*parts) -> float:
    """hash_uniform() of the same parts."""
    return int(md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 4294967296.0


def kept_edges(ids: list[str], s: np.ndarray, d: np.ndarray, p: float, seed, view: int) -> np.ndarray:
    """Mask over the edges: those that drop_edges() keeps."""
    if p <= 0:
        return np.ones(len(s), bool)
    return np.array([uniform(seed, view, ids[a], ids[b]) > p for a, b in zip(s.tolist(), d.tolist(), strict=True)], bool)


def kept_features(ids: list[str], width: int, p: float, seed, view: int) -> np.ndarray:
    """Mask over nodes and features: those that mask_features() keeps."""
    if p <= 0:
        return np.ones((len(ids), width), bool)
    return np.array([[uniform(seed, view, i, k) > p for k in range(width)] for i in ids], bool)


def _sums(to: np.ndarray, source: np.ndarray, w: np.ndarray, m: np.ndarray, rows: int) -> np.ndarray:
    """For each target the sum of w * m[source] over its edges; a matrix that is nearly full is multiplied as such."""
    if rows * len(m) <= DENSE * len(to):
        return np.bincount(to.astype(np.int64) * len(m) + source, w, rows * len(m)).reshape(rows, -1) @ m
    out = np.zeros((rows, m.shape[1]))
    part = GE._weighted_sum(to, source, w, m)
    out[: len(part)] = part
    return out


class Batch:
    """A packed batch and its arithmetic."""

    def __init__(self, row, n_in: int):
        self.number, self.ids, self.counts = int(row.batch), list(row.ids), [int(c) for c in row.counts]
        self.x = np.frombuffer(row.x).reshape(-1, n_in)
        self.s, self.d, self.w = np.frombuffer(row.s, np.int32), np.frombuffer(row.d, np.int32), np.frombuffer(row.w)

    def forward(self, q: Params, cfg: dict, epoch: int, view: int) -> tuple[np.ndarray, list]:
        """The seeds' output and what the backward pass needs of each layer."""
        seed = f"{cfg['seed']}|{epoch}"
        kept = kept_edges(self.ids, self.s, self.d, cfg["drop_edge_prob"], seed, view)
        s, d, w = self.s[kept], self.d[kept], self.w[kept]
        x = self.x * kept_features(self.ids, self.x.shape[1], cfg["drop_feat_prob"], seed, view)
        h = np.maximum(x @ q["w0"] + q["b0"], 0)
        tape: list = [(x, h > 0)]
        for layer in range(1, cfg["n_layers"] + 1):
            rows = self.counts[cfg["n_layers"] - layer]  # nodes whose output later layers need
            last = int(np.searchsorted(d, rows))
            arcs = s[:last], d[:last], w[:last]
            deg = np.maximum(np.bincount(arcs[1], arcs[2], rows), 1.0)[:, None]
            near = _sums(arcs[1], arcs[0], arcs[2], h, rows) / deg
            own = h[:rows]
            p = own @ q[f"ws{layer}"] + q[f"bs{layer}"] + near @ q[f"wn{layer}"] + q[f"bn{layer}"]
            mean, var = p.mean(0), p.var(0)
            inv = 1.0 / np.sqrt(var + BN_EPS)
            xhat = (p - mean) * inv
            y = xhat * q[f"gamma{layer}"] + q[f"beta{layer}"]
            passed = np.ones_like(y)
            if layer < cfg["n_layers"]:
                drawn = np.random.default_rng([cfg["seed"], epoch, 3, layer, view, self.number]).random(y.shape)
                passed = (y > 0) * (drawn >= cfg["dropout"]) / (1 - cfg["dropout"])
            out = y * passed
            same = own.shape == out.shape
            tape.append((h, near, deg, arcs, xhat, inv, passed, same, mean, var))
            h = own + out if same else out
        return h, tape

    def backward(self, q: Params, cfg: dict, tape: list, dh: np.ndarray) -> Params:
        g: Params = {}
        for layer in range(cfg["n_layers"], 0, -1):
            h, near, deg, (s, d, w), xhat, inv, passed, same, _, _ = tape[layer]
            dy = dh * passed
            g[f"beta{layer}"], g[f"gamma{layer}"] = dy.sum(0), (dy * xhat).sum(0)
            dp = q[f"gamma{layer}"] * inv * (dy - dy.mean(0) - xhat * (dy * xhat).mean(0))
            g[f"ws{layer}"], g[f"wn{layer}"] = h[: len(dp)].T @ dp, near.T @ dp
            g[f"bs{layer}"] = g[f"bn{layer}"] = dp.sum(0)
            before = _sums(s, d, w, (dp @ q[f"wn{layer}"].T) / deg, len(h))
            before[: len(dp)] += dp @ q[f"ws{layer}"].T + (dh if same else 0.0)
            dh = before
        x, passed = tape[0]
        dh = dh * passed
        return g | {"w0": x.T @ dh, "b0": dh.sum(0)}

    def step(self, q: Params, cfg: dict, epoch: int) -> tuple[Params, float, Params]:
        """Gradient and mean loss over the seeds, and the moments of each layer and view."""
        views = [self.forward(q, cfg, epoch, view) for view in (1, 2)]
        out = [z for z, _ in views]
        grads, loss = contrast(out[0], out[1], cfg["temperature"])
        total: Params = {}
        moments: Params = {}
        for view, ((_, tape), dz) in enumerate(zip(views, grads, strict=True), start=1):
            for name, a in self.backward(q, cfg, tape, dz).items():
                total[name] = total.get(name, 0.0) + a
            for layer in range(1, cfg["n_layers"] + 1):
                mean, var = tape[layer][-2:]
                rows = len(tape[layer][4])
                moments |= {f"mean{layer}.{view}": mean, f"var{layer}.{view}": var * rows / max(rows - 1, 1)}
        return total, loss, moments


def contrast(z1: np.ndarray, z2: np.ndarray, temperature: float) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """Gradients by two views' outputs and the mean loss: each row against its other view, all others are negatives."""
    z = np.concatenate([z1, z2])
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    norm[norm == 0] = 1.0
    u, n = z / norm, len(z1)
    partner = np.r_[np.arange(n) + n, np.arange(n)]
    sim = u @ u.T / temperature
    positive = sim[np.arange(2 * n), partner]
    np.fill_diagonal(sim, -np.inf)
    top = sim.max(1, keepdims=True)
    e = np.exp(sim - top)
    total = e.sum(1, keepdims=True)
    loss = float((np.log(total) + top)[:, 0].mean() - positive.mean())
    share = e / total
    share[np.arange(2 * n), partner] -= 1.0
    du = (share + share.T) @ u / (2 * n * temperature)
    dz = (du - u * (u * du).sum(1, keepdims=True)) / norm
    return (dz[:n], dz[n:]), loss


def train_epoch(packed: DataFrame, params: Params, n: int, n_in: int, cfg: dict, epoch: int) -> Params:
    """Flat sums over all batches, weighted by their seeds: gradient, loss, and moments."""
    handle = packed.sparkSession.sparkContext.broadcast(params)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Params = {}
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                batch = Batch(row, n_in)
                grads, loss, moments = batch.step(handle.value, cfg, epoch)
                for name, a in (grads | moments | {"loss": np.array([loss])}).items():
                    total[name] = total.get(name, 0.0) + a * (batch.counts[0] / n)
        if total:
            yield as_chunks(total)

    sums = sum_over_tasks(packed.mapInPandas(run, SUM_SCHEMA), two_levels=n > FEW * cfg["batch_nodes"])
    handle.destroy()
    return sums


def fit_sampled_encoder(edges: DataFrame, features: DataFrame, vocabulary: DataFrame, config: dict | None = None) -> tuple[DataFrame, Params, list[float]]:
    """Train on directed edges (src, dst, w) and (attr_id, features); returns unit vectors, parameters and losses.

    vocabulary is (attr_id, idx) with idx from 0 and covers all nodes.
    """
    cfg = known_settings(SAMPLED_DEFAULTS, config)
    spark = edges.sparkSession
    edges, n = materialize(edges), vocabulary.count()
    n_in = features.select(F.size("features")).first()[0]
    params = GE.init_params(n_in, cfg["hidden_dim"], cfg["dim"], cfg["n_layers"], cfg["seed"])
    running, adam, losses = GE.init_running(params, cfg["n_layers"]), Adam(cfg["lr"]), []
    fans = fan_outs(n, cfg["n_layers"], cfg["batch_nodes"], cfg["hop_edges"])
    widest = edges.groupBy("dst").count().agg(F.max("count")).first()[0] or 0
    drawn = n > cfg["batch_nodes"] or widest > min(fans)  # otherwise each drawing would give the same batch
    scratch, packed = None, None
    for epoch in range(cfg["epochs"]):
        if packed is None or (drawn and epoch % cfg["resample"] == 0):
            if scratch:
                scratch.release()
            scratch, turn = Scratch(spark), epoch // cfg["resample"]
            seeds = seed_batches(vocabulary, n, cfg["batch_nodes"], cfg["seed"], turn)
            packed = scratch.keep(packed_batches(*walk(edges, seeds, fans, cfg["seed"], turn, scratch), features, cfg["n_layers"]))
        sums = train_epoch(packed, params, n, n_in, cfg, epoch)
        params = dict(params)
        adam.step(params, shaped(sums, params))
        losses.append(float(sums["loss"][0]))
        for name in running:
            for view in (1, 2):
                running[name] = (1 - BN_MOMENTUM) * running[name] + BN_MOMENTUM * sums[f"{name}.{view}"]
    if scratch:
        scratch.release()
    cells, nodes = materialize(GE.edge_cells(edges, vocabulary)), materialize(GE.node_blocks(features, vocabulary))
    raw = GE.graph_encode(cells, nodes, params, running, cfg, n_in)
    return raw.select("attr_id", l2_normalize("vector").alias("vector")), params | running, losses
