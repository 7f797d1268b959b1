"""Graph encoder and its contrastive training, full-batch and spread over blocks of nodes.

Nodes are numbered and cut into blocks of BLOCK rows; edges into cells (source
block, target block). A layer is a join of edge cells with node blocks, a product
per cell, and a sum per target block; the loss takes the nodes in batches of blocks,
dealt anew each epoch, and each node's negatives are the other nodes of its batch.
Backward passes run the same joins the other way. Partial sums are added up in every
task before they meet. What a task holds is a few blocks, whatever the size of the
graph; the driver sees batch statistics, the loss and the gradient. Intermediate blocks are written to the shared folder, so a lost
executor costs a re-read, and dropped after the epoch.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize
from ..session import Scratch, materialize
from .alignment import BN_EPS, BN_MOMENTUM, unit_rows
from .params import SUM_SCHEMA, Adam, Params, as_chunks, known_settings, linear_init, shaped, sum_over_tasks

# Configuration defaults.
GRAPH_DEFAULTS = {
    "dim": 64, "hidden_dim": 128, "n_layers": 3, "drop_edge_prob": 0.2, "drop_feat_prob": 0.1,
    "temperature": 0.5, "epochs": 100, "lr": 0.001, "use_household_edges": True, "min_cooccur": 3, "seed": 42,
    "dropout": 0.2,
} | {"batch_blocks": 8}  # blocks of nodes that are each other's negatives in an epoch; with no more blocks, all are
BLOCK = 1024
HELD_SUMS = 32
SLICE_EDGES = 1 << 16

NODE = "view int, blk int, m binary"
STATE = "view int, blk int, h binary, nb binary, deg binary, p binary, sums binary"
GRAD = "view int, blk int, h binary, nb binary, deg binary, p binary, dh binary, sums binary"
PART = "view int, blk int, m binary, deg binary, loss double"


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.float64).tobytes()


def _rows(b: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(b).reshape(-1, dim)


def init_params(n_in: int, hidden: int, out: int, n_layers: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    p: Params = {}
    p["w0"], p["b0"] = linear_init(rng, n_in, hidden)
    for i in range(1, n_layers + 1):
        width = out if i == n_layers else hidden
        p[f"ws{i}"], p[f"bs{i}"] = linear_init(rng, hidden, width)
        p[f"wn{i}"], p[f"bn{i}"] = linear_init(rng, hidden, width)
        p[f"gamma{i}"], p[f"beta{i}"] = np.ones(width), np.zeros(width)
    return p


def init_running(params: Params, n_layers: int) -> Params:
    """Running batch-norm statistics."""
    return {f"{k}{i}": a for i in range(1, n_layers + 1)
            for k, a in (("mean", np.zeros_like(params[f"beta{i}"])), ("var", np.ones_like(params[f"beta{i}"])))}


def edge_cells(edges: DataFrame, vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """Directed edges (src, dst, w) as packed cells (sb, db, s, d, w); a cell has at most block^2 entries."""
    def ends(side: str, pos: str) -> DataFrame:
        return vocabulary.select(F.col("attr_id").alias(side), F.col("idx").cast("int").alias(pos))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["si", "di"])
        return pd.DataFrame([(
            pdf["sb"].iloc[0], pdf["db"].iloc[0],
            (pdf["si"] % block).to_numpy(np.int32).tobytes(), (pdf["di"] % block).to_numpy(np.int32).tobytes(),
            _bytes(pdf["w"].to_numpy()),
        )], columns=["sb", "db", "s", "d", "w"])

    numbered = (
        edges.join(ends("src", "si"), "src").join(ends("dst", "di"), "dst")
        .withColumn("sb", F.expr(f"cast(si div {block} AS int)")).withColumn("db", F.expr(f"cast(di div {block} AS int)"))
    )
    return numbered.select("sb", "db", "si", "di", "w").groupBy("sb", "db").applyInPandas(
        pack, "sb int, db int, s binary, d binary, w binary"
    )


def node_blocks(features: DataFrame, vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(attr_id, features) as packed (blk, ids, m); a block has at most `block` rows, in vocabulary order."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        return pd.DataFrame([(pdf["blk"].iloc[0], pdf["attr_id"].tolist(), _bytes(np.stack(pdf["features"])))],
                            columns=["blk", "ids", "m"])

    numbered = features.join(vocabulary, "attr_id").withColumn("blk", F.expr(f"cast(idx div {block} AS int)"))
    return numbered.select("blk", "idx", "attr_id", "features").groupBy("blk").applyInPandas(
        pack, "blk int, ids array<string>, m binary"
    )


@dataclass
class _Pass:
    """One forward (and backward) pass: the graph, the model, and the random draws that belong to it."""

    edges: DataFrame
    nodes: DataFrame
    model: Broadcast
    n_in: int
    n_layers: int
    block: int
    cfg: dict
    epoch: int | None = None  # None: inference, nothing is dropped
    scratch: Scratch | None = None

    def width(self, layer: int) -> int:
        return self.cfg["dim"] if layer == self.n_layers else self.cfg["hidden_dim"]

    def rng(self, *key: int) -> np.random.Generator:
        return np.random.default_rng([self.cfg["seed"], self.epoch, *key])

    def state(self):
        """What the tasks need of this pass; DataFrames stay on the driver."""
        return _Task(self.model, self.n_in, self.n_layers, self.block, self.cfg, self.epoch)


class _Task(_Pass):
    """The part of a pass that is sent to tasks, with the arithmetic on single blocks."""

    def __init__(self, model, n_in, n_layers, block, cfg, epoch):
        super().__init__(None, None, model, n_in, n_layers, block, cfg, epoch)

    def masked_input(self, m: bytes, view: int, blk: int) -> np.ndarray:
        x = _rows(m, self.n_in)
        if self.epoch is None:
            return x
        return x * (self.rng(1, view, blk).random(x.shape) > self.cfg["drop_feat_prob"])

    def project(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.model.value["w0"] + self.model.value["b0"], 0)

    def cell(self, r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sources, targets and weights of an edge cell, after edge dropout."""
        s, d, w = np.frombuffer(r.s, np.int32), np.frombuffer(r.d, np.int32), np.frombuffer(r.w)
        if self.epoch is not None:
            kept = self.rng(2, r.view, r.sb, r.db).random(len(w)) > self.cfg["drop_edge_prob"]
            s, d, w = s[kept], d[kept], w[kept]
        return s, d, w

    def activate(self, layer: int, r, stats) -> tuple:
        """(next h, x-hat, 1/std, mask of what passes) of a block row at a layer."""
        q, d = self.model.value, self.width(layer)
        h, p = _rows(r.h, self.cfg["hidden_dim"]), _rows(r.p, d)
        mean, var = stats[r.view]
        inv = 1.0 / np.sqrt(var + BN_EPS)
        xhat = (p - mean) * inv
        y = xhat * q[f"gamma{layer}"] + q[f"beta{layer}"]
        passed = np.ones_like(y)
        if layer < self.n_layers:
            passed = (y > 0).astype(float)
            if self.epoch is not None:
                drawn = self.rng(3, layer, r.view, r.blk).random(y.shape)
                passed *= (drawn >= self.cfg["dropout"]) / (1 - self.cfg["dropout"])
        out = y * passed
        return (h + out if h.shape == out.shape else out), xhat, inv, passed


def _weighted_sum(to: np.ndarray, source: np.ndarray, w: np.ndarray, m: np.ndarray) -> np.ndarray:
    """For each target the sum of w * m[source] over its edges; as many rows as the largest target needs."""
    out = np.zeros((int(to.max()) + 1 if len(to) else 0, m.shape[1]))
    order = np.argsort(to, kind="stable")
    for lo in range(0, len(order), SLICE_EDGES):
        at = order[lo : lo + SLICE_EDGES]
        first = np.flatnonzero(np.r_[True, np.diff(to[at]) != 0])
        out[to[at][first]] += np.add.reduceat(w[at, None] * m[source[at]], first, axis=0)
    return out


def _longer_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two flat arrays; the shorter one counts as zero beyond its end."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    a = a.copy()
    a[: len(b)] += b
    return a


def _presummed(parts: DataFrame) -> DataFrame:
    """PART rows added up by block within each task, a bounded number of blocks at a time."""
    def run(batches):
        held: dict[tuple[int, int], list] = {}

        def frame():
            rows = [(*k, m.tobytes(), d.tobytes(), loss) for k, (m, d, loss) in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["view", "blk", "m", "deg", "loss"])

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                new = np.frombuffer(r.m), np.frombuffer(r.deg), r.loss
                old = held.get((r.view, r.blk))
                held[r.view, r.blk] = new if old is None else (_longer_sum(old[0], new[0]), _longer_sum(old[1], new[1]), old[2] + new[2])
                if len(held) > HELD_SUMS:
                    yield frame()
        if held:
            yield frame()

    return parts.mapInPandas(run, PART)


def _per_row(df: DataFrame, fn, schema: str) -> DataFrame:
    """fn(row) -> iterable of tuples, over rows that are whole blocks."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                out = list(fn(r))
                if out:
                    yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def _combine(own: DataFrame, parts: DataFrame, fn, schema: str) -> DataFrame:
    """fn(own row, part rows) -> tuple, for each (view, blk)."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = [fn(r, right) for r in left.itertuples(index=False)]
        return pd.DataFrame(rows, columns=names)

    keys = ["view", "blk"]
    return own.groupBy(keys).cogroup(_presummed(parts).groupBy(keys)).applyInPandas(run, schema)


def _total(parts: pd.DataFrame, column: str, dim: int, n: int) -> np.ndarray:
    total = np.zeros((n, dim))
    for b in parts[column]:
        rows = _rows(b, dim)[:n]
        total[: len(rows)] += rows
    return total


def _input_blocks(run: _Pass, views: list[int]) -> DataFrame:
    """(view, blk, m): first hidden blocks."""
    t = run.state()
    seen = run.nodes.select("blk", "m").withColumn("view", F.explode(F.array(*[F.lit(v) for v in views])))

    def project(r):
        yield r.view, r.blk, _bytes(t.project(t.masked_input(r.m, r.view, r.blk)))

    return _per_row(seen.select("view", "blk", "m"), project, NODE)


def _convolve(run: _Pass, layer: int, h: DataFrame) -> DataFrame:
    """STATE rows of a layer: own input, neighbour mean, degree, and the linear map of both."""
    t, hidden = run.state(), run.cfg["hidden_dim"]

    def message(r):
        s, d, w = t.cell(r)
        yield r.view, r.db, _bytes(_weighted_sum(d, s, w, _rows(r.m, hidden))), _bytes(np.bincount(d, w)), 0.0

    def combine(r, parts):
        m = _rows(r.m, hidden)
        deg = np.maximum(_total(parts, "deg", 1, len(m)), 1.0)
        nb = _total(parts, "m", hidden, len(m)) / deg
        q = t.model.value
        p = m @ q[f"ws{layer}"] + q[f"bs{layer}"] + nb @ q[f"wn{layer}"] + q[f"bn{layer}"]
        sums = np.concatenate([[len(p)], p.sum(0), (p * p).sum(0)])
        return r.view, r.blk, r.m, _bytes(nb), _bytes(deg), _bytes(p), _bytes(sums)

    met = run.edges.join(h.withColumnRenamed("blk", "sb"), "sb")
    return _combine(h, _per_row(met, message, PART), combine, STATE)


def _view_sums(blocks: DataFrame) -> dict[int, np.ndarray]:
    """The sums of all blocks of a view: one short row per block."""
    out: dict[int, np.ndarray] = {}
    for r in blocks.select("view", "sums").collect():
        out[r["view"]] = out.get(r["view"], 0.0) + np.frombuffer(r["sums"])
    return out


def _batch_stats(run: _Pass, layer: int, state: DataFrame) -> dict:
    """Mean and population variance per view, and the number of nodes."""
    d, out = run.width(layer), {}
    for view, s in _view_sums(state).items():
        mean = s[1 : d + 1] / s[0]
        out[view] = (mean, np.maximum(s[d + 1 :] / s[0] - mean * mean, 0.0))
        out["n"] = s[0]
    return out


def _activated(run: _Pass, layer: int, state: DataFrame, stats: dict) -> DataFrame:
    t = run.state()
    return _per_row(state, lambda r: [(r.view, r.blk, _bytes(t.activate(layer, r, stats)[0]))], NODE)


def graph_encode(
    edges: DataFrame, nodes: DataFrame, params: Params, running: Params, cfg: dict, n_in: int, block: int = BLOCK
) -> DataFrame:
    """(attr_id, vector): inference over edge cells and node blocks with running statistics, not normalised."""
    run = _Pass(edges, nodes, nodes.sparkSession.sparkContext.broadcast(params), n_in, cfg["n_layers"], block, cfg)
    h = _input_blocks(run, [0])
    for layer in range(1, run.n_layers + 1):
        stats = {0: (running[f"mean{layer}"], running[f"var{layer}"])}
        h = _activated(run, layer, _convolve(run, layer, h), stats)
    dim = cfg["dim"]
    named = h.join(nodes.select("blk", "ids"), "blk").select("ids", "m")

    def unpack(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                yield pd.DataFrame({"attr_id": list(r.ids), "vector": list(_rows(r.m, dim))})

    return named.mapInPandas(unpack, "attr_id string, vector array<double>")


def dealt(n_blocks: int, per_batch: int, seed: int, epoch: int) -> tuple[int, int, int]:
    """(a, inverse of a, c) of the permutation x -> (a x + c) mod n_blocks whose runs of per_batch blocks are the batches."""
    rng = np.random.default_rng([seed, epoch, 4])
    a = next(k for k in range(int(rng.integers(1, max(2, n_blocks))), 2 * n_blocks + 1) if np.gcd(k, n_blocks) == 1)
    return a, pow(a, -1, n_blocks) if n_blocks > 1 else 0, int(rng.integers(0, n_blocks))


def _met_blocks(run: _Pass, left: DataFrame, n_blocks: int) -> DataFrame:
    """Every block of both views next to every other of its batch, by an equi-join on block numbers."""
    per = min(run.cfg["batch_blocks"], n_blocks)
    a, inverse, c = dealt(n_blocks, per, run.cfg["seed"], run.epoch)
    first = f"pmod(blk * {a}L + {c}L, {n_blocks}L) div {per} * {per}"
    block = f"cast(pmod((x - {c}L) * {inverse}L, {n_blocks}L) AS int)"
    members = f"transform(sequence({first}, least({first} + {per}, {n_blocks}L) - 1), x -> array(struct(1 AS v, {block} AS b), struct(2 AS v, {block} AS b)))"
    other = left.select(*[F.col(c).alias(f"o_{c}") for c in left.columns])
    wanted = left.withColumn("t", F.explode(F.expr(f"flatten({members})")))
    return wanted.join(other, (F.col("t.v") == F.col("o_view")) & (F.col("t.b") == F.col("o_blk"))).drop("t")


def _loss_parts(run: _Pass, z: DataFrame, n: int) -> DataFrame:
    """PART rows whose m is the loss gradient by unit vector, and whose loss adds up to the mean loss over in-batch negatives."""
    dim, tau = run.cfg["dim"], run.cfg["temperature"]
    n_blocks = -(-n // run.block)

    def affinity(r):
        u, o = unit_rows(_rows(r.m, dim)), unit_rows(_rows(r.o_m, dim))
        e = np.exp((u @ o.T - 1.0) / tau)
        if r.view == r.o_view and r.blk == r.o_blk:
            np.fill_diagonal(e, 0.0)
        return u, o, e

    def exp_sums(r):
        yield r.view, r.blk, _bytes(affinity(r)[2].sum(1)), b"", 0.0

    def with_total(r, parts):
        return r.view, r.blk, r.m, _bytes(_total(parts, "m", 1, len(_rows(r.m, dim))))

    sums = _per_row(_met_blocks(run, z, n_blocks), exp_sums, PART)
    known = run.scratch.keep(_combine(z, sums, with_total, NODE + ", e binary"))

    def gradients(r):
        u, o, e = affinity(r)
        own, theirs = _rows(r.e, 1), _rows(r.o_e, 1).T
        du = (e / own + e / theirs) @ o
        loss = 0.0
        if r.blk == r.o_blk and r.view != r.o_view:
            du = du - 2.0 * o
            loss = float((np.log(own[:, 0]) + 1.0 / tau - (u * o).sum(1) / tau).sum()) / (2 * n)
        yield r.view, r.blk, _bytes(du / (2 * n * tau)), b"", loss

    return _per_row(_met_blocks(run, known, n_blocks), gradients, PART)


def _with_gradient(run: _Pass, layer: int, state: DataFrame, stats: dict, parts: DataFrame) -> DataFrame:
    """GRAD rows: state with the gradient by the layer's output, and what batch norm needs to sum: loss, dy, dy * x-hat."""
    t, d, last = run.state(), run.width(layer), layer == run.n_layers

    def combine(r, parts):
        out, xhat, _, passed = t.activate(layer, r, stats)
        dh = _total(parts, "m", d, len(out))
        if last:
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            norm = np.where(norm == 0, 1.0, norm)
            u = out / norm
            dh = (dh - u * (u * dh).sum(1, keepdims=True)) / norm
        dy = dh * passed
        sums = np.concatenate([[parts["loss"].sum()], dy.sum(0), (dy * xhat).sum(0)])
        return r.view, r.blk, r.h, r.nb, r.deg, r.p, _bytes(dh), _bytes(sums)

    return _combine(state, parts, combine, GRAD)


def _dp(t: _Task, layer: int, r, stats: dict, sums: dict):
    """Gradient by the layer's linear output, and the arrays around it."""
    d = t.width(layer)
    _, xhat, inv, passed = t.activate(layer, r, stats)
    dh = _rows(r.dh, d)
    dy_sum, dyx_sum = sums[r.view]
    n = stats["n"]
    dp = t.model.value[f"gamma{layer}"] * inv * (dh * passed - dy_sum / n - xhat * dyx_sum / n)
    return dp, dh


def _back_parts(run: _Pass, layer: int, grads: DataFrame, stats: dict, sums: dict) -> DataFrame:
    """PART rows that add up to the gradient by the layer's input."""
    t, hidden = run.state(), run.cfg["hidden_dim"]

    def own(r):
        dp, dh = _dp(t, layer, r, stats, sums)
        m = dp @ t.model.value[f"ws{layer}"].T
        yield r.view, r.blk, _bytes(m + dh if m.shape == dh.shape else m), b"", 0.0

    def to_neighbours(r):
        dp, _ = _dp(t, layer, r, stats, sums)
        yield r.view, r.blk, _bytes((dp @ t.model.value[f"wn{layer}"].T) / _rows(r.deg, 1))

    def message(r):
        s, d, w = t.cell(r)
        yield r.view, r.sb, _bytes(_weighted_sum(s, d, w, _rows(r.m, hidden))), b"", 0.0

    by_target = _per_row(grads, to_neighbours, NODE).withColumnRenamed("blk", "db")
    return _per_row(grads, own, PART).unionByName(_per_row(run.edges.join(by_target, "db"), message, PART))


def _weight_grads(run: _Pass, layer: int, grads: DataFrame, stats: dict, sums: dict) -> DataFrame:
    t, hidden = run.state(), run.cfg["hidden_dim"]

    def partial(r):
        dp, _ = _dp(t, layer, r, stats, sums)
        g = {"ws": _rows(r.h, hidden).T @ dp, "bs": dp.sum(0), "wn": _rows(r.nb, hidden).T @ dp, "bn": dp.sum(0)}
        yield from as_chunks({f"{k}{layer}": a for k, a in g.items()}).itertuples(index=False, name=None)

    return _per_row(grads, partial, SUM_SCHEMA)


def _input_grads(run: _Pass, parts: DataFrame) -> DataFrame:
    t, hidden = run.state(), run.cfg["hidden_dim"]
    seen = run.nodes.select("blk", "m").withColumn("view", F.explode(F.array(F.lit(1), F.lit(2))))

    def combine(r, parts):
        x = t.masked_input(r.m, r.view, r.blk)
        da = _total(parts, "m", hidden, len(x)) * (t.project(x) > 0)
        return r.view, r.blk, _bytes(x.T @ da), _bytes(da.sum(0))

    both = _combine(seen.select("view", "blk", "m"), parts, combine, "view int, blk int, w binary, b binary")

    def chunks(r):
        yield from as_chunks({"w0": np.frombuffer(r.w), "b0": np.frombuffer(r.b)}).itertuples(index=False, name=None)

    return _per_row(both, chunks, SUM_SCHEMA)


def contrastive_gradient(run: _Pass, n: int) -> tuple[Params, float, list[dict]]:
    """Gradient, loss and batch statistics per layer of one full-batch contrastive step over two views."""
    h, states, stats = _input_blocks(run, [1, 2]), [], []
    for layer in range(1, run.n_layers + 1):
        states.append(run.scratch.keep(_convolve(run, layer, h)))
        stats.append(_batch_stats(run, layer, states[-1]))
        h = _activated(run, layer, states[-1], stats[-1])

    parts, flat, pieces, loss = _loss_parts(run, h, n), {}, None, 0.0
    for layer in range(run.n_layers, 0, -1):
        state, st = states[layer - 1], stats[layer - 1]
        grads = run.scratch.keep(_with_gradient(run, layer, state, st, parts))
        d = run.width(layer)
        found = _view_sums(grads)
        sums = {view: (v[1 : d + 1], v[d + 1 :]) for view, v in found.items()}
        loss += float(sum(v[0] for v in found.values()))
        flat[f"beta{layer}"] = sum(s[0] for s in sums.values())
        flat[f"gamma{layer}"] = sum(s[1] for s in sums.values())
        piece = _weight_grads(run, layer, grads, st, sums)
        pieces = piece if pieces is None else pieces.unionByName(piece)
        parts = _back_parts(run, layer, grads, st, sums)
    flat |= sum_over_tasks(pieces.unionByName(_input_grads(run, parts)), two_levels=False)
    return flat, loss, stats


def fit_graph_encoder(
    edges: DataFrame, features: DataFrame, vocabulary: DataFrame, config: dict | None = None, block: int = BLOCK
) -> tuple[DataFrame, Params, list[float]]:
    """Train on directed edges (src, dst, w) and (attr_id, features); returns unit vectors, parameters and losses.

    vocabulary is (attr_id, idx) with idx from 0 and covers all nodes.
    """
    cfg = known_settings(GRAPH_DEFAULTS, config)
    sc = edges.sparkSession.sparkContext
    n = vocabulary.count()
    n_in = features.select(F.size("features")).first()[0]
    cells, nodes = materialize(edge_cells(edges, vocabulary, block)), materialize(node_blocks(features, vocabulary, block))
    params = init_params(n_in, cfg["hidden_dim"], cfg["dim"], cfg["n_layers"], cfg["seed"])
    running, adam, losses = init_running(params, cfg["n_layers"]), Adam(cfg["lr"]), []
    for epoch in range(cfg["epochs"]):
        model = sc.broadcast(params)
        run = _Pass(cells, nodes, model, n_in, cfg["n_layers"], block, cfg, epoch, Scratch(edges.sparkSession))
        flat, loss, stats = contrastive_gradient(run, n)
        run.scratch.release()
        model.destroy()
        params = dict(params)
        adam.step(params, shaped(flat, params))
        losses.append(loss)
        for layer, st in enumerate(stats, start=1):
            for view in (1, 2):
                mean, var = st[view]
                for key, value in ((f"mean{layer}", mean), (f"var{layer}", var * n / max(n - 1, 1))):
                    running[key] = (1 - BN_MOMENTUM) * running[key] + BN_MOMENTUM * value
    raw = graph_encode(cells, nodes, params, running, cfg, n_in, block)
    return raw.select("attr_id", l2_normalize("vector").alias("vector")), params | running, losses
