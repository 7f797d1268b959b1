"""Alignment of attribute vectors to frozen item vectors: the model, its use and its training."""

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize, vec_dot
from ..session import materialize
from .blocks import BROADCAST_BYTES, to_matrix, vector_bytes
from .params import SUM_SCHEMA, Adam, Params, as_chunks, known_settings, linear_init, sum_over_tasks
from .ranking import with_global_rank
from .sampling import attach_vectors, indexed_profiles, positive_samples, train_val_split, uniform_draws

BN_EPS = 1e-5


def unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm == 0, 1.0, norm)


def align_rows(params: Params, x: np.ndarray) -> np.ndarray:
    """Inference: linear, ReLU, batch norm with running statistics, linear, unit length."""
    h = np.maximum(x @ params["w1"] + params["b1"], 0.0)
    h = (h - params["mean"]) / np.sqrt(params["var"] + BN_EPS) * params["gamma"] + params["beta"]
    return unit_rows(h @ params["w2"] + params["b2"])


def align_attributes(attr_vectors: DataFrame, params: Params) -> DataFrame:
    """(attr_id, vector): attribute vectors moved into the item space."""
    handle = attr_vectors.sparkSession.sparkContext.broadcast(params)

    def forward(batches):
        for batch in batches:
            if batch.num_rows:
                out = align_rows(handle.value, to_matrix(batch.column("vector")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("attr_id"), pa.array(list(out), pa.list_(pa.float64()))], ["attr_id", "vector"]
                )

    return attr_vectors.select("attr_id", "vector").mapInArrow(forward, "attr_id string, vector array<double>")


def align_logits(triples: DataFrame, params: Params) -> DataFrame:
    """(item_id, pos_attr, slot, logit) of rows from attach_vectors(): slot 0 is the positive, then the negatives."""
    temperature = float(params["temperature"])
    long = triples.select(
        "item_id", "pos_attr", l2_normalize("item_vector").alias("item"),
        F.posexplode(F.concat(F.array("pos_vector"), "neg_vectors")).alias("slot", "vector"),
    )
    handle = triples.sparkSession.sparkContext.broadcast(params)

    def forward(batches):
        for batch in batches:
            if batch.num_rows:
                out = align_rows(handle.value, to_matrix(batch.column("vector")))
                at = batch.schema.get_field_index("vector")
                yield batch.set_column(at, "vector", pa.array(list(out), pa.list_(pa.float64())))

    aligned = long.select("item_id", "pos_attr", "slot", "item", "vector").mapInArrow(
        forward, "item_id string, pos_attr string, slot int, item array<double>, vector array<double>"
    )
    return aligned.select("item_id", "pos_attr", "slot", (vec_dot("item", "vector") / temperature).alias("logit"))


# Configuration defaults.
ALIGN_DEFAULTS = {
    "train_ratio": 0.8, "batch_size": 256, "negatives_per_pos": 5, "hidden_dim": 128,
    "output_dim": 64, "dropout": 0.2, "epochs": 10, "lr": 0.001, "seed": 42,
}
SHARD_ROWS = 16_384
START_TEMPERATURE = 0.07
BN_MOMENTUM = 0.1


def init_params(dim: int, hidden: int, out: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    w1, b1 = linear_init(rng, dim, hidden)
    w2, b2 = linear_init(rng, hidden, out)
    return {
        "w1": w1, "b1": b1, "gamma": np.ones(hidden), "beta": np.zeros(hidden), "w2": w2, "b2": b2,
        "temperature": np.array(START_TEMPERATURE), "mean": np.zeros(hidden), "var": np.ones(hidden),
    }


def _tower(params: Params, x: np.ndarray, keep: np.ndarray):
    """Training forward pass of the attribute tower and its backward pass."""
    a = x @ params["w1"] + params["b1"]
    h = np.maximum(a, 0)
    mean, var = h.mean(0), h.var(0)
    inv = 1.0 / np.sqrt(var + BN_EPS)
    xhat = (h - mean) * inv
    y = (xhat * params["gamma"] + params["beta"]) * keep
    o = y @ params["w2"] + params["b2"]
    norm = np.linalg.norm(o, axis=1, keepdims=True)
    norm = np.where(norm == 0, 1.0, norm)
    u = o / norm

    def backward(du: np.ndarray) -> Params:
        do = (du - u * (u * du).sum(1, keepdims=True)) / norm
        dy = (do @ params["w2"].T) * keep
        dx = dy * params["gamma"]
        dh = inv * (dx - dx.mean(0) - xhat * (dx * xhat).mean(0)) * (a > 0)
        return {
            "w2": y.T @ do, "b2": do.sum(0), "gamma": (dy * xhat).sum(0), "beta": dy.sum(0),
            "w1": x.T @ dh, "b1": dh.sum(0),
        }

    return u, backward, mean, var


def cross_entropy(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss per row for class 0, and the softmax."""
    top = logits.max(1, keepdims=True)
    e = np.exp(logits - top)
    total = e.sum(1, keepdims=True)
    return (np.log(total) + top - logits[:, :1])[:, 0], e / total


def train_gradient(params: Params, item, pos, neg, keep_pos, keep_neg):
    """Gradient, loss and batch statistics of one mini-batch; neg is [batch * k, dim] in row order."""
    n, k = len(pos), len(neg) // len(pos)
    u = unit_rows(item)
    p, back_p, mean_p, var_p = _tower(params, pos, keep_pos)
    q, back_q, mean_q, var_q = _tower(params, neg, keep_neg)
    q3, t = q.reshape(n, k, -1), float(params["temperature"])
    logits = np.concatenate([(u * p).sum(1, keepdims=True), np.einsum("nkd,nd->nk", q3, u)], axis=1) / t
    loss, soft = cross_entropy(logits)
    d = soft
    d[:, 0] -= 1.0
    d /= n
    gp, gq = back_p(d[:, :1] * u / t), back_q((d[:, 1:, None] * u[:, None, :] / t).reshape(n * k, -1))
    grads = {name: gp[name] + gq[name] for name in gp}
    grads["temperature"] = np.array(-(d * logits).sum() / t)
    return grads, float(loss.mean()), [(mean_p, var_p, n), (mean_q, var_q, n * k)]


def _expanded(batch: pa.RecordBatch | pa.Table, attrs: np.ndarray | None, k: int):
    """(item vectors, positive vectors, negative vectors) of a batch of training rows."""
    items = to_matrix(batch.column("vector"))
    if attrs is None:
        negatives = batch.column("neg_vectors")
        negatives = negatives.combine_chunks() if isinstance(negatives, pa.ChunkedArray) else negatives
        return items, to_matrix(batch.column("pos_vector")), to_matrix(pa.ListArray.flatten(negatives))
    pos, neg = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in map(batch.column, ("pos", "neg")))
    counts = np.diff(pos.offsets.to_numpy())
    return np.repeat(items, counts, axis=0), attrs[pos.flatten().to_numpy()], attrs[neg.flatten().to_numpy()]


def training_rows(profiles: DataFrame, attr_vectors: DataFrame, k: int, seed: int, epoch: int, indexed: bool) -> DataFrame:
    """Rows of one epoch with fresh negatives.

    Indexed: one row per item with positive and negative attribute numbers, for a broadcast
    attribute matrix. Otherwise one row per positive with the attribute vectors joined on.
    """
    draws = uniform_draws(k, seed, epoch)
    if indexed:
        negs = F.expr(f"flatten(transform(profile, p -> {draws}))")
        return profiles.select("item_id", "vector", F.expr("profile.idx").alias("pos"), negs.alias("neg"))
    triples = profiles.select(
        "item_id", F.expr(f"inline(transform(profile, p -> struct(p.idx AS pos_attr, {draws} AS neg_attrs)))")
    )
    joined = attach_vectors(triples, profiles, attr_vectors.select(F.col("idx").alias("attr_id"), "vector"))
    return joined.select("item_id", "pos_attr", F.col("item_vector").alias("vector"), "pos_vector", "neg_vectors")


def _row_order(table: pa.Table, indexed: bool) -> np.ndarray:
    """The order of the table's training rows by item and attribute number, however they arrived."""
    items = table.column("item_id").to_numpy(zero_copy_only=False).astype(str)
    if not indexed:
        return np.lexsort((table.column("pos_attr").to_numpy(), items))
    pos = table.column("pos").combine_chunks()
    pos = pos.combine_chunks() if isinstance(pos, pa.ChunkedArray) else pos
    return np.lexsort((pos.flatten().to_numpy(), np.repeat(items, np.diff(pos.offsets.to_numpy()))))


def train_epoch(
    rows: DataFrame, attrs, params: Params, adam: Adam, cfg: dict, epoch: int, shards: int = 1
) -> tuple[Params, Adam, float]:
    """One epoch: each shard of items runs mini-batch Adam on its rows from the shared start, then models and optimizer
    states are averaged by row count.

    Shards are hashes of the item, their rows are put in order and their seeds come from the shard, so that neither the
    number of tasks or cores nor the way the vectors arrive shapes the result. With one shard this is plain mini-batch
    training.
    """
    handle = rows.sparkSession.sparkContext.broadcast((params, adam))
    trained = [n for n in params if n not in ("mean", "var")]

    def local_sgd(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        model, opt = copy.deepcopy(handle.value)
        rng = np.random.default_rng([cfg["seed"], epoch, key[0].as_py()])
        k, keep_p = cfg["negatives_per_pos"], 1 - cfg["dropout"]
        item, pos, neg = _expanded(table, None if attrs is None else attrs.value, k)
        order = rng.permutation(_row_order(table, attrs is not None))
        loss_sum, hidden = 0.0, len(model["b1"])
        for lo in range(0, len(order), cfg["batch_size"]):
            at = order[lo : lo + cfg["batch_size"]]
            neg_at = (at[:, None] * k + np.arange(k)).ravel()
            masks = [(rng.random((m, hidden)) < keep_p) / keep_p for m in (len(at), len(neg_at))]
            grads, loss, stats = train_gradient(model, item[at], pos[at], neg[neg_at], *masks)
            opt.step(model, grads)
            for mean, var, m in stats:
                unbiased = var * m / max(m - 1, 1)
                model["mean"] = (1 - BN_MOMENTUM) * model["mean"] + BN_MOMENTUM * mean
                model["var"] = (1 - BN_MOMENTUM) * model["var"] + BN_MOMENTUM * unbiased
            loss_sum += loss * len(at)
        seen = len(order)
        state = {f"p.{n}": a * seen for n, a in model.items()}
        state |= {f"m.{n}": opt.m[n] * seen for n in trained} | {f"v.{n}": opt.v[n] * seen for n in trained}
        state["sums"] = np.array([seen, loss_sum, opt.t * seen])
        return pa.Table.from_pandas(as_chunks(state), preserve_index=False)

    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(shards)))
    sums = sum_over_tasks(sharded.groupBy("shard").applyInArrow(local_sgd, SUM_SCHEMA))
    handle.destroy()
    if not sums:
        raise ValueError("no training rows: no mapped attribute has both vectors")
    seen, loss_sum, t = sums["sums"]
    mean = {n: a / seen for n, a in sums.items()}
    new = {n: mean[f"p.{n}"].reshape(np.shape(a)) for n, a in params.items()}
    m, v = ({n: mean[f"{s}.{n}"].reshape(np.shape(params[n])) for n in trained} for s in ("m", "v"))
    return new, Adam(adam.lr, m, v, t / seen), float(loss_sum / seen)


def evaluate(rows: DataFrame, attrs, params: Params, cfg: dict) -> tuple[float | None, float | None]:
    """(mean loss, share of rows whose positive scores highest) in inference mode; nulls without rows."""
    handle = rows.sparkSession.sparkContext.broadcast(params)

    def score(batches):
        model, k = handle.value, cfg["negatives_per_pos"]
        matrix = None if attrs is None else align_rows(model, attrs.value)
        total = np.zeros(3)
        for batch in batches:
            if not batch.num_rows:
                continue
            item, p, q = _expanded(batch, matrix, k)
            if matrix is None:
                p, q = align_rows(model, p), align_rows(model, q)
            u = unit_rows(item)
            logits = np.concatenate(
                [(u * p).sum(1, keepdims=True), np.einsum("nkd,nd->nk", q.reshape(len(p), k, -1), u)], axis=1
            ) / float(model["temperature"])
            total += [len(p), cross_entropy(logits)[0].sum(), (logits.argmax(1) == 0).sum()]
        yield pa.RecordBatch.from_pydict({"n": [total[0]], "loss": [total[1]], "hits": [total[2]]})

    n, loss, hits = (
        rows.mapInArrow(score, "n double, loss double, hits double").agg(F.sum("n"), F.sum("loss"), F.sum("hits")).first()
    )
    handle.destroy()
    return (loss / n, hits / n) if n else (None, None)


def best_epoch(history: DataFrame) -> DataFrame:
    """One row (epoch, val_loss): the first epoch of the smallest validation loss; the last epoch where there is none."""
    known = F.col("val_loss").isNotNull()
    order = F.when(known, F.struct("val_loss", "epoch"))
    return history.agg(
        F.coalesce(F.min_by("epoch", order), F.max("epoch")).alias("epoch"), F.min("val_loss").alias("val_loss")
    )


def train_alignment(
    item_attrs: DataFrame,
    item_vectors: DataFrame,
    attr_vectors: DataFrame,
    config: dict | None = None,
    partitions: int | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    shard_rows: int = SHARD_ROWS,
) -> dict:
    """Train the attribute tower; returns history, metrics, and best and final parameters.

    history rows are (epoch, train_loss, val_loss, val_acc). 'best' is the epoch of the strictly smallest validation loss,
    or the last epoch if there are no validation rows; losses and accuracy are null then. Attribute vectors are broadcast
    when their checked size fits, joined onto the rows otherwise; the model is the same either way, and for any number of
    partitions.
    """
    cfg = known_settings(ALIGN_DEFAULTS, config)
    spark, seed = item_attrs.sparkSession, cfg["seed"]
    vocabulary = materialize(with_global_rank(attr_vectors.select("attr_id", "vector"), F.col("attr_id"), "idx"))
    split = train_val_split(item_vectors, cfg["train_ratio"], seed)
    positives = positive_samples(item_attrs, item_vectors, attr_vectors)
    profiles = (
        indexed_profiles(positives, vocabulary)
        .join(item_vectors.select("item_id", "vector"), "item_id")
        .join(split, "item_id")
    )
    profiles = materialize(profiles.repartition(partitions or spark.sparkContext.defaultParallelism, "item_id"))
    dim, width = vocabulary.select(F.size("vector")).first()[0], item_vectors.select(F.size("vector")).first()[0]
    if width != cfg["output_dim"]:
        raise ValueError(f"item vectors have {width} dimensions, the model gives {cfg['output_dim']}")
    n_rows = profiles.where("split = 'train'").agg(F.sum(F.size("profile"))).first()[0] or 0
    shards = max(1, -(-n_rows // shard_rows))

    _, size = vector_bytes(vocabulary)
    attrs = None
    if size <= limit_bytes:
        table = vocabulary.select("idx", "vector").toArrow().sort_by("idx")
        attrs = spark.sparkContext.broadcast(to_matrix(table.column("vector")))

    def rows(part: str, epoch: int) -> DataFrame:
        chosen = profiles.where(F.col("split") == part)
        return training_rows(chosen, vocabulary, cfg["negatives_per_pos"], seed, epoch, attrs is not None)

    params = init_params(dim, cfg["hidden_dim"], cfg["output_dim"], seed)
    adam, best, best_loss, history = Adam(cfg["lr"]), None, None, []
    for epoch in range(cfg["epochs"]):
        params, adam, train_loss = train_epoch(rows("train", epoch), attrs, params, adam, cfg, epoch, shards)
        val_loss, val_acc = evaluate(rows("val", epoch), attrs, params, cfg)
        history.append((epoch + 1, train_loss, val_loss, val_acc))
        if val_loss is not None and (best_loss is None or val_loss < best_loss):
            best, best_loss = params, val_loss
    metrics = {
        "best_val_loss": best_loss, "final_val_loss": history[-1][2],
        "final_val_acc": history[-1][3], "final_train_loss": history[-1][1],
    }
    frame = spark.createDataFrame(history, "epoch int, train_loss double, val_loss double, val_acc double")
    return {"history": frame, "metrics": metrics, "best": params if best is None else best, "final": params}


def write_training(result: dict, history_path: str, metrics_path: str) -> None:
    """History as CSV with a header, metrics as one JSON row."""
    history = result["history"]
    history.coalesce(1).orderBy("epoch").write.mode("overwrite").option("header", True).csv(history_path)
    metrics = {k: None if v is None else float(v) for k, v in result["metrics"].items()}
    row = history.sparkSession.createDataFrame([tuple(metrics.values())], ", ".join(f"{k} double" for k in metrics))
    row.coalesce(1).write.mode("overwrite").json(metrics_path)
