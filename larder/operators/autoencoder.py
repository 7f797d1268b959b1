"""Denoising autoencoder over co-occurrence rows, trained by exact data-parallel full-batch steps.

The loss is a mean over all cells, so its gradient is a sum over rows: each task
sums the gradient of its rows, the sums are added on the executors, and one copy
of the model comes back to the driver. Random masks are seeded by row, so the
result does not depend on how rows are spread over tasks. Models too large for that
are trained in blocks (blocked_autoencoder.py).
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform
from ..session import materialize
from .alignment import unit_rows
from .blocked_autoencoder import DROPOUT, fit_in_blocks
from .params import SUM_SCHEMA, Adam, Params, as_chunks, known_settings, linear_init, shaped, sum_over_tasks

# Configuration defaults.
AE_DEFAULTS = {
    "source": "item", "latent_dim": 64, "hidden_dim": 256, "epochs": 40,
    "noise_prob": 0.2, "pmi_shift": 1.0, "lr": 0.001, "batch_size": 256, "seed": 42,
}
MODEL_BYTES = 64 << 20  # a larger model is kept and stepped in blocks
ROWS_PER_STEP = 64


def init_params(n: int, hidden: int, latent: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    out: Params = {}
    for i, (a, b) in enumerate([(n, hidden), (hidden, latent), (latent, hidden), (hidden, n)], start=1):
        out[f"w{i}"], out[f"b{i}"] = linear_init(rng, a, b)
    return out


def matrix_rows(cells: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(attr_id, idx, cells array<struct<j, w, dst>>): sparse rows, empty for attributes without cells.

    vocabulary is (attr_id, idx); a row holds at most the vocabulary.
    """
    at = vocabulary.select(F.col("attr_id").alias("dst"), F.col("idx").cast("int").alias("j"))
    rows = (
        cells.join(at, "dst").groupBy(F.col("src").alias("attr_id"))
        .agg(F.array_sort(F.collect_list(F.struct("j", "w", "dst"))).alias("cells"))
    )
    none = F.array().cast("array<struct<j:int,w:double,dst:string>>")
    return vocabulary.join(rows, "attr_id", "left").select(
        "attr_id", F.col("idx").cast("int").alias("idx"), F.coalesce("cells", none).alias("cells")
    )


def gradient(params: Params, x: np.ndarray, x_noisy: np.ndarray, keep1, keep2, n_cells: float) -> tuple[Params, float]:
    """Gradient and loss contribution of some rows; keep1 and keep2 are the scaled dropout masks."""
    a1 = x_noisy @ params["w1"] + params["b1"]
    h1 = np.maximum(a1, 0) * keep1
    z = h1 @ params["w2"] + params["b2"]
    a2 = z @ params["w3"] + params["b3"]
    h2 = np.maximum(a2, 0) * keep2
    diff = h2 @ params["w4"] + params["b4"] - x
    d = 2.0 * diff / n_cells
    g = {"w4": h2.T @ d, "b4": d.sum(0)}
    d = (d @ params["w4"].T) * keep2 * (a2 > 0)
    g |= {"w3": z.T @ d, "b3": d.sum(0)}
    d = d @ params["w3"].T
    g |= {"w2": h1.T @ d, "b2": d.sum(0)}
    d = (d @ params["w2"].T) * keep1 * (a1 > 0)
    g |= {"w1": x_noisy.T @ d, "b1": d.sum(0)}
    return g, float((diff * diff).sum() / n_cells)


def _dense(batch: pa.RecordBatch, n: int, column: str = "w") -> np.ndarray:
    cells = batch.column("cells")
    row = np.repeat(np.arange(batch.num_rows), np.diff(cells.offsets.to_numpy()))
    flat = cells.flatten()
    x = np.zeros((batch.num_rows, n))
    x[row, flat.field("j").to_numpy()] = flat.field(column).to_numpy(zero_copy_only=False)
    return x


def _epoch_rows(rows: DataFrame, noise: float, seed: int, epoch: int) -> DataFrame:
    """Sparse rows with the noisy value of each cell: 0 with probability `noise`, drawn as in denoise_mask()."""
    def noisy(c):
        u = hash_uniform(F.lit(seed), F.lit(epoch), F.col("attr_id"), c["dst"])
        return F.struct(c["j"].alias("j"), c["w"].alias("w"), F.when(u > noise, c["w"]).otherwise(0.0).alias("noisy"))

    return rows.select("idx", F.transform("cells", noisy).alias("cells"))


def train_epoch(rows: DataFrame, params: Params, n: int, noise: float, seed: int, epoch: int) -> tuple[Params, float]:
    """Gradient and loss of one full-batch step."""
    sc = rows.sparkSession.sparkContext
    handle = sc.broadcast(params)
    hidden = len(params["b1"])

    def partial(batches):
        model, total, loss = handle.value, None, 0.0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(lo, ROWS_PER_STEP)
                keep = np.stack([
                    np.random.default_rng([seed, epoch, i]).random(2 * hidden) >= DROPOUT
                    for i in part.column("idx").to_pylist()
                ]) / (1 - DROPOUT)
                g, part_loss = gradient(
                    model, _dense(part, n), _dense(part, n, "noisy"), keep[:, :hidden], keep[:, hidden:], float(n) * n
                )
                loss += part_loss
                total = g if total is None else {k: total[k] + g[k] for k in g}
        if total is not None:
            yield pa.RecordBatch.from_pandas(as_chunks(total | {"loss": np.array([loss])}), preserve_index=False)

    sums = sum_over_tasks(_epoch_rows(rows, noise, seed, epoch).mapInArrow(partial, SUM_SCHEMA))
    handle.destroy()
    return shaped(sums, params), float(sums["loss"][0])


def fit_autoencoder(cells: DataFrame, vocabulary: DataFrame, config: dict | None = None) -> tuple[DataFrame, Params, list[float]]:
    """Train on the mirrored SPPMI cells; returns (attr_id, vector), the parameters and the loss per epoch.

    vocabulary is (attr_id, idx); an attribute without cells has an all-zero row and still gets a vector. A model of more than
    MODEL_BYTES is trained in blocks by the same steps, from other starting weights; its outer layers stay in their tables.
    """
    cfg = known_settings(AE_DEFAULTS, config)
    n = vocabulary.count()
    if 16 * n * cfg["hidden_dim"] > MODEL_BYTES:
        return fit_in_blocks(cells, vocabulary, cfg)
    rows = materialize(matrix_rows(cells, vocabulary))
    params = init_params(n, cfg["hidden_dim"], cfg["latent_dim"], cfg["seed"])
    adam, losses = Adam(cfg["lr"]), []
    for epoch in range(cfg["epochs"]):
        grads, loss = train_epoch(rows, params, n, cfg["noise_prob"], cfg["seed"], epoch)
        adam.step(params, grads)
        losses.append(loss)
    return encode(rows, params, n), params, losses


def encode(rows: DataFrame, params: Params, n: int) -> DataFrame:
    """(attr_id, vector): the bottleneck without noise or dropout, unit length."""
    handle = rows.sparkSession.sparkContext.broadcast({k: params[k] for k in ("w1", "b1", "w2", "b2")})

    def forward(batches):
        p = handle.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                h = np.maximum(_dense(part, n) @ p["w1"] + p["b1"], 0)
                z = unit_rows(h @ p["w2"] + p["b2"])
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame({"attr_id": part.column("attr_id").to_pandas(), "vector": list(z)}), preserve_index=False
                )

    return rows.mapInArrow(forward, "attr_id string, vector array<double>")
