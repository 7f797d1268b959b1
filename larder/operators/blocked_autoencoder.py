"""The autoencoder with its outer layers in blocks of attributes, for vocabularies whose layers should not meet in one place.

A block holds the attributes' rows of the first layer, their columns and biases of the last one, and Adam's moments of all these; the
blocks are a written table, and a block is stepped by the task that holds it. The small inner layers are sent to all tasks.

The loss is the mean square over all cells, yet no dense cell is ever built. With H the last hidden rows, W and b the last layer and X
the sparse input, the sums over all cells need only the square matrices H'H and WW', which are as wide as the hidden layer:
    gradient by W = 2/N (H'H W + (H'1) b' - H'X),    gradient by H = 2/N (H WW' + 1 (Wb)' - X W'),
so a step costs the non-zero cells and the attributes, not their square, and is exact.

An epoch is four passes of one kind: sparse entries stream past the block they need (weights by column block, hidden rows by row
block), and what they give is added up in the task and then by block on the other side. The driver sees sums as wide as the hidden layer.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform
from ..session import Scratch, materialize
from .alignment import unit_rows
from .params import SUM_SCHEMA, Adam, Params, as_chunks, linear_init, shaped, sum_over_tasks

BLOCK = 512
HELD_ENTRIES = 1 << 14
DROPOUT = 0.2
OUTER = ("w1", "w4", "b4")  # kept by attribute: w4 is held transposed
PART = "blk int, role int, at binary, p binary"
PLACED = "blk int, m binary, moments binary"
MIXED = "blk int, m binary, moments binary, name string, at bigint, values array<double>"


def block_rows(n: int, block: int, blk: int) -> int:
    return min(block, n - blk * block)


def sparse_entries(cells: DataFrame, vocabulary: DataFrame, block: int) -> DataFrame:
    """(rb, r, cb, c, w, src, dst): cells (src, dst, w) by the block and place of their row and column; vocabulary is (attr_id, idx)."""
    def side(name: str, blk: str, place: str) -> DataFrame:
        return vocabulary.select(F.col("attr_id").alias(name), F.expr(f"cast(idx div {block} AS int)").alias(blk),
                                 F.expr(f"cast(idx % {block} AS int)").alias(place))

    return cells.select("src", "dst", "w").join(side("src", "rb", "r"), "src").join(side("dst", "cb", "c"), "dst").select(
        "rb", "r", "cb", "c", "w", "src", "dst")


def pack(arrays: list[np.ndarray]) -> bytes:
    return np.concatenate([np.ascontiguousarray(a, np.float64).ravel() for a in arrays]).tobytes()


def unpack(data: bytes, rows: int, widths: list[int]) -> list[np.ndarray]:
    """Arrays of `rows` rows; a width of 0 stands for a vector."""
    flat, out = np.frombuffer(data), []
    for width in widths:
        size = rows * max(width, 1)
        out.append(flat[:size].reshape(rows, width) if width else flat[:size])
        flat = flat[size:]
    return out


def _streamed(blocks: DataFrame, rows: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """fn over the rows in runs of equal blk, of which the first is the block itself (role 0)."""
    both = blocks.withColumn("role", F.lit(0)).unionByName(rows.withColumn("role", F.lit(1)), allowMissingColumns=True)
    return both.repartition("blk").sortWithinPartitions("blk", "role").mapInArrow(fn, schema)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of equal blk."""
    for batch in batches:
        if batch.num_rows:
            blk = np.asarray(batch.column("blk"))
            edges = [0, *(np.flatnonzero(np.diff(blk)) + 1).tolist(), len(blk)]
            for a, b in zip(edges, edges[1:], strict=False):
                yield int(blk[a]), batch.slice(a, b - a)


def _spread(blocks: DataFrame, entries: DataFrame, hidden: int, n: int, block: int) -> DataFrame:
    """PART rows: for each entry, its noisy value times the first and its value times the second half of its row of the block, summed by target.

    blocks: (blk, m) with m = two arrays of `hidden` columns; entries: (blk, j, to, at, w, noisy).
    """
    def reduce(key: np.ndarray, w: np.ndarray, noisy: np.ndarray, j: np.ndarray, halves: list[np.ndarray]) -> Iterator[tuple]:
        order = np.argsort(key, kind="stable")
        key, j = key[order], j[order]
        first = np.flatnonzero(np.r_[True, np.diff(key) != 0])
        sums = np.concatenate([np.add.reduceat(v[order, None] * h[j], first) for v, h in zip((noisy, w), halves, strict=True)], axis=1)
        target = key[first]
        edges = [0, *(np.flatnonzero(np.diff(target // block)) + 1).tolist(), len(target)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(target[a] // block), 1, (target[a:b] % block).astype(np.int32).tobytes(), sums[a:b].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = None
        for blk, part in _runs(batches):
            if part.column("role")[0].as_py() == 0:
                rows = block_rows(n, block, blk)
                halves, part = unpack(part.column("m")[0].as_py(), rows, [hidden, hidden]), part.slice(1)
            for lo in range(0, part.num_rows, HELD_ENTRIES):
                some = part.slice(lo, HELD_ENTRIES)
                to, at, j, w, noisy = (np.asarray(some.column(c)) for c in ("to", "at", "j", "w", "noisy"))
                out = reduce(to.astype(np.int64) * block + at, w, noisy, j, halves)
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["blk", "role", "at", "p"]).astype({"blk": "int32", "role": "int32"}),
                                                 preserve_index=False)

    return _streamed(blocks, entries, run, PART)


def _gathered(blocks: DataFrame, parts: DataFrame, hidden: int, n: int, block: int, finish: Callable, schema: str) -> DataFrame:
    """Per block the sum of its PART rows, taken by finish(blk, block row, sum, task sums) to its new row (blk, m, moments) or None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, {}

        def close() -> Iterator[pa.RecordBatch]:
            row = finish(*held, total)
            if row is not None:
                yield pa.RecordBatch.from_pandas(pd.DataFrame([(*row, None, None, None)], columns=["blk", "m", "moments", "name", "at", "values"]),
                                                 schema=ARROW, preserve_index=False)

        for blk, part in _runs(batches):
            if part.column("role")[0].as_py() == 0:
                if held:
                    yield from close()
                held = (blk, {c: part.column(c)[0].as_py() for c in ("m", "moments")}, np.zeros((block_rows(n, block, blk), 2 * hidden)))
                part = part.slice(1)
            for at, p in zip(part.column("at"), part.column("p"), strict=True):
                place = np.frombuffer(at.as_py(), np.int32)
                held[2][place] += np.frombuffer(p.as_py()).reshape(len(place), -1)
        if held:
            yield from close()
        if total:
            sums = as_chunks(total).assign(blk=None, m=None, moments=None)
            yield pa.RecordBatch.from_pandas(sums[["blk", "m", "moments", "name", "at", "values"]], schema=ARROW, preserve_index=False)

    return _streamed(blocks, parts.drop("role"), run, schema)


ARROW = pa.schema([("blk", pa.int32()), ("m", pa.binary()), ("moments", pa.binary()), ("name", pa.string()), ("at", pa.int64()),
                   ("values", pa.list_(pa.float64()))])


def _add(total: Params, new: Params) -> None:
    for name, a in new.items():
        total[name] = total.get(name, 0.0) + a


def initial_blocks(entries: DataFrame, n: int, hidden: int, seed: int, block: int) -> DataFrame:
    """(blk, m, moments): weights within 1 / sqrt(inputs), no moments yet, and the sum of each column of the input."""
    columns = entries.groupBy("cb", "c").agg(F.sum("w").alias("w")).groupBy("cb").agg(F.collect_list(F.struct("c", "w")).alias("sums"))
    blocks = entries.sparkSession.range(-(-n // block)).select(F.col("id").cast("int").alias("cb"))

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for blk, sums in zip(pdf["cb"], pdf["sums"], strict=True):
                rows, rng = block_rows(n, block, blk), np.random.default_rng([seed, blk])
                xsum = np.zeros(rows)
                for cell in sums if sums is not None else []:
                    xsum[cell["c"]] = cell["w"]
                w1, w4 = rng.uniform(-1, 1, (rows, hidden)) / np.sqrt(n), rng.uniform(-1, 1, (rows, hidden)) / np.sqrt(hidden)
                m = pack([w1, w4, rng.uniform(-1, 1, rows) / np.sqrt(hidden), xsum])
                yield pd.DataFrame([(blk, m, None)], columns=["blk", "m", "moments"])

    return blocks.join(columns, "cb", "left").mapInPandas(start, PLACED)


def inner_params(hidden: int, latent: int, seed: int) -> Params:
    rng, out = np.random.default_rng(seed), {"b1": np.zeros(hidden)}
    for i, (a, b) in ((2, (hidden, latent)), (3, (latent, hidden))):
        out[f"w{i}"], out[f"b{i}"] = linear_init(rng, a, b)
    return out


class Trainer:
    """A model in blocks and its steps; `blocks` (blk, m, moments) is a written table, `inner` the small layers."""

    def __init__(self, entries: DataFrame, blocks: DataFrame, inner: Params, n: int, cfg: dict, block: int = BLOCK):
        self.spark, self.n, self.cfg, self.block = entries.sparkSession, n, cfg, block
        self.entries, self.inner, self.adam = entries, dict(inner), Adam(cfg["lr"])
        self.hidden, self.scratch = len(inner["b1"]), Scratch(self.spark)
        self.blocks = self.scratch.keep(blocks)
        self.squares = entries.agg(F.sum(F.col("w") * F.col("w"))).first()[0] or 0.0
        self.rows = self.spark.range(-(-n // block)).select(F.col("id").cast("int").alias("blk"))
        self.products = self._products()

    def widths(self) -> list[int]:
        return [self.hidden, self.hidden, 0, 0]

    def _products(self) -> Params:
        """WW' and Wb of the last layer."""
        n, block, widths = self.n, self.block, self.widths()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: Params = {}
            for pdf in batches:
                for blk, m in zip(pdf["blk"], pdf["m"], strict=True):
                    _, w4, b4, _ = unpack(m, block_rows(n, block, blk), widths)
                    _add(total, {"ww": w4.T @ w4, "wb": w4.T @ b4})
            if total:
                yield as_chunks(total)

        return sum_over_tasks(self.blocks.select("blk", "m").mapInPandas(run, SUM_SCHEMA))

    def halves(self) -> DataFrame:
        """(blk, m): first and last layer's weights of each block."""
        size = 16 * self.hidden
        return self.blocks.select("blk", F.expr(f"substring(m, 1, {size} * cast(length(m) / ({size} + 16) AS int))").alias("m"))

    def noisy(self, epoch: int | None) -> DataFrame:
        """Entries with the noisy value: 0 with the set probability, as denoise_mask() draws it; as it is without an epoch."""
        if epoch is None:
            return self.entries.withColumn("noisy", F.col("w"))
        u = hash_uniform(F.lit(self.cfg["seed"]), F.lit(epoch), F.col("src"), F.col("dst"))
        return self.entries.withColumn("noisy", F.when(u > self.cfg["noise_prob"], F.col("w")).otherwise(0.0))

    def by_column(self, epoch: int | None) -> DataFrame:
        """PART rows that add up, by row block, to the noisy rows times the first layer and the rows times the last layer's transpose."""
        seen = self.noisy(epoch).select(F.col("cb").alias("blk"), F.col("c").alias("j"), F.col("rb").alias("to"), F.col("r").alias("at"), "w", "noisy")
        return _spread(self.halves(), seen, self.hidden, self.n, self.block)

    def step(self, epoch: int) -> float:
        """One full-batch step of Adam; returns the loss before it."""
        n, block, hidden, cfg, widths = self.n, self.block, self.hidden, self.cfg, self.widths()
        sc, cells, old = self.spark.sparkContext, float(self.n) * self.n, self.scratch
        self.scratch = Scratch(self.spark)
        model = sc.broadcast(self.inner | {"ww": self.products["ww"].reshape(hidden, hidden), "wb": self.products["wb"]})

        def through(blk: int, row: dict, sums: np.ndarray, total: Params) -> tuple:
            """The inner layers, forward and backward: keeps what the outer layers' gradients need of the rows."""
            q = model.value
            keep = np.stack([np.random.default_rng([cfg["seed"], epoch, blk * block + i]).random(2 * hidden) >= DROPOUT for i in range(len(sums))])
            keep = keep / (1 - DROPOUT)
            a1, xw = sums[:, :hidden] + q["b1"], sums[:, hidden:]
            h1 = np.maximum(a1, 0) * keep[:, :hidden]
            z = h1 @ q["w2"] + q["b2"]
            a2 = z @ q["w3"] + q["b3"]
            h2 = np.maximum(a2, 0) * keep[:, hidden:]
            d = 2.0 / cells * (h2 @ q["ww"] + q["wb"] - xw) * keep[:, hidden:] * (a2 > 0)
            g = {"w3": z.T @ d, "b3": d.sum(0), "hh": h2.T @ h2, "h": h2.sum(0), "hx": np.array([(h2 * xw).sum()])}
            d = d @ q["w3"].T
            g |= {"w2": h1.T @ d, "b2": d.sum(0)}
            d = (d @ q["w2"].T) * keep[:, :hidden] * (a1 > 0)
            _add(total, g | {"b1": d.sum(0)})
            return blk, pack([d, h2]), None

        none = self.rows.select("blk", F.lit(None).cast("binary").alias("m"), F.lit(None).cast("binary").alias("moments"))
        done = self.scratch.keep(_gathered(none, self.by_column(epoch), hidden, n, block, through, MIXED))
        sums = sum_over_tasks(done.where("blk IS NULL").select("name", "at", "values"))
        model.destroy()
        known = sc.broadcast({"hh": sums["hh"].reshape(hidden, hidden), "h": sums["h"]})
        lr, t = cfg["lr"], self.adam.t

        def stepped(blk: int, row: dict, sums: np.ndarray, total: Params) -> tuple:
            """Gradients of a block's outer layers, Adam's step, and the products of the new last layer."""
            size, q = len(sums), known.value
            w1, w4, b4, xsum = unpack(row["m"], size, widths)
            wh, hw = w4 @ q["hh"], w4 @ q["h"]
            loss = (wh * w4).sum() + 2 * (b4 * hw).sum() + n * (b4 * b4).sum() - 2 * (b4 * xsum).sum()
            grads = {"w1": sums[:, :hidden], "w4": 2 / cells * (wh + b4[:, None] * q["h"] - sums[:, hidden:]), "b4": 2 / cells * (hw + n * b4 - xsum)}
            params, adam = {"w1": w1, "w4": w4, "b4": b4}, Adam(lr, t=t)
            if row["moments"]:
                kept = unpack(row["moments"], size, widths[:3] * 2)
                adam.m, adam.v = dict(zip(OUTER, kept[:3], strict=True)), dict(zip(OUTER, kept[3:], strict=True))
            adam.step(params, grads)
            _add(total, {"ww": params["w4"].T @ params["w4"], "wb": params["w4"].T @ params["b4"], "loss": np.array([loss])})
            return blk, pack([*(params[k] for k in OUTER), xsum]), pack([*(adam.m[k] for k in OUTER), *(adam.v[k] for k in OUTER)])

        seen = self.noisy(epoch).select(F.col("rb").alias("blk"), F.col("r").alias("j"), F.col("cb").alias("to"), F.col("c").alias("at"), "w", "noisy")
        back = _spread(done.where("blk IS NOT NULL").select("blk", "m"), seen, hidden, n, block)
        after = self.scratch.keep(_gathered(self.blocks, back, hidden, n, block, stepped, MIXED))
        self.products = sum_over_tasks(after.where("blk IS NULL").select("name", "at", "values"))
        known.destroy()
        self.blocks = after.where("blk IS NOT NULL").select("blk", "m", "moments")
        old.release()
        self.adam.step(self.inner, shaped(sums, self.inner))
        return float((self.products["loss"][0] - 2 * sums["hx"][0] + self.squares) / cells)

    def encode(self) -> DataFrame:
        """(idx, vector): the bottleneck without noise or dropout, unit length."""
        n, block, hidden = self.n, self.block, self.hidden
        inner = dict(self.inner)

        def bottleneck(blk: int, row: dict, sums: np.ndarray, total: Params) -> tuple:
            h = np.maximum(sums[:, :hidden] + inner["b1"], 0)
            return blk, pack([unit_rows(h @ inner["w2"] + inner["b2"])]), None

        none = self.rows.select("blk", F.lit(None).cast("binary").alias("m"), F.lit(None).cast("binary").alias("moments"))
        done = _gathered(none, self.by_column(None), hidden, n, block, bottleneck, MIXED)

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for blk, m in zip(pdf["blk"], pdf["m"], strict=True):
                    z = np.frombuffer(m).reshape(block_rows(n, block, blk), -1)
                    yield pd.DataFrame({"idx": blk * block + np.arange(len(z)), "vector": list(z)})

        return done.select("blk", "m").mapInPandas(rows, "idx long, vector array<double>")

    def release(self) -> None:
        self.scratch.release()


def fit_in_blocks(cells: DataFrame, vocabulary: DataFrame, cfg: dict, block: int = BLOCK) -> tuple[DataFrame, Params, list[float]]:
    """Train on the mirrored SPPMI cells; returns (attr_id, vector), the inner layers and the loss per epoch. vocabulary is (attr_id, idx)."""
    n = vocabulary.count()
    entries = materialize(sparse_entries(cells, vocabulary, block))
    blocks = initial_blocks(entries, n, cfg["hidden_dim"], cfg["seed"], block)
    trainer = Trainer(entries, blocks, inner_params(cfg["hidden_dim"], cfg["latent_dim"], cfg["seed"]), n, cfg, block)
    losses = [trainer.step(epoch) for epoch in range(cfg["epochs"])]
    vectors = materialize(trainer.encode().join(vocabulary, "idx").select("attr_id", "vector"))
    trainer.release()
    return vectors, trainer.inner, losses
