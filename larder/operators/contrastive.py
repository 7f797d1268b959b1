"""Contrastive (InfoNCE) loss over two views of the same nodes."""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize, vec_dot
from . import blocks
from .blocks import BROADCAST_BYTES, PACKS, block_product, past_teams, team_counts, vector_bytes

TILE = 256, 1024  # cells that stay in a core's cache while they are multiplied, raised and added up


def _exp_sums(temperature: float):
    def kernel(ids, left, right_ids, right):
        # Unit vectors: similarity - 1 <= 0, so the exponentials never overflow.
        e = np.exp((left @ right.T - 1.0) / temperature)
        at = np.minimum(np.searchsorted(right_ids.astype(str), ids.astype(str)), len(right_ids) - 1)
        same = np.flatnonzero(right_ids[at] == ids)
        e[same, at[same]] = 0.0
        return pd.DataFrame({"id": ids, "total": e.sum(axis=1)})

    return kernel


class _PairSums:
    """Sums of exp((a . b - 1) / temperature) for the rows of packs and blocks, over all pairs that meet.

    A pair of a pack and another block counts for both; `group` is 1 where the block is the pack itself.
    """

    def __init__(self, temperature: float):
        self.temperature, self.packs = temperature, {}
        self.cells, self.ones = np.empty(TILE), np.ones(max(TILE))

    def add(self, group: int, part: int, floor: float | None, ids: np.ndarray, rows: np.ndarray) -> None:
        # One more column on either side, so that the product is the exponent.
        wide = np.c_[rows / self.temperature, np.full(len(rows), -1.0 / self.temperature)]
        self.packs[part] = ids, wide, np.zeros(len(rows))

    def meet(self, right_ids: np.ndarray, right: np.ndarray, packs: list[dict]) -> Iterator[pd.DataFrame]:
        right, met, others = np.c_[right, np.ones(len(right))], np.zeros(len(right)), False
        for p in packs:
            if p["part"] not in self.packs:
                continue
            _, left, totals = self.packs[p["part"]]
            self._tiles(left, right, totals, None if p["group"] else met)
            others = others or not p["group"]
        if others:
            yield pd.DataFrame({"id": right_ids, "total": met})

    def _tiles(self, left: np.ndarray, right: np.ndarray, totals: np.ndarray, met: np.ndarray | None) -> None:
        """Add the sums over `right` to the totals of `left`, and the other way round; without `met` the two are the same rows."""
        high, wide = TILE
        for lo in range(0, len(left), high):
            a = left[lo : lo + high]
            for at in range(0, len(right), wide):
                b = right[at : at + wide]
                e = self.cells.ravel()[: len(a) * len(b)].reshape(len(a), len(b))
                np.matmul(a, b.T, out=e)
                np.exp(e, out=e)
                if met is None:
                    own = np.arange(max(lo, at), min(lo + len(a), at + len(b)))
                    e[own - lo, own - at] = 0.0
                else:
                    met[at : at + wide] += self.ones[: len(a)] @ e
                totals[lo : lo + high] += e @ self.ones[: len(b)]

    def end(self) -> Iterator[pd.DataFrame]:
        for ids, _, totals in self.packs.values():
            yield pd.DataFrame({"id": ids, "total": totals})


def _pair_sums(both: DataFrame, n: int, temperature: float) -> DataFrame:
    """(id, total): partial sums for each vector over all other ones, each pair of vectors multiplied once.

    Vectors are dealt into blocks, which stream past teams of blocks. Of two blocks the one that stays is the first if their numbers
    add up to an even one, the second otherwise, so that every team has half the products to make.
    """
    n_blocks = max(1, math.ceil(n / blocks.RIGHT_BLOCK))
    teams, splits = team_counts(n, n_blocks, n_blocks, both.sparkSession.sparkContext.defaultParallelism)
    rows = F.array_sort(F.collect_list(F.struct("id", "vector"))).alias("rows")
    dealt = both.groupBy(F.expr(f"CAST(pmod(xxhash64(id), {n_blocks}) AS int)").alias("part")).agg(rows)
    lefts = dealt.select(
        F.expr(f"explode(transform(sequence(0, {splits} - 1), s -> s * {teams} + part % {teams}))").alias("team"),
        F.lit(0).alias("group"), "part", "rows", F.lit(None).cast("double").alias("floor"))
    stay = f"filter(sequence(of, {n_blocks} - 1, {teams}), a -> a = part OR ((a + part) % 2 = 0) = (a < part))"
    rights = dealt.select("part", "rows", F.expr(f"explode(sequence(0, {teams} - 1))").alias("of")).select(
        F.expr(f"of + part % {splits} * {teams}").alias("team"), "rows",
        F.expr(f"transform({stay}, a -> struct(CAST(a = part AS int) AS group, a AS part))").cast(PACKS).alias("packs"))
    return past_teams(lefts, rights, teams * splits, lambda: _PairSums(temperature), "id string, total double")


def infonce_loss(z1: DataFrame, z2: DataFrame, temperature: float, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row: mean loss over the 2N vectors of (attr_id, vector) views z1 and z2.

    Each vector is an anchor; its positive is the same node in the other view, its
    negatives are all other vectors of both views.
    """
    a = z1.select("attr_id", l2_normalize("vector").alias("v1"))
    b = z2.select("attr_id", l2_normalize("vector").alias("v2"))
    pos = a.join(b, "attr_id").select("attr_id", (vec_dot("v1", "v2") / temperature).alias("pos"))
    both = a.select(F.concat(F.lit("1|"), "attr_id").alias("id"), F.col("v1").alias("vector")).unionByName(
        b.select(F.concat(F.lit("2|"), "attr_id").alias("id"), F.col("v2").alias("vector"))
    )
    n, size = vector_bytes(both)
    if size <= limit_bytes:
        sums, _ = block_product(both, both, _exp_sums(temperature), "id string, total double", limit_bytes)
    else:
        sums = _pair_sums(both, n, temperature).groupBy("id").agg(F.sum("total").alias("total"))
    per_anchor = sums.select(F.expr("substr(id, 3)").alias("attr_id"), (F.ln("total") + 1.0 / temperature).alias("lse"))
    return per_anchor.join(pos, "attr_id").agg(
        F.avg(F.col("lse") - F.col("pos")).alias("loss"), F.count(F.lit(1)).alias("n_anchors")
    )
