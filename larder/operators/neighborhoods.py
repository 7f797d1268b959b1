"""Batches of nodes with sampled neighbourhoods, as joins.

Every node is a seed of one batch. From its seeds a batch walks incoming edges, hop by hop; a node that is met keeps the first
`fan-out` of its incoming edges in the order of an edge hash. What a batch may hold is a budget of edges a hop, so a batch fits a
task whatever the graph; where the whole graph fits the budget, nothing is left out.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_hex
from ..session import Scratch
from .graph_encoder import dealt

PACKED = "batch long, ids array<string>, counts array<int>, x binary, s binary, d binary, w binary"


def fan_outs(n: int, hops: int, batch_nodes: int, hop_edges: int) -> list[int]:
    """Incoming edges a node keeps at each hop: the most with which no hop can exceed its edges if the later ones keep as many."""
    def fits(reached: int, fan: int, left: int) -> bool:
        for _ in range(left):
            if reached * fan > hop_edges:
                return False
            reached = min(n, reached * (1 + fan))
        return True

    reached, out = min(n, batch_nodes), []
    for left in range(hops, 0, -1):
        low, high = 1, max(1, hop_edges)  # one edge is kept in any case
        while low < high:
            fan = (low + high + 1) // 2
            low, high = (fan, high) if fits(reached, fan, left) else (low, fan - 1)
        out.append(low)
        reached = min(n, reached * (1 + low))
    return out


def seed_batches(vocabulary: DataFrame, n: int, batch_nodes: int, seed: int, turn: int) -> DataFrame:
    """(batch, node) of every node: runs of `batch_nodes` places of a permutation of the numbers of the vocabulary (attr_id, idx)."""
    a, _, c = dealt(n, batch_nodes, seed, turn)
    return vocabulary.select(F.expr(f"pmod(idx * {a}L + {c}L, {n}L) div {batch_nodes}").alias("batch"), F.col("attr_id").alias("node"))


def first_edges(edges: DataFrame, most: int, seed: int, turn: int) -> DataFrame:
    """src, dst, w, place: up to `most` incoming edges of each node in hash order, from 1. A hub's edges are cut in each task before they meet."""
    order = Window.partitionBy("dst").orderBy(hash_hex(F.lit(seed), F.lit(turn), F.col("src"), F.col("dst")), "src")
    return edges.select("src", "dst", "w", F.row_number().over(order).alias("place")).where(F.col("place") <= most)


def walk(edges: DataFrame, seeds: DataFrame, fans: list[int], seed: int, turn: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(batch, node, depth) of all nodes that the batches meet, and (batch, src, dst, w) of the edges they keep."""
    ranked = scratch.keep(first_edges(edges, max(fans), seed, turn))
    members = frontier = scratch.keep(seeds.withColumn("depth", F.lit(0)))
    arcs = None
    for depth, fan in enumerate(fans, start=1):
        met = frontier.select("batch", F.col("node").alias("dst")).join(ranked.where(F.col("place") <= fan), "dst")
        met = scratch.keep(met.select("batch", "src", "dst", "w"))
        arcs = met if arcs is None else arcs.unionByName(met)
        new = met.select("batch", F.col("src").alias("node")).distinct().join(members, ["batch", "node"], "left_anti")
        frontier = scratch.keep(new.withColumn("depth", F.lit(depth)))
        members = members.unionByName(frontier)
    return members, arcs


def packed_batches(members: DataFrame, arcs: DataFrame, features: DataFrame, hops: int) -> DataFrame:
    """One row a batch: node ids by depth, how many have at most each depth, their features, and edges by target.

    features is (attr_id, features) and covers all nodes.
    """
    def pack(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values(["depth", "node"])
        place = pd.Series(np.arange(len(nodes), dtype=np.int32), nodes["node"])
        s, d = (place.loc[edges[c]].to_numpy() for c in ("src", "dst"))
        order = np.lexsort((s, d))
        counts = np.searchsorted(nodes["depth"].to_numpy(), np.arange(hops + 1), "right")
        return pd.DataFrame([(
            nodes["batch"].iloc[0], nodes["node"].tolist(), counts.tolist(), np.stack(nodes["features"]).astype(float).tobytes(),
            s[order].tobytes(), d[order].tobytes(), edges["w"].to_numpy(float)[order].tobytes(),
        )], columns=[c.split()[0] for c in PACKED.split(", ")])

    with_features = members.join(features.withColumnRenamed("attr_id", "node"), "node").select("batch", "node", "depth", "features")
    return with_features.groupBy("batch").cogroup(arcs.withColumnRenamed("batch", "of").groupBy("of")).applyInPandas(pack, PACKED)
