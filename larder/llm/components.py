"""Connected components of a graph whose edges are rows.

Edges are first thinned to a forest within each task of at most EDGES_PER_TASK edges; if that was all of them, the forest's
stars are the components.  Otherwise alternating star steps follow: every node hands its larger neighbours to the smallest
one it knows, then its smaller ones.  After a number of rounds that grows with the logarithm of the longest path, all edges
point to the smallest node of their component.  Each round is two aggregations and two joins; rounds are written to the shared
folder, and only two sums per round reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialize

EDGES_PER_TASK = 500_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the components of some edges: (smallest node, other node)."""
    node, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(node))
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (a, b):  # the root of either end learns of the smaller root
            np.minimum.at(label, before[end], least)
            np.minimum.at(label, end, least)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    other = label != np.arange(len(node))
    return node[label[other]], node[other]


def _thinned(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if held:
            a, b = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """node, component (its smallest node) of each node of `edges` (a, b: longs without nulls)."""
    now = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    tasks = max(1, -(-now.count() // edges_per_task))
    now = materialize(_thinned(now.coalesce(1) if tasks == 1 else now.repartition(tasks, "a")))
    state = _state(now) if tasks > 1 else None
    while state:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        # A node's smaller neighbours and itself go to the smallest of them.
        small = large.join(lowest, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        after = materialize(small.union(lowest.select(F.col("m").alias("a"), "b")).distinct())
        changed = _state(after)
        if changed == state:
            break
        now, state = after, changed
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
