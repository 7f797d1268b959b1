"""Weighted sums of vectors by key, as arrays: partial sums in each task, one shuffle of them, and a merge.

The plan is the same for any dimension, and a key of many rows costs one row a task. Where rows only name their vectors, and those
are few enough to broadcast, the rows themselves are shuffled, and the sums are products of a key's weights with the vectors.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BROADCAST_BYTES, sorted_matrix, to_matrix, vector_bytes

HELD_KEYS = 1 << 13
DENSE = 8  # cells of a key-by-vector matrix for each of its rows, up to which it is held whole


def _grouped(key: pa.Array, weight: np.ndarray, sums: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct keys in order of appearance, and the sums of their rows."""
    coded = key.dictionary_encode(null_encoding="encode")
    at = coded.indices.to_numpy()
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0])
    return coded.dictionary, np.add.reduceat(weight[order], first), np.add.reduceat(sums[order], first, axis=0)


def _batch(key: pa.Array, weight: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    width = sums.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1) * width, pa.int32()), pa.array(sums.ravel()))
    return pa.RecordBatch.from_arrays([key, pa.array(weight), lists], names=["key", "weight", "sums"])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for b in batches:
        if b.num_rows:
            weight = b.column("weight").to_numpy()
            new = _grouped(b.column("key"), weight, to_matrix(b.column("vector")) * weight[:, None])
            held = new if held is None else _grouped(pa.concat_arrays([held[0], new[0]]), *(np.concatenate(x) for x in zip(held[1:], new[1:], strict=True)))
            if len(held[0]) > HELD_KEYS:
                yield _batch(*held)
                held = None
    if held:
        yield _batch(*held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of runs of equal keys, over the borders of batches."""
    last = None
    for b in batches:
        if b.num_rows:
            key, weight, sums = b.column("key"), b.column("weight").to_numpy(), to_matrix(b.column("sums"))
            if last:
                key, weight, sums = pa.concat_arrays([last[0], key]), np.r_[last[1], weight], np.concatenate([last[2], sums])
            key, weight, sums = _grouped(key, weight, sums)
            if len(key) > 1:
                yield _batch(key[:-1], weight[:-1], sums[:-1])
            last = key[-1:], weight[-1:], sums[-1:]
    if last:
        yield _batch(*last)


def weighted_sums(rows: DataFrame, key: str, weight: Column, vector: Column) -> DataFrame:
    """(key, weight, sums): per key the sum of the weights, and of the vectors times them. Vectors are of one length;
    rows without weight or vector are left out."""
    kind = rows.schema[key].dataType.simpleString()
    seen = rows.select(F.col(key).alias("key"), weight.cast("double").alias("weight"), vector.cast("array<double>").alias("vector"))
    schema = f"key {kind}, weight double, sums array<double>"
    parts = seen.where("weight IS NOT NULL AND vector IS NOT NULL").mapInArrow(_partial, schema)
    merged = parts.repartition("key").sortWithinPartitions("key").mapInArrow(_merge, schema)
    return merged.withColumnRenamed("key", key)


def _products(at: np.ndarray, weight: np.ndarray, starts: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """For each run of rows the sum of weight * matrix[at]."""
    if len(starts) * len(matrix) <= DENSE * len(at):
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(at)]))
        return np.bincount(run * len(matrix) + at, weight, len(starts) * len(matrix)).reshape(len(starts), -1) @ matrix
    return np.add.reduceat(weight[:, None] * matrix[at], starts, axis=0)


def named_sums(rows: DataFrame, key: str, name: str, weight: Column, vectors: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """weighted_sums() of rows joined on column `name` to vectors (name, vector): a row without a vector is left out."""
    vectors = vectors.select(name, "vector").where(F.col(name).isNotNull() & F.col("vector").isNotNull())
    n, size = vector_bytes(vectors.withColumnRenamed(name, "id"))
    if not n or size > limit_bytes:
        return weighted_sums(rows.join(vectors, name), key, weight, F.col("vector"))
    spark, kind = rows.sparkSession, rows.schema[key].dataType.simpleString()
    ids, matrix = sorted_matrix(vectors.withColumnRenamed(name, "id"))
    _, first, number, copies = np.unique(ids.astype(str), return_index=True, return_inverse=True, return_counts=True)
    handle = spark.sparkContext.broadcast((np.add.reduceat(matrix, first, axis=0), copies.astype(float)))
    numbers = spark.createDataFrame([(i, int(k)) for i, k in zip(ids[first], number[first], strict=True)], f"{name} {vectors.schema[name].dataType.simpleString()}, at int")
    seen = rows.select(F.col(key).alias("key"), name, weight.cast("double").alias("weight")).where("weight IS NOT NULL")
    # The broadcast join keeps rows where they are, so those that are dealt out by key already need no shuffle here.
    dealt = seen.join(F.broadcast(numbers), name).select("key", "at", "weight").repartition("key").sortWithinPartitions("key")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, copies = handle.value

        def parts() -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    coded = b.column("key").dictionary_encode(null_encoding="encode")
                    starts = np.flatnonzero(np.r_[True, np.diff(coded.indices.to_numpy()) != 0])
                    at, own = b.column("at").to_numpy(), b.column("weight").to_numpy()
                    yield _batch(coded.dictionary, np.add.reduceat(own * copies[at], starts), _products(at, own, starts, matrix))

        yield from _merge(parts())

    return dealt.mapInArrow(add, f"key {kind}, weight double, sums array<double>").withColumnRenamed("key", key)
