"""Benchmark passages in documents, by greedy string tiling.

Tokens are runs of letters, digits and characters beyond ASCII, in lower case.  Benchmark items are a stated query set: they
are taken in blocks of at most BLOCK_TOKENS tokens, and each block is broadcast and held against every document in its
own task.  Runs of SEED equal tokens join documents with items; a pair whose seeds cover too little of the item can't reach
the threshold and is left.  The others are tiled: the longest unmarked common run is found by running Karp-Rabin hashes (any
length's hashes come from the same running sums), all its non-overlapping places are compared token by token and marked, and
so on down to SEED tokens.  Tiles may stand in any order, so reordered passages count.  A document is contaminated by an
item whose tokens it covers to the share THRESHOLD or more.

Defined cases: a null or empty text, or one without tokens, is clean; items without tokens match nothing; items of fewer
than SEED tokens match as a whole; repeated rows are judged each; an empty table or benchmark gives no finding; other
columns are kept by `clean`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.tokens import KIND
from larder.llm.words import SLICE_BYTES, Words, raw, run_inside, shingles, slices, text_column

SEED = 5
THRESHOLD = 0.5
BLOCK_TOKENS = 1 << 22
INSIDE = (KIND == 1) | (KIND == 2) | (KIND == 4)


def token_hashes(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the index at which each text's begin."""
    words = Words(body, off, INSIDE[body])
    return words.hashes(lower=True), words.first


class Items:
    """A block of the benchmark: tokens of its items and a sorted index of their seeds."""

    def __init__(self, names: list, token: np.ndarray, first: np.ndarray):
        self.names, self.token, self.first = names, token, first
        size = np.diff(first)
        self.seeds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # width, sorted hashes, items, places
        for width in range(1, SEED + 1):
            chosen = size >= SEED if width == SEED else size == width
            ok = run_inside(first, width)
            owner = np.repeat(np.arange(len(size)), size)[: len(ok)]
            at = np.flatnonzero(ok & chosen[owner]) if len(ok) else np.zeros(0, np.int64)
            if len(at):
                h = shingles(token, width)[at]
                order = np.argsort(h, kind="stable")
                self.seeds.append((width, h[order], owner[at][order], (at - first[owner[at]])[order]))

    def tokens(self, i: int) -> np.ndarray:
        return self.token[self.first[i] : self.first[i + 1]]


def longest_common(x: np.ndarray, y: np.ndarray, free_x: np.ndarray, free_y: np.ndarray, least: int) -> int:
    """Length of the longest run of equal tokens in which nothing is marked, or 0 if it is under `least`."""
    def shared(n: int) -> bool:
        return len(_meeting(x, y, free_x, free_y, n)[0]) > 0

    low, high = 0, min(_longest(free_x), _longest(free_y))
    if high < least or not shared(least):
        return 0
    low = least
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if shared(middle) else (low, middle - 1)
    return low


def _longest(free: np.ndarray) -> int:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
    return int((edge[1::2] - edge[::2]).max()) if len(edge) else 0


def _open(free: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[n:] - total[:-n] == n)


def _meeting(x, y, free_x, free_y, n) -> tuple[np.ndarray, np.ndarray]:
    """Places in x and y (all pairs of the first of each in x) of equal unmarked runs of n tokens, by their hashes."""
    at_x, at_y = _open(free_x, n), _open(free_y, n)
    if not len(at_x) or not len(at_y):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hx, hy = shingles(x, n)[at_x], shingles(y, n)[at_y]
    order = np.argsort(hx, kind="stable")
    place = np.minimum(np.searchsorted(hx[order], hy), len(hx) - 1)
    same = hx[order][place] == hy
    return at_x[order][place[same]], at_y[same]


def tile(x: np.ndarray, y: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in x, place in y, length) of at least `least` tokens; each token is in one tile at most."""
    free_x, free_y, tiles = np.ones(len(x), bool), np.ones(len(y), bool), []
    while n := longest_common(x, y, free_x, free_y, least):
        marked = False
        for a, b in zip(*(v.tolist() for v in _meeting(x, y, free_x, free_y, n)), strict=True):
            if free_x[a : a + n].all() and free_y[b : b + n].all() and (x[a : a + n] == y[b : b + n]).all():
                free_x[a : a + n] = free_y[b : b + n] = False
                tiles.append((a, b, n))
                marked = True
        if not marked:
            break
    return tiles


def _spots(items: Items, token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seeds that texts and items share: text, item, place in the item, width."""
    found = []
    for width, seed, owner, place in items.seeds:
        ok = run_inside(first, width)
        if not len(ok):
            continue
        h = shingles(token, width)
        low = np.searchsorted(seed, h)
        low[low == len(seed)] = 0
        at = np.flatnonzero(ok & (seed[low] == h))
        if not len(at):
            continue
        text = np.searchsorted(first, at, "right") - 1
        key, keep = np.unique(np.stack([text, low[at]], 1), axis=0, return_index=True)  # a seed counts once a text
        start, stop = key[:, 1], np.searchsorted(seed, h[at[keep]], "right")
        count = stop - start
        spread = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
        found.append((np.repeat(key[:, 0], count), owner[spread], place[spread], np.full(len(spread), width)))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def findings(items: Items, body: np.ndarray, off: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, float, int]]:
    """(text, item, coverage of the item, tiles) of contaminated texts."""
    out = []
    for i, j in slices(off, SLICE_BYTES):
        token, first = token_hashes(body[off[i] : off[j]], off[i : j + 1] - off[i])
        text, item, place, width = _spots(items, token, first)
        if not len(text):
            continue
        order = np.lexsort((place, item, text))
        text, item, place, width = (v[order] for v in (text, item, place, width))
        start = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(item) != 0)])
        size = np.diff(items.first)
        # Each place adds at most its distance to the next one, and its width at most: what the seeds can cover.
        step = np.minimum(np.append(np.diff(place), 1 << 30), width)
        step[np.append(start[1:], len(place)) - 1] = width[np.append(start[1:], len(place)) - 1]
        most = np.add.reduceat(step, start)
        for k in start[most >= threshold * size[item[start]]]:
            y = items.tokens(item[k])
            tiles = tile(token[first[text[k]] : first[text[k] + 1]], y, min(SEED, len(y)))
            share = sum(n for *_, n in tiles) / len(y)
            if share >= threshold:
                out.append((i + int(text[k]), int(item[k]), share, len(tiles)))
    return out


def blocks(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, each read from the executors when it is needed."""
    names, texts, size = [], [], 0
    for row in benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text").toLocalIterator():
        names.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"]) // 4 + 1
        if size >= block_tokens:
            yield _items(names, texts)
            names, texts, size = [], [], 0
    if names:
        yield _items(names, texts)


def _items(names: list, texts: list[str]) -> Items:
    return Items(names, *token_hashes(*raw(pa.array(texts, pa.large_string()))))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, coverage of the best covered item, n_items, items (their ids, by comma) of contaminated documents."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"doc_id {kind}, item string, coverage double, tiles long")
    for items in blocks(benchmark, block_tokens):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = findings(shared.value, *raw(text_column(b, "text")), threshold)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([str(shared.value.names[r[1]]) for r in rows], pa.string()),
                     pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64())],
                    names=["doc_id", "item", "coverage", "tiles"])

        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(run, found.schema))
    return found.groupBy("doc_id").agg(
        F.max("coverage").alias("coverage"), F.countDistinct("item").alias("n_items"),
        F.array_join(F.sort_array(F.collect_set("item")), ",").alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of `docs`, all columns, that no item contaminates."""
    for items in blocks(benchmark, block_tokens):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[r[0] for r in findings(shared.value, *raw(text_column(b, "text")), threshold)]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
