"""Sums over pairs of keys that share a group: sum of value_a * value_b per (a, b).

This is the product of the group-by-key matrix with its own transpose. Rows are
shuffled by group once; each task multiplies small blocks of the matrix and sends
on summed cells, so the pairs inside a group never become rows. Groups with more
than WIDE keys are cut by key into KEY_BLOCKS blocks; a pair of blocks is then a
unit of work of its own, so that a wide group spreads over many tasks.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WIDE = 4000
KEY_BLOCKS = 32
TILE = 2048
CHUNK_ROWS = 100_000
SLICE_CELLS = 4_000_000
MOST_CELLS = 8_000_000  # sums a task holds before it sends them on
SCHEMA = "src string, dst string, w double"


def _chunks(batches: Iterator[pd.DataFrame], unit: list[str]) -> Iterator[pd.DataFrame]:
    """Batches joined to about CHUNK_ROWS rows, never cut inside a unit; rows arrive sorted by unit."""
    held, rows = [], 0
    for pdf in batches:
        held.append(pdf)
        rows += len(pdf)
        if rows < CHUNK_ROWS:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = np.ones(len(whole), dtype=bool)
        for c in unit:
            last &= (whole[c] == whole[c].iloc[-1]).to_numpy()
        cut = len(whole) - int(last.sum())
        if cut:
            yield whole.iloc[:cut].reset_index(drop=True)
        held, rows = [whole.iloc[cut:]], len(whole) - cut
    if held:
        yield pd.concat(held, ignore_index=True)


def _frame(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> pd.DataFrame:
    swap = a > b
    return pd.DataFrame({"src": np.where(swap, b, a), "dst": np.where(swap, a, b), "w": w})


def _listed_pairs(code, values, starts, sizes):
    """Pairs of positions inside each group, in slices of bounded length."""
    ends = np.repeat(starts + sizes, sizes)
    follow = ends - np.arange(len(code)) - 1
    bounds = np.searchsorted(np.cumsum(follow), np.arange(SLICE_CELLS, follow.sum() + SLICE_CELLS, SLICE_CELLS))
    lo = 0
    for hi in np.minimum(bounds + 1, len(code)):
        reps = follow[lo:hi]
        left = np.repeat(np.arange(lo, hi), reps)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps)
        if len(left):
            a, b = code[left], code[right]
            yield np.minimum(a, b), np.maximum(a, b), values[left] * values[right]
        lo = hi


class _Cells:
    """Cell sums of one task: a dense matrix while its keys are few, sorted cells beyond; each cell leaves about once."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.sums = np.zeros((0, 0))
        self.sparse = np.zeros(0, np.uint64), np.zeros(0)

    def add(self, groups, keys, values) -> Iterator[pd.DataFrame]:
        local, uniq = pd.factorize(keys)
        code = np.array([self.names.setdefault(u, len(self.names)) for u in uniq], dtype=np.int64)[local]
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        sizes = np.diff(np.r_[starts, len(groups)])
        n = len(self.names)
        if n > TILE:
            self._to_sparse()
            for a, b, w in _listed_pairs(code, values, starts, sizes):
                self._merge(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), w)
                if len(self.sparse[0]) > MOST_CELLS:
                    yield from self.flush()
            if not len(self.sparse[0]):
                self.names = {}
            return
        if len(self.sums) < n:
            wider = np.zeros((min(TILE, 2 * n),) * 2)
            wider[: len(self.sums), : len(self.sums)] = self.sums
            self.sums = wider
        pairs = float((sizes * (sizes - 1) // 2).sum())
        if len(sizes) * float(n) * n <= 400.0 * pairs:
            self._multiply(code, values, starts, sizes)
        else:
            m = len(self.sums)
            for a, b, w in _listed_pairs(code, values, starts, sizes):
                self.sums += np.bincount(a * m + b, w, m * m).reshape(m, m)

    def _merge(self, cells: np.ndarray, w: np.ndarray) -> None:
        cells, at = np.unique(np.concatenate([self.sparse[0], cells]), return_inverse=True)
        self.sparse = cells, np.bincount(at, np.concatenate([self.sparse[1], w]))

    def _to_sparse(self) -> None:
        if len(self.sums):
            a, b = np.nonzero(np.triu(self.sums, 1))
            self._merge(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64), self.sums[a, b])
            self.sums = np.zeros((0, 0))

    def _multiply(self, code, values, starts, sizes) -> None:
        n = len(self.names)
        per = max(1, SLICE_CELLS // n)
        for lo in range(0, len(starts), per):
            hi = min(lo + per, len(starts))
            rows = slice(starts[lo], starts[hi - 1] + sizes[hi - 1])
            x = np.zeros((hi - lo, n))
            x[np.repeat(np.arange(hi - lo), sizes[lo:hi]), code[rows]] = values[rows]
            self.sums[:n, :n] += x.T @ x

    def flush(self) -> Iterator[pd.DataFrame]:
        """The sums so far, as rows of bounded frames."""
        self._to_sparse()
        names = np.array(list(self.names), dtype=object)
        cells, w = self.sparse
        for lo in range(0, len(cells), 1_000_000):
            part = cells[lo : lo + 1_000_000]
            yield _frame(names[(part >> np.uint64(32)).astype(np.int64)], names[(part & np.uint64(0xFFFFFFFF)).astype(np.int64)], w[lo : lo + 1_000_000])
        self.sparse = np.zeros(0, np.uint64), np.zeros(0)


def _within_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cells = _Cells()
    for chunk in _chunks(batches, ["grp"]):
        if len(chunk):
            yield from cells.add(chunk["grp"].to_numpy(), chunk["key"].to_numpy(), chunk["val"].to_numpy())
    yield from cells.flush()


def _once_a_group(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows of whole groups, by number, with one row a key: the one of the largest value. A null, -inf here, is less than all."""
    pair = frame["grp"].to_numpy() << 32 | frame["key"].to_numpy()
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    if len(first) == len(pair):
        return frame
    values = np.maximum.reduceat(frame["val"].to_numpy()[order], first)
    return pd.DataFrame({"grp": pair[first] >> 32, "key": pair[first] & 0xFFFFFFFF, "val": values})


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_within_groups() over rows sorted by group, keys of a group repeated or not, by numbers that stand for a task's groups and keys."""
    number: dict[str, int] = {}

    def frames() -> Iterator[pd.DataFrame]:
        at, last = -1, None  # the running number of the last group, and its text
        for b in batches:
            if b.num_rows:
                groups, keys = (b.column(c).dictionary_encode() for c in ("grp", "key"))
                codes = np.array([number.setdefault(k, len(number)) for k in keys.dictionary.to_pylist()], dtype=np.int64)
                start = at if groups.dictionary[0].as_py() == last else at + 1
                at, last = start + len(groups.dictionary) - 1, groups.dictionary[-1].as_py()
                values = b.column("val").fill_null(-np.inf).to_numpy()
                yield pd.DataFrame({"grp": start + groups.indices.to_numpy().astype(np.int64), "key": codes[keys.indices.to_numpy()], "val": values})

    for out in _within_groups(_once_a_group(c).replace({"val": -np.inf}, np.nan) for c in _chunks(frames(), ["grp"]) if len(c)):
        names = np.array(list(number), dtype=object)
        named = _frame(*(names[out[c].to_numpy(np.int64)] for c in ("src", "dst")), out["w"].to_numpy())
        yield pa.RecordBatch.from_pandas(named, preserve_index=False)


def _between_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Products of key block lo with key block hi, summed over the groups of a chunk."""
    for chunk in _chunks(batches, ["lo", "hi", "grp"]):
        for (lo, hi), part in chunk.groupby(["lo", "hi"], sort=False):
            group, _ = pd.factorize(part["grp"])
            on_lo = (part["block"] == lo).to_numpy()
            left = _columns(group, part, on_lo)
            right = left if lo == hi else _columns(group, part, ~on_lo)
            for a_names, x in left():
                for b_names, y in right():
                    sums = x.T @ y
                    a, b = np.nonzero(sums)
                    if lo == hi:
                        once = a_names[a] < b_names[b]
                        a, b = a[once], b[once]
                    for at in range(0, len(a), 1_000_000):
                        s = slice(at, at + 1_000_000)
                        yield _frame(a_names[a[s]], b_names[b[s]], sums[a[s], b[s]])


def _columns(group: np.ndarray, part: pd.DataFrame, rows: np.ndarray):
    """Iterator factory over (names, dense groups-by-keys tile) of at most TILE keys."""
    code, names = pd.factorize(part["key"].to_numpy()[rows])
    at, values, n_groups = group[rows], part["val"].to_numpy()[rows], int(group.max()) + 1

    def tiles():
        for lo in range(0, len(names), TILE):
            here = (code >= lo) & (code < lo + TILE)
            x = np.zeros((n_groups, min(TILE, len(names) - lo)))
            x[at[here], code[here] - lo] = values[here]
            yield names[lo : lo + TILE], x

    return tiles


def pair_sums(
    rows: DataFrame, group: str, key: str, value: Column, wide: int = WIDE, key_blocks: int = KEY_BLOCKS
) -> DataFrame:
    """(src, dst, w) with src < dst and w = sum over groups of value_src * value_dst.

    Null groups and keys are dropped; a key counts once per group. Groups are counted
    first, so pass a written table.
    """
    named = rows.where(F.col(group).isNotNull() & F.col(key).isNotNull()).select(
        F.col(group).cast("string").alias("grp"), F.col(key).cast("string").alias("key"), value.alias("val")
    )
    wide_groups = materialize(named.groupBy("grp").count().where(F.col("count") > wide).select("grp"))
    if wide_groups.isEmpty():
        sums = _narrow(named)
    else:
        sums = _narrow(named.join(wide_groups, "grp", "left_anti")).unionByName(
            _wide(named.join(wide_groups, "grp", "left_semi"), key_blocks)
        )
    return sums.groupBy("src", "dst").agg(F.sum("w").alias("w"))


def _narrow(rows: DataFrame) -> DataFrame:
    """Whole groups side by side: one shuffle, then the sums of each task, which sees to keys that a group repeats."""
    dealt = rows.withColumn("val", F.col("val").cast("double")).repartition("grp").sortWithinPartitions("grp")
    return dealt.mapInArrow(_numbered, SCHEMA)


def _wide(rows: DataFrame, key_blocks: int) -> DataFrame:
    """Pairs of key blocks as units, shuffled by block pair and a hash of the group."""
    other = F.explode(F.sequence(F.lit(0), F.lit(key_blocks - 1)))
    return (
        rows.groupBy("grp", "key").agg(F.max("val").cast("double").alias("val"))
        .withColumn("block", F.pmod(F.xxhash64("key"), F.lit(key_blocks)).cast("int"))
        .withColumn("other", other)
        .select(
            "grp", "key", "val", "block",
            F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        )
        .repartition("lo", "hi", F.pmod(F.xxhash64("grp"), F.lit(64)))
        .sortWithinPartitions("lo", "hi", "grp")
        .mapInPandas(_between_blocks, SCHEMA)
    )
