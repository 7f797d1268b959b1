"""All-pairs work between two vector tables, as products of matrix blocks.

Scores are made block against block in numpy and reduced there, so a pair is
never a row unless the caller wants it. The right side is broadcast when its
checked size fits; beyond that left rows are dealt into teams, past which the
right side streams block by block, and the caller merges the partial results.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
RIGHT_BLOCK = 4096
LEFT_PACK = 2048
SLICE_CELLS = 4_000_000
WHOLE = 8  # right rows for each of the k wanted, up to which a left row's scores are sorted whole
TEAM_ROWS = 65_536  # left rows that one task holds while right blocks stream past
PACKS = "array<struct<group: int, part: int>>"

Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def to_matrix(column: pa.Array) -> np.ndarray:
    """Equal-length list column as a rows-by-dim matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def vector_bytes(vectors: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a vector table with its ids, from one small aggregate."""
    names = F.sum(F.octet_length(F.col("id").cast("string")) + 64) if "id" in vectors.columns else F.lit(0)
    row = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim"), names.alias("names")).first()
    return row["n"], row["n"] * (row["dim"] or 0) * 8 + (row["names"] or 0)


def sorted_matrix(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) in id order of a vector table whose size the caller has checked."""
    table = vectors.select("id", "vector").toArrow()
    ids = table.column("id").to_numpy().astype(object)
    order = np.argsort(ids.astype(str), kind="stable")
    return ids[order], to_matrix(table.column("vector"))[order]


def sliced(kernel: Kernel, ids, left, right_ids, right) -> Iterator[pd.DataFrame]:
    per = max(1, SLICE_CELLS // max(1, len(right_ids)))
    for lo in range(0, len(ids), per):
        yield kernel(ids[lo : lo + per], left[lo : lo + per], right_ids, right)


def block_product(
    left: DataFrame, right: DataFrame, kernel: Kernel, schema: str, limit_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """Apply kernel(left_ids, left, right_ids, right) to all block pairs of two (id, vector) tables.

    Right ids arrive sorted. Returns the rows and whether each left row met the
    whole right side at once; when it did not, partial results need merging.
    """
    spark = left.sparkSession
    n_right, size = vector_bytes(right)
    if size <= limit_bytes:
        handle = spark.sparkContext.broadcast(sorted_matrix(right))

        def against_all(batches):
            right_ids, matrix = handle.value
            for batch in batches:
                if batch.num_rows and len(right_ids):
                    ids = batch.column("id").to_numpy(zero_copy_only=False)
                    for out in sliced(kernel, ids, to_matrix(batch.column("vector")), right_ids, matrix):
                        yield pa.RecordBatch.from_pandas(out, preserve_index=False)

        return left.select("id", "vector").mapInArrow(against_all, schema), True

    # Left rows are dealt into teams, and every right block streams past each team.
    n_left = left.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    blocks, packs = max(1, math.ceil(n_right / RIGHT_BLOCK)), max(1, math.ceil(n_left / LEFT_PACK))
    teams, splits = team_counts(n_left, packs, blocks, spark.sparkContext.defaultParallelism)
    rows = F.array_sort(F.collect_list(F.struct("id", "vector"))).alias("rows")
    left_packs = left.groupBy(F.expr(f"CAST(pmod(xxhash64(id), {packs}) AS int)").alias("part")).agg(rows).select(
        F.expr(f"explode(transform(sequence(0, {splits} - 1), s -> s * {teams} + part % {teams}))").alias("team"), F.lit(0).alias("group"), "part", "rows", F.lit(None).cast("double").alias("floor"))
    right_blocks = right.groupBy(F.expr(f"CAST(pmod(xxhash64(id), {blocks}) AS int)").alias("block")).agg(rows).select(
        F.expr(f"explode(transform(sequence(0, {teams} - 1), t -> t + block % {splits} * {teams}))").alias("team"), "rows", F.lit(None).cast(PACKS).alias("packs"))
    return past_teams(left_packs, right_blocks, teams * splits, lambda: _Products(kernel), schema), False


class _Products:
    """The kernel over a team's left rows and each block that comes by."""

    def __init__(self, kernel: Kernel):
        self.kernel, self.lefts = kernel, []

    def add(self, group: int, part: int, floor: float | None, ids: np.ndarray, rows: np.ndarray) -> None:
        self.lefts.append((ids, rows))

    def meet(self, right_ids: np.ndarray, right: np.ndarray, packs: list | None) -> Iterator[pd.DataFrame]:
        if len(self.lefts) > 1:
            self.lefts = [tuple(np.concatenate(x) for x in zip(*self.lefts, strict=True))]
        for ids, left in self.lefts:
            yield from sliced(self.kernel, ids, left, right_ids, right)

    def end(self) -> Iterator[pd.DataFrame]:
        return iter(())


def team_counts(n_left: int, packs: int, n_blocks: int, tasks: int) -> tuple[int, int]:
    """(teams, splits): teams of about TEAM_ROWS left rows at most, and as many as there are tasks; with few packs, the blocks are
    split between copies of a team."""
    teams = max(1, min(packs, max(tasks, math.ceil(n_left / TEAM_ROWS))))
    return teams, max(1, min(n_blocks, math.ceil(tasks / teams)))


def past_teams(lefts: DataFrame, rights: DataFrame, teams: int, begin: Callable, schema: str) -> DataFrame:
    """Rows that `begin()`'s methods make as blocks of right rows stream past teams of left rows, a team a task.

    lefts: team, group, part, rows, floor; rights: team, rows, packs. A right block travels once to each team, and what a team
    holds is its left rows, one block and its own results. `add` takes a pack of left rows, `meet` a block, `end` closes the team.
    """
    both = lefts.withColumns({"kind": F.lit(0), "packs": F.lit(None).cast(PACKS)}).unionByName(
        rights.withColumns({"kind": F.lit(1), "group": F.lit(None).cast("int"), "part": F.lit(None).cast("int"), "floor": F.lit(None).cast("double")}))
    dealt = both.repartitionById(teams, F.col("team").cast("int")).sortWithinPartitions("team", "kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _team_frames(batches, begin):
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    return dealt.select("team", "kind", "group", "part", "floor", "packs", "rows").mapInArrow(stream, schema)


def _team_frames(batches: Iterator[pa.RecordBatch], begin: Callable) -> Iterator[pd.DataFrame]:
    at, state = None, None
    for batch in batches:
        for team, kind, group, part, floor, packs, rows in zip(*batch.columns, strict=True):
            if state is None or team.as_py() != at:
                if state is not None:
                    yield from state.end()
                at, state = team.as_py(), begin()
            ids, matrix = rows.values.field("id").to_numpy(zero_copy_only=False), to_matrix(rows.values.field("vector"))
            if kind.as_py():
                yield from state.meet(ids, matrix, packs.as_py())
            else:
                state.add(group.as_py(), part.as_py(), floor.as_py(), ids, matrix)
    if state is not None:
        yield from state.end()


def best_k(k: int, skip_self: bool = False, digits: int = 12) -> Kernel:
    """Kernel: the k largest dot products per left id; ties by right id.

    The order is by rounded scores (column `by`), so that equal pairs tie whatever block they were in; partial results of
    blocks merge by the same order (`pruned.best_matches`).  Scores come out unrounded.
    """

    def kernel(ids, left, right_ids, right):
        raw = left @ right.T
        scores = np.round(raw, digits)
        if skip_self:
            at = np.minimum(np.searchsorted(right_ids.astype(str), ids.astype(str)), len(right_ids) - 1)
            same = np.flatnonzero(right_ids[at] == ids)
            scores[same, at[same]] = -np.inf
        n = scores.shape[1]
        if n <= max(1, WHOLE) * k:  # a sort of whole rows is cheaper than the search for their floors
            cols = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            rows, cols = np.repeat(np.arange(len(cols)), cols.shape[1]), cols.ravel()
            values = scores[rows, cols]
            return _matches(ids, right_ids, raw, rows, cols, values, np.tile(np.arange(1, min(k, n) + 1), len(raw)), np.isfinite(values))
        floor = np.partition(scores, n - k, axis=1)[:, n - k]
        rows, cols = np.nonzero(scores >= floor[:, None])
        values = scores[rows, cols]
        order = np.lexsort((cols, -values, rows))
        rows, cols, values = rows[order], cols[order], values[order]
        first = np.searchsorted(rows, rows, side="left")
        rank = np.arange(len(rows)) - first + 1
        return _matches(ids, right_ids, raw, rows, cols, values, rank, (rank <= k) & np.isfinite(values))

    return kernel


def _matches(ids, right_ids, raw, rows, cols, values, rank, keep) -> pd.DataFrame:
    rows, cols = rows[keep], cols[keep]
    return pd.DataFrame({
        "id": ids[rows], "other": right_ids[cols], "score": raw[rows, cols], "by": values[keep], "rank": rank[keep].astype(np.int32),
    })


def all_scores(ids, left, right_ids, right) -> pd.DataFrame:
    """Kernel: every dot product."""
    scores = left @ right.T
    return pd.DataFrame({
        "id": np.repeat(ids, len(right_ids)), "other": np.tile(right_ids, len(ids)), "score": scores.ravel(),
    })
