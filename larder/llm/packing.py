"""Best-fit packing by minimum bin slack.

Documents become token pieces; only documents longer than a sequence are cut.  The plan works on the histogram of piece
lengths, which has at most `capacity` rows whatever the corpus: a sequence is opened with the longest length left, and
a subset-sum over the lengths left (a bit set of reachable sums in one Python integer) finds the fullest combination that
fits.  That combination is used as often as the counts allow, so the plan has few rows, and pieces take their places in it
by their rank within their length.  Ranks are counted per (length, salt), so that a length that holds most pieces is
spread over many tasks.

Defined cases: a null or empty text gives one piece that holds the end id alone; equal rows are packed once each; a null
doc_id stays null; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.tokens import shared_encoder
from larder.llm.words import text_column
from larder.session import materialize

CAPACITY = 2048
END_ID = 0
PIECES_PER_SALT = 200_000
LEAST_SALTS = 64


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each document."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary)
        for batch in batches:
            ids_of = batch.column(0)
            for first, counts, ids in encoder.ids(text_column(batch, "text")):
                n = len(counts)
                parts = (counts + capacity) // capacity
                owner = np.repeat(np.arange(n), parts)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                length = np.minimum(capacity, np.repeat(counts + 1, parts) - piece * capacity)
                data = np.insert(ids, np.cumsum(counts), end_id).astype("<u4").tobytes()
                stop = 4 * np.cumsum(length)
                crc = [zlib.crc32(data[a:b]) for a, b in zip((stop - 4 * length).tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids_of.take(pa.array(owner + first)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of the longest length left with others whose sum comes closest to the capacity."""
    top = max(counts)
    room, sums, full = capacity - top, [1], (1 << (capacity - top + 1)) - 1
    order = [x for x in sorted(counts) if x <= room]
    for x in order:
        left = min(counts[x] - (x == top), room // x)
        reach, step = sums[-1], 1
        while left > 0:  # one, two, four, ... copies, and what remains
            step = min(step, left)
            reach |= (reach << (x * step)) & full
            left -= step
            step *= 2
        sums.append(reach)
    at, chosen = sums[-1].bit_length() - 1, {top: 1}
    for i in range(len(order) - 1, -1, -1):
        x, taken = order[i], 0
        most = min(counts[x] - (x == top), at // x)
        for k in range(most, -1, -1):
            if sums[i] >> (at - k * x) & 1:
                taken = k
                break
        if taken:
            chosen[x] = chosen.get(x, 0) + taken
            at -= taken * x
        if not at:
            break
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, copies in a sequence, first sequence, offset) of each use of a length.

    A combination repeats until one of its lengths has fewer pieces left than it takes, so a length's count is at least
    halved or used up each time: the plan is bounded by the capacity, not by the number of pieces.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[x] // k for x, k in chosen.items())
        offset = 0
        for x in sorted(chosen, reverse=True):
            k = chosen[x]
            rows.append((x, used[x], times * k, k, sequence, offset))
            used[x] += times * k
            left[x] -= times * k
            offset += x * k
            if not left[x]:
                del left[x]
        sequence += times
    return rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset.  `pieces` must be a written table, as it is read twice."""
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    counted = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    salts = max(LEAST_SALTS, sum(counted.values()) // PIECES_PER_SALT)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = (salted.withColumn("place", rank).join(offsets, ["length", "salt"])
              .select(*kept, (F.col("place") + F.col("ahead")).alias("rank")))
    rows = np.array(sorted(plan(counted, capacity)), np.int64).reshape(-1, 6)
    high = int(rows[:, 1].max()) + 1 if len(rows) else 1
    key = rows[:, 0] * high + rows[:, 1]

    def seat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            use = rows[np.searchsorted(key, length * high + np.minimum(rank, high - 1), "right") - 1]
            within = rank - use[:, 1]
            b["sequence_id"] = use[:, 4] + within // use[:, 3]
            b["offset"] = use[:, 5] + within % use[:, 3] * length
            yield b[[*kept, "sequence_id", "offset"]]

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInPandas(
        seat, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most `capacity` tokens."""
    return place(materialize(token_pieces(docs, vocabulary, capacity, end_id)), capacity)
