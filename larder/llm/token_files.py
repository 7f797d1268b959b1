"""Token ids in blocks with Elias-Fano document boundaries.

A block is one binary value (one row of a Parquet table in the shared folder, which any store that Spark reaches can hold):
the ids of consecutive documents as 16-bit or 32-bit integers, and two Elias-Fano sequences, the documents' ends in the
block and their doc_ids.  A sequence of n values below u takes about 2 + log2(u / n) bits a value: the low bits are packed,
the high bits are unary in a bit vector, and a directory with the ones before each run of 256 bits answers `select`.

Layout, little-endian: magic "EFT1"; counts of documents, null ids and ids (u32, u32, u64); width of an id in bytes (u32);
the ends' sequence; the doc_ids' sequence; ids.  A sequence: n, low bits (u32 each), least value (i64), bytes of the high
bits (u32), low part, high part, directory (u32 each run).

Documents go to ranges of (doc_id, hash of the text) by Spark's range exchange, so that neither the driver nor a task holds
the cuts, and rows of one doc_id can be in several ranges.  A range's blocks know their starts in it; only a total a range is added up.

Defined cases: a null or empty text is a document of the end id alone; null doc_ids come first; equal doc_ids are in
order of a hash of their text, then of the text; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.ordering import totals_before
from larder.llm import ranges
from larder.llm.tokens import shared_encoder
from larder.llm.words import text_column
from larder.session import materialize

END_ID = 1
BLOCK_TOKENS = 1 << 20
RUN = 256
MAGIC = b"EFT1"
HEAD = struct.Struct("<4sIIQI")
SEQUENCE = struct.Struct("<IIqI")


def _bits(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    grid = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(grid.astype(np.uint8).ravel(), bitorder="little").tobytes()


def encode_sequence(values: np.ndarray) -> bytes:
    """A non-decreasing sequence of 64-bit integers."""
    n, least = len(values), int(values[0]) if len(values) else 0
    v = (values.astype(np.int64).view(np.uint64) - np.uint64(least % (1 << 64)))
    top = int(v[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    size = -(-(int(ones[-1]) + 1) // RUN) * RUN if n else 0
    high = np.zeros(size, np.uint8)
    high[ones] = 1
    before = np.cumsum(high.reshape(-1, RUN).sum(1, dtype=np.int64)) if size else np.zeros(0, np.int64)
    before = np.concatenate([[0], before])[:-1] if size else before
    return (SEQUENCE.pack(n, low, least, size // 8) + _bits(v & np.uint64((1 << low) - 1), low)
            + np.packbits(high, bitorder="little").tobytes() + before.astype("<u4").tobytes())


class Sequence:
    """An encoded sequence; `select` reads single values without decoding the rest."""

    def __init__(self, data: memoryview):
        self.n, self.low, self.least, size = SEQUENCE.unpack_from(data)
        at = SEQUENCE.size
        packed = -(-self.n * self.low // 8)
        self.lows = np.frombuffer(data, np.uint8, packed, at)
        self.high = np.frombuffer(data, np.uint8, size, at + packed).reshape(-1, RUN // 8)
        self.before = np.frombuffer(data, "<u4", len(self.high), at + packed + size)
        self.bytes = at + packed + size + 4 * len(self.high)

    def select(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, np.int64)
        run = np.searchsorted(self.before, index, "right") - 1
        seen = np.cumsum(np.unpackbits(self.high[run], axis=1, bitorder="little"), axis=1, dtype=np.uint16)
        one = run * RUN + np.argmax(seen > (index - self.before[run])[:, None], axis=1)
        value = (one - index).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            place = index[:, None] * self.low + np.arange(self.low)
            bit = (self.lows[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            value |= (bit.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return (value + np.uint64(self.least % (1 << 64))).view(np.int64)


def encode_block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """Documents in ascending order of doc_id, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return (HEAD.pack(MAGIC, len(doc_ids), nulls, len(ids), width) + encode_sequence(np.cumsum(counts))
            + encode_sequence(np.array(doc_ids[nulls:], np.int64)) + ids.astype(f"<u{width}").tobytes())


class Block:
    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.n, self.nulls, total, width = HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = HEAD.size
        self.ends = Sequence(view[at:])
        at += self.ends.bytes
        self.known = Sequence(view[at:])
        at += self.known.bytes
        self.ids = np.frombuffer(view, f"<u{width}", total, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + self.known.select(np.arange(self.known.n)).tolist()

    def bounds(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where documents start and end among the block's ids."""
        index = np.asarray(index, np.int64)
        start = np.zeros(len(index), np.int64)
        start[index > 0] = self.ends.select(index[index > 0] - 1)
        return start, self.ends.select(index)


def write(docs: DataFrame, vocabulary: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The written table of blocks: bucket, block, n_docs, start (among the bucket's ids), n_tokens, payload; documents ascend by (bucket, block)."""
    buckets = ranges.bucket_count(docs)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, size, block, start = shared_encoder(vocabulary), [], 0, 0, 0
        bucket = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal held, size, block, start
            names = [d for h in held for d in h[0]]
            counts = np.concatenate([h[1] for h in held])
            ids = np.concatenate([h[2] for h in held])
            row = [[bucket], [block], [len(names)], [start], [len(ids)], [encode_block(names, counts, ids)]]
            held, size, block, start = [], 0, block + 1, start + len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.large_binary()), strict=True)],
                names=["bucket", "block", "n_docs", "start", "n_tokens", "payload"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, counts, ids in encoder.ids(text_column(batch, "text")):
                ids = np.insert(ids, np.cumsum(counts), end_id)
                held.append((names[first : first + len(counts)], counts + 1, ids))
                size += len(ids)
                if size >= block_tokens:
                    yield flush()
        if held:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(buckets, *order)
    ordered = placed.sortWithinPartitions(*order, "text")
    return materialize(ordered.mapInArrow(blocks, "bucket int, block int, n_docs long, start long, n_tokens long, payload binary"))


def read(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in written blocks."""
    sums = blocks.groupBy(F.col("bucket").alias("_range")).agg(F.sum("n_tokens").alias("n"))
    # A written table, so that Spark knows its size when it plans the join: blocks are not shuffled for it while it is small.
    ahead = materialize(totals_before(sums, "n", "ahead").select(F.col("_range").alias("bucket"), "ahead"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(payload.as_py())
                first, last = block.bounds(np.arange(block.n))
                data = block.ids.astype("<u4").tobytes()
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids(), pa.int64()), pa.array(first + base), pa.array(last - first), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    joined = blocks.select("bucket", "start", "payload").join(ahead, "bucket").select((F.col("ahead") + F.col("start")).alias("start"), "payload")
    return joined.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
