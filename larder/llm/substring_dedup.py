"""Removal of passages that an earlier document has, behind a count-min prefilter.

A window is WIDTH consecutive words of one document.  A word goes if a window that covers it also starts in a document with a
smaller doc_id.  Three passes over the texts:

1. *Sketch.*  Each window is counted under its anchor, the smallest hash of the ANCHOR-word runs in it.  Equal windows have
   equal anchors, and neighbouring windows share them, so a document adds one count for about every sixteen windows, and
   an anchor's count is never below the number of documents of any window under it.  Every task counts its own texts, and
   the partition sketches (cells with counts) are merged by shard into count-min tables of two rows; both the
   number of shards and the tables grow with the input, so their load does not.
2. *Exact.*  Only windows whose anchor is estimated repeated are grouped, by 96 bits of two independent hashes, after each
   block of documents has reduced its own to the smallest doc_id.  No repeated window is lost, as the estimate is never low;
   windows that were estimated wrongly fall out here.
3. *Removal.*  Each block learns the smallest doc_id of those of its windows that an earlier document has, and rewrites its
   texts.

No group is unbounded: a task adds one row at most to a sketch cell, and a block one row at most to a window's group.

Defined cases: null or empty texts have no words; rows with a null doc_id are neither changed nor a source; rows of
equal doc_id don't remove from each other; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.words import U64, Words, covered, raw, run_inside, shingles, slices, text_column

WIDTH = 50
ANCHOR = 20
BLOCK_BYTES = 12 << 20
BYTES_PER_ANCHOR = 90
CELL_BITS = 20
LOAD = 0.25
ROWS_BYTES = 1 << 24  # anchors that a task holds before it sends them on
FILTER_BITS = 22


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive entries."""
    size, m = 1, h
    while 2 * size <= width:
        m = np.minimum(m[: len(m) - size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


class Windows:
    """The windows of a slice of texts: `at` (first word), `text`, and runs of windows with one anchor."""

    def __init__(self, words: Words, width: int, anchor: int):
        self.words, self.width = words, width
        self.word = words.hashes()
        ok = run_inside(words.first, width)
        self.at = np.flatnonzero(ok)
        self.text = words.text_of()[self.at] if len(self.at) else self.at
        if len(self.at):
            least = _smallest(shingles(self.word, anchor), width - anchor + 1)[self.at]
            new = np.r_[True, (np.diff(self.text) != 0) | (least[1:] != least[:-1])]
            self.run = np.flatnonzero(new)
            self.anchor = least[self.run]
        else:
            self.run, self.anchor = self.at, np.zeros(0, U64)

    def chosen(self, run_mask: np.ndarray) -> np.ndarray:
        """Indexes of the windows of the marked runs."""
        size = np.diff(np.append(self.run, len(self.at)))
        return np.flatnonzero(np.repeat(run_mask, size))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        return shingles(self.word, self.width)[self.at], shingles(self.word, self.width, 1)[self.at] >> U64(32)


def _address(anchor: np.ndarray, shards: int) -> np.ndarray:
    """Shard and the cells of both rows in one number."""
    low = U64(2 * CELL_BITS)
    return ((anchor >> low) % U64(shards)) << low | (anchor & U64((1 << 2 * CELL_BITS) - 1))


def _windows(texts: pa.Array, width: int, anchor: int) -> Iterator[tuple[int, int, Windows]]:
    body, off = raw(texts)
    for i, j in slices(off):
        yield i, j, Windows(Words(body[off[i] : off[j]], off[i : j + 1] - off[i]), width, anchor)


def split(key: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Ranges of equal entries of a sorted array."""
    edge = np.flatnonzero(np.diff(key)) + 1
    for a, b in zip([0, *edge], [*edge, len(key)], strict=True):
        if b > a:
            yield int(key[a]), slice(a, b)


SKETCH = "shard int, block int, addresses binary, blocks binary"


def _partition_sketch(address: np.ndarray, block: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """What a task sends: a count of each address it has once, with its block; a count of two for others, whose blocks
    are told at once (rows without `blocks`)."""
    order = np.lexsort((block, address))
    address, block = address[order], block[order]
    new = np.r_[True, address[1:] != address[:-1]] if len(address) else np.zeros(0, bool)
    size = np.diff(np.append(np.flatnonzero(new), len(address)))
    first, once = np.flatnonzero(new), size == 1
    mark = np.where(once, block[first], -1).astype(np.int32)
    rows = []
    for shard, s in split(address[first] >> U64(2 * CELL_BITS)):
        rows.append((shard, -1, _pack(address[first][s]), _pack(mark[s])))
    more = np.repeat(~once, size)
    known, where = address[more], block[more]
    order = np.lexsort((known, where))
    known, where = known[order], where[order]
    for b, s in split(where):
        rows.append((b % shards, b, _pack(np.unique(known[s])), None))
    for i in range(0, len(rows), 256):
        part = list(zip(*rows[i : i + 256], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.binary()), pa.array(part[3], pa.binary())],
            names=["shard", "block", "addresses", "blocks"])


def _merged_sketch(table: pa.Table) -> pa.Table:
    """One shard of the count-min table from all tasks' counts; the repeated addresses of each block."""
    blocks, found = [], []
    address, mark = [], []
    for b, a, m in zip(*(table.column(c).to_pylist() for c in ("block", "addresses", "blocks")), strict=True):
        if m is None:
            blocks.append(b)
            found.append(a)
        else:
            address.append(_unpack(a, "<u8"))
            mark.append(_unpack(m, "<i4"))
    if address:
        address, mark = np.concatenate(address), np.concatenate(mark)
        weight = np.where(mark < 0, 2, 1)
        cells = U64((1 << CELL_BITS) - 1)
        rows = [(address >> U64(r * CELL_BITS) & cells).astype(np.int64) for r in (0, 1)]
        counts = [np.bincount(c, weight, 1 << CELL_BITS) for c in rows]
        estimate = np.minimum(*(n[c] for n, c in zip(counts, rows, strict=True)))
        told = (estimate >= 2) & (mark >= 0)
        order = np.lexsort((address[told], mark[told]))
        for b, s in split(mark[told][order]):
            blocks.append(b)
            found.append(_pack(address[told][order][s]))
    return pa.table({"block": pa.array(blocks, pa.int32()), "addresses": pa.array(found, pa.binary())})


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """doc_ids and whether they are known."""
    col = table.column("doc_id").combine_chunks()
    return col.fill_null(0).to_numpy(zero_copy_only=False), ~np.asarray(col.is_null().to_numpy(zero_copy_only=False), bool)


def _texts(table: pa.Table) -> pa.Array:
    col = table.column("text").combine_chunks().cast(pa.large_string())
    return pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col


class Members:
    """Whether values are in a set: a bit table first, then a search of the sorted set."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self._low(values)] = True

    @staticmethod
    def _low(values: np.ndarray) -> np.ndarray:
        return (values & U64((1 << FILTER_BITS) - 1)).astype(np.int64)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of entries of x that are in the set, and their (first) places in it."""
        at = np.flatnonzero(self.maybe[self._low(x)])
        place = np.searchsorted(self.values, x[at])
        place[place == len(self.values)] = 0
        same = self.values[place] == x[at] if len(self.values) else np.zeros(len(at), bool)
        return at[same], place[same]


EXACT = "shard int, block int, high binary, low binary, doc binary, several binary"


def remove_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space) of each document."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    shards = max(1, -(-int(total / BYTES_PER_ANCHOR / LOAD) >> CELL_BITS))
    block = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_blocks)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), block.alias("block"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        address, place, held = [], [], 0
        for b in batches:
            where = b.column(1).to_numpy()
            for i, _, w in _windows(text_column(b, "text"), width, anchor):
                address.append(_address(w.anchor, shards))
                place.append(where[i + w.text[w.run]])
                held += len(w.run)
            if held * 12 > ROWS_BYTES * 8:
                yield from _partition_sketch(np.concatenate(address), np.concatenate(place), shards)
                address, place, held = [], [], 0
        if held:
            yield from _partition_sketch(np.concatenate(address), np.concatenate(place), shards)

    def candidates(texts: pa.Table, told: pa.Table) -> pa.Table:
        """The distinct windows of a block that are estimated repeated."""
        ids, known = _ids(texts)
        parts = [_unpack(a, "<u8") for a in told.column("addresses").to_pylist()]
        repeated = Members(np.unique(np.concatenate(parts)) if parts else np.zeros(0, U64))
        high, low, doc = [], [], []
        for i, _, w in _windows(_texts(texts), width, anchor) if parts and len(ids) else ():
            mask = np.zeros(len(w.run), bool)
            mask[repeated.find(_address(w.anchor, shards))[0]] = True
            at = w.chosen(mask)
            at = at[known[i + w.text[at]]]
            if len(at):
                k1, k2 = w.keys()
                high.append(k1[at])
                low.append(k2[at].astype(np.uint32))
                doc.append(ids[i + w.text[at]])
        out = []
        if high:
            high, low, doc = np.concatenate(high), np.concatenate(low), np.concatenate(doc)
            order = np.lexsort((doc, low, high))
            high, low, doc = high[order], low[order], doc[order]
            start = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
            last = np.append(start[1:], len(high)) - 1
            high, low, several, doc = high[start], low[start], doc[last] > doc[start], doc[start]
            shard = (high % U64(n_blocks)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            for s, r in split(shard[order]):
                k = order[r]
                out.append((s, high[k].tobytes(), low[k].tobytes(), _pack(doc[k]), _pack(np.packbits(several[k]))))
        name = texts.column("block")[0].as_py() if len(texts) else -1
        part = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table({"shard": pa.array(part[0], pa.int32()), "block": pa.array([name] * len(out), pa.int32()),
                         "high": pa.array(part[1], pa.binary()), "low": pa.array(part[2], pa.binary()),
                         "doc": pa.array(part[3], pa.binary()), "several": pa.array(part[4], pa.binary())})

    def group(table: pa.Table) -> pa.Table:
        """For each block its windows that start in a smaller doc_id than one of its own, with the smallest."""
        columns = [table.column(c).to_pylist() for c in ("block", "high", "low", "doc", "several")]
        high = [np.frombuffer(x, "<u8") for x in columns[1]]
        size = [len(x) for x in high]
        high, low = np.concatenate(high), np.concatenate([np.frombuffer(x, "<u4") for x in columns[2]])
        doc = np.concatenate([_unpack(x, "<i8") for x in columns[3]])
        several = np.concatenate([np.unpackbits(_unpack(x, "u1"), count=n).astype(bool) for x, n in zip(columns[4], size, strict=True)])
        place = np.repeat(np.array(columns[0], np.int32), size)
        order = np.lexsort((doc, low, high))
        h, lo = high[order], low[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])]
        least = np.empty(len(doc), np.int64)
        least[order] = doc[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        told = np.flatnonzero(several | (doc > least))
        told = told[np.argsort(place[told], kind="stable")]
        out = [(b, high[told[s]].tobytes(), low[told[s]].tobytes(), _pack(least[told[s]])) for b, s in split(place[told])]
        part = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table({"block": pa.array(part[0], pa.int32()), "high": pa.array(part[1], pa.binary()),
                         "low": pa.array(part[2], pa.binary()), "doc": pa.array(part[3], pa.binary())})

    def rewrite(texts: pa.Table, told: pa.Table) -> pa.Table:
        ids, known = _ids(texts)
        n = len(ids)
        high = low = least = None
        if len(told):
            high = np.concatenate([np.frombuffer(x, "<u8") for x in told.column("high").to_pylist()])
            low = np.concatenate([np.frombuffer(x, "<u4") for x in told.column("low").to_pylist()])
            least = np.concatenate([_unpack(x, "<i8") for x in told.column("doc").to_pylist()])
            order = np.argsort(high, kind="stable")
            high, low, least = high[order], low[order], least[order]
            repeated = Members(high)
        words_of, removed_of, kept_of = np.zeros(n, np.int64), np.zeros(n, np.int64), [b""] * n
        for i, j, w in _windows(_texts(texts), width, anchor) if n else ():
            words = w.words
            words_of[i:j] = np.diff(words.first)
            gone = None
            if high is not None and len(w.at):
                k1, k2 = w.keys()
                at, place = repeated.find(k1)
                owner = i + w.text[at]
                hit = (low[place] == k2[at]) & known[owner] & (ids[owner] > least[place])
                if hit.any():
                    mask = np.zeros(len(w.word), bool)
                    mask[w.at[at[hit]]] = True
                    gone = covered(mask, width, len(w.word))
                    removed_of[i:j] = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (np.diff(words.first) > 0)
            data = words.body.tobytes()
            off, first = words.off.tolist(), words.first.tolist()
            for k in range(j - i):
                tokens = data[off[k] : off[k + 1]].split()
                if removed_of[i + k]:
                    tokens = compress(tokens, ~gone[first[k] : first[k + 1]])
                kept_of[i + k] = b" ".join(tokens)
        return pa.table({
            "doc_id": texts.column("doc_id"), "n_words": words_of, "n_removed": removed_of,
            "kept": pa.array(kept_of, pa.binary()).cast(pa.string())})

    told = rows.filter("doc_id IS NOT NULL").select("text", "block").mapInArrow(sketch, SKETCH).groupBy("shard").applyInArrow(
        _merged_sketch, "block int, addresses binary")
    pieces = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(candidates, EXACT)
    smaller = pieces.groupBy("shard").applyInArrow(group, "block int, high binary, low binary, doc binary")
    return rows.groupBy("block").cogroup(smaller.groupBy("block")).applyInArrow(
        rewrite, "doc_id long, n_words long, n_removed long, kept string")
