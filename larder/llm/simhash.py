"""Near duplicates by SimHash, found with a hierarchical index in Gray order.

A fingerprint's bit is set if it is set in over half of the 64-bit hashes of the text's three-word shingles.  Texts are linked
when their fingerprints differ in at most `MOST` bits.  Equal fingerprints are one node from the first shuffle on.

*Index.*  Nodes are sorted by Gray rank, the place of a code in the reflected Gray sequence, where neighbours differ in few bits.
`FAN` consecutive nodes make an upper node, and so on up.  An upper node keeps the bits in which all below it agree, less those that
its own parent keeps already: every bit is compared once on the way down, on the highest level where it is shared.  A
search adds up differing bits on its way and drops a node, and all below it, as soon as they exceed `MOST`.

*Spread.*  The sorted nodes are cut into ranges.  The ranges' shared bits, at most `MOST_RANGES` rows, are the leaves of a small upper
index that every task holds; it tells which ranges a fingerprint has to visit.  A pair of ranges is met from the lower
one alone.  In a range's task the index is built from the range's own nodes and the visitors are streamed past it; ranges with many
visitors are copied to several tasks.  A fingerprint has at most 2,080 others within two bits, so links are linear in the nodes;
they are thinned to a forest in each task, and components are found over what is left.

Defined cases: null and empty texts, and texts without words, have the fingerprint zero and are linked like any other; texts of one or two
words have one shingle; equal rows are rows of one class; a null doc_id is never the smallest, and a class of null doc_ids alone
has a null component_id; very long texts are counted in blocks of shingles; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.ordering import in_ranges
from larder.llm.components import components, forest
from larder.llm.hot_keys import look_up
from larder.llm.words import LOWER, SEPARATOR, U64, Words, raw, slices, text_column
from larder.session import materialize

WIDTH = 3
SEED = 42
MOST = 2
FAN = 8
COUNTED = 1 << 16  # shingles whose bits are spread out at a time
FRONTIER = 1 << 16  # (query, node) pairs that go down a level at a time
QUERIES = 1 << 12
HELD_EDGES = 1 << 20
LEAST_RANGES = 64
MOST_RANGES = 1 << 16
RANGE_NODES = 1 << 20
VISITORS = 1 << 22  # visitors of one copy of a range


def hashes(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every shingle of some texts, in order."""
    from xxhash import xxh64_intdigest

    words = Words(body, off)
    size = words.end - words.start
    begin = np.cumsum(size + 1) - size - 1  # words joined by one space
    inside = np.flatnonzero(~SEPARATOR[body])
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    joined[inside + np.repeat(begin - words.start, size)] = LOWER[body[inside]]
    count = np.diff(words.first)
    runs = np.where(count >= WIDTH, count - WIDTH + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), runs)
    first = np.repeat(words.first[:-1], runs) + np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    last = np.minimum(first + WIDTH, words.first[1:][text]) - 1
    data = joined.tobytes()
    pairs = zip(begin[first].tolist(), (begin[last] + size[last]).tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(data[a:b], SEED) for a, b in pairs), U64, len(text)), text


def majority(h: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The bits set in over half of each text's hashes; zero for a text without any."""
    ones = np.zeros((n, 64), np.int64)
    for i in range(0, len(h), COUNTED):
        part = text[i : i + COUNTED]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        bits = np.unpackbits(h[i : i + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[part[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > np.bincount(text, minlength=n)[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(U64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, off = raw(text_column(batch, "text"))
            found = [majority(*hashes(body[off[i] : off[j]], off[i : j + 1] - off[i]), j - i) for i, j in slices(off)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = fp.astype(U64, copy=True)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> U64(shift)
    return rank


def gray_order(fp: Column) -> Column:
    """A long that sorts like the Gray rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order


class GrayIndex:
    """Nodes in Gray order, each with the bits that all codes below it have (`every`) or that any of them has (`some`)."""

    def __init__(self, every: np.ndarray, some: np.ndarray):
        self.levels = [(every, some)]
        while len(every) > 1:
            starts = np.arange(0, len(every), FAN)
            every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
            self.levels.append((every, some))
        above = np.zeros(1, U64)
        self.nodes = []  # (pattern, mask): the bits that a node compares
        for every, some in reversed(self.levels):
            shared = ~(every ^ some)
            self.nodes.insert(0, (every, shared & ~np.repeat(above, FAN)[: len(every)] if len(every) > 1 else shared))
            above = shared
        self.visited = 0

    def search(self, code: np.ndarray, after: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, item) pairs whose compared bits differ in at most MOST, with items beyond `after` of their query."""
        if not len(self.levels[0][0]):
            return
        top = len(self.levels) - 1
        for i in range(0, len(code), QUERIES):
            q = np.arange(i, min(i + QUERIES, len(code)))
            left = [(top, q, np.zeros(len(q), np.int64), np.zeros(len(q), np.uint8))]
            while left:
                level, q, node, apart = left.pop()
                pattern, mask = self.nodes[level]
                self.visited += len(q)
                apart = apart + np.bitwise_count((code[q] ^ pattern[node]) & mask[node])
                # The last item below a node is the one before the next node's first.
                near = (apart <= MOST) & ((node + 1) * FAN**level - 1 > after[q])
                q, node, apart = q[near], node[near], apart[near]
                if not level:
                    if len(q):
                        yield q, node
                    continue
                width = len(self.levels[level - 1][0])
                for k in range(0, len(q), FRONTIER):
                    child = (node[k : k + FRONTIER, None] * FAN + np.arange(FAN)).ravel()
                    real = child < width
                    left.append((level - 1, np.repeat(q[k : k + FRONTIER], FAN)[real], child[real], np.repeat(apart[k : k + FRONTIER], FAN)[real]))


def links(nodes: DataFrame, range_nodes: int = RANGE_NODES, least_ranges: int = LEAST_RANGES, visitors: int = VISITORS) -> DataFrame:
    """Edges (a, b) between fingerprints of `nodes` (fp: distinct) that differ in at most MOST bits, as forests of the tasks."""
    spark = nodes.sparkSession
    count = nodes.count()
    ranges = min(MOST_RANGES, max(least_ranges, -(-count // range_nodes)))
    placed = in_ranges(nodes.select("fp"), [gray_order(F.col("fp"))], ranges).select("_range", "fp")
    # At most MOST_RANGES rows, of 24 bytes each.
    tops = sorted(placed.groupBy("_range").agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some")).collect(), key=lambda r: r["_range"])
    name = np.array([r["_range"] for r in tops], np.int64)
    every, some = (np.array([r[c] for r in tops], np.int64).view(U64) for c in ("every", "some"))

    def visits(batch: pa.RecordBatch, index: GrayIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprints, places of their ranges among all, visitor, place of the visited range)."""
        fp = np.asarray(batch.column(1)).view(U64)
        own = np.searchsorted(name, np.asarray(batch.column(0)))
        met = list(index.search(fp, own))
        visitor, at = (np.concatenate([m[k] for m in met]) if met else np.zeros(0, np.int64) for k in (0, 1))
        return fp, own, visitor, at

    def count_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, seen = GrayIndex(every, some), np.zeros(len(name), np.int64)
        for batch in batches:
            seen += np.bincount(visits(batch, index)[3], minlength=len(name))
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(seen[met])], names=["at", "n"])

    copies = np.ones(len(name), np.int64)
    for r in placed.mapInArrow(count_visits, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # a row a range
        copies[r["at"]] = max(1, -(-r["n"] // visitors))
    unit = np.cumsum(copies) - copies

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GrayIndex(every, some)
        for batch in batches:
            fp, own, visitor, at = visits(batch, index)
            home = np.repeat(np.arange(len(fp)), copies[own])
            copy = np.arange(len(home)) - np.repeat(np.cumsum(copies[own]) - copies[own], copies[own])
            to = np.concatenate([unit[own[home]] + copy, unit[at] + (fp[visitor] % U64(997)).astype(np.int64) % copies[at]])
            # Among themselves, a range's nodes are searched in its copies by turns.
            role = np.concatenate([np.where(home % copies[own[home]] == copy, 0, 1), np.full(len(at), 2)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array(role, pa.int8()), pa.array(np.concatenate([fp[home], fp[visitor]]).view(np.int64))],
                names=["unit", "role", "fp"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one unit: its nodes (0: searched here, 1: not), then visitors (2)."""
        held, index, item, edges, size = [], None, None, [], 0

        def thin() -> pa.RecordBatch | None:
            nonlocal edges, size
            if not edges:
                return None
            a, b = forest(*(np.concatenate(x) for x in zip(*edges, strict=True)))
            edges, size = [(a, b)], len(a)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def meet(code: np.ndarray, after: np.ndarray) -> None:
            nonlocal size
            for q, node in index.search(code, after):
                edges.append((code[q].view(np.int64), item[node].view(np.int64)))
                size += len(q)
                if size > 2 * HELD_EDGES:
                    thin()

        def build() -> None:
            nonlocal index, item, held
            role, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(gray_rank(fp))
            item, held = fp[order], []
            index = GrayIndex(item, item)
            mine = np.flatnonzero(role[order] == 0)
            meet(item[mine], mine)

        for batch in batches:
            role, fp = np.asarray(batch.column(1)), np.asarray(batch.column(2)).view(U64)
            if (role < 2).any():
                held.append((role[role < 2], fp[role < 2]))
            if (role == 2).any():
                if held:
                    build()
                code = fp[role == 2]
                meet(code, np.full(len(code), -1))
        if held:
            build()
        found = thin()
        if found is not None:
            yield found

    units = int(copies.sum())
    if not units:
        return spark.createDataFrame([], "a long, b long")
    sent = placed.mapInArrow(send, "unit int, role byte, fp long")
    return sent.repartitionById(units, "unit").sortWithinPartitions("role").select("unit", "role", "fp").mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable by links) of every document."""
    prints = materialize(fingerprints(docs))
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(links(nodes)).withColumnRenamed("node", "fp")
    named = materialize(nodes.join(linked, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    class_of = look_up(named.select("fp", "component"), least, "component").select("fp", "component_id")
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return look_up(prints, class_of, "fp").select("doc_id", fingerprint.alias("fingerprint"), "component_id")
