"""Near duplicates by the Jaccard similarity of word shingles, found with trees over count vectors.

A document's set holds 48-bit hashes of its distinct five-word shingles (of the whole sequence where there are fewer words).
Equal sets are one node from here on, however many copies they have.

1. *Groups.*  Shingles are hashed into groups, more groups than two linked sets can differ in shingles: sets of n and m
   shingles and similarity t differ in at most (n + m) (1 - t) / (1 + t).  So one group at least is the same, and not empty, in
   both; nodes meet by the hash of a group's whole content.  The number of groups goes by a level of sizes, which a
   set shares with every set it can be linked to.  (A set with too few non-empty groups meets by single shingles instead.)
2. *Families.*  Before that, sets that agree in a pair of least hashes (one of BANDS pairs) are put in one family, each under a
   constant number of rows.  A family is one node among the keys, so that near copies, which share nearly all of their keys, don't
   meet in every shard of keys.  Families decide nothing: all members of one are in one cluster.  All other nodes go to the shards
   under numbers that count up within a task's piece, so that what a key costs there doesn't grow with the number of shards.
3. *Stars.*  No pairs are listed: the families with a key are joined to the smallest of them.  A linked set has a number of groups in
   common with each of its partners, and a family that does not share as many keys, with whomever, is left out.
4. *Tree.*  Families and stars form clusters.  Each set is a point, its counts in GROUPS groups, and the sum of coordinate minima of two
   points bounds their overlap.  A cluster's points are packed by size and coordinates into an R-tree; boxes keep the largest
   coordinates, so minima with a box bound the overlap with anything below it, and a search leaves out whole branches.
   Surviving pairs are verified on the sets.  Pairs that are connected already aren't verified again, so a dense group costs about
   one test a node.
5. *Large clusters* are one tree over many tasks.  Their nodes, in order of size and coordinates, are cut into leaves; boxes of
   BOX leaves, of BOX such boxes and so on are its upper levels.  Leaves are searched in themselves first, with a few nodes of the
   cluster in all of them.  Then pairs of boxes go down the tree, and what their bounds leave at the bottom are pairs of leaves;
   from these only nodes outside the cluster's largest component meet all others.

No bucket, cluster or partner list is capped.  Components follow from the links.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; rows of equal doc_id are
documents of their own; a null doc_id takes the component_id of what it is linked with, or null; an empty table gives no row;
other columns are ignored (`near_duplicates`) or kept (`one_of_each`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larder.functions.ordering import running_total
from larder.llm.components import components
from larder.llm.hot_keys import look_up
from larder.llm.substring_dedup import Members, split
from larder.llm.words import U64, Words, mix, raw, run_inside, shingles, slices, text_column
from larder.session import materialize

WIDTH = 5
PERCENT = 80
GROUPS = 64
BOX = 32
LEAF = 1024
LEAF_SHINGLES = 2_000_000
SHARED_NODES = 16
SHARD_BYTES = 24 << 20
FILTER_BITS = 1 << 24  # of the bitmaps of wanted documents and of families' nodes, 2 MB each whatever the input
BITMAP_BITS = 1 << 15  # of one row of Spark's bitmap aggregate
BANDS = 4
BAND_ROWS = 2
HELD_KEYS = 1 << 20
HASH_BITS = U64(48)
TRIES = 12
STEP = 1.25  # ratio of the sizes of neighbouring levels


def _levels(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each level its smallest size, the most shingles in which two of its linked sets differ, and its groups."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, int(least[-1] * STEP)))
    least = np.array(least)
    differ = 2 * (least[1:] - 1) * (100 - percent) // (100 + percent)
    return least[:-1], differ, np.maximum(differ + 1, -(-5 * differ // 4)) + 1


def shingle_sets(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sets of a slice of at most 65,536 texts: ascending hashes in a row, and where each text's begin."""
    word, first = words.hashes(lower=True), words.first
    size = np.diff(first)
    n = len(size)
    ok = run_inside(first, width)
    at = np.flatnonzero(ok)
    text = np.repeat(np.arange(n), np.maximum(size - width + 1, 0))
    parts, owners = [shingles(word, width)[at] if len(at) else np.zeros(0, U64)], [text]
    for short in range(1, width):
        have = np.flatnonzero(size == short)
        if len(have):
            parts.append(shingles(word, short)[first[have]])
            owners.append(have)
    key = np.concatenate(owners).astype(U64) << HASH_BITS | np.concatenate(parts) >> U64(64 - int(HASH_BITS))
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    start = np.searchsorted(key >> HASH_BITS, np.arange(n + 1, dtype=U64))
    return key & U64((1 << int(HASH_BITS)) - 1), start


def set_names(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One number per set; equal sets have equal ones.  0 is the empty set."""
    total = np.concatenate([[U64(0)], np.cumsum(mix(hashes + U64(0x632BE59BD9B4E019)), dtype=U64)])
    size = np.diff(start).astype(U64)
    name = mix((total[start[1:]] - total[start[:-1]]) ^ mix(size))
    return np.where(size > 0, np.maximum(name, U64(1)), U64(0)).view(np.int64)


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    body, off = raw(texts)
    for i, j in slices(off):
        for a in range(i, j, 1 << 16):
            b = min(j, a + (1 << 16))
            yield a, b, *shingle_sets(Words(body[off[a] : off[b]], off[a : b + 1] - off[a]))


def least_overlap(n, m, percent: int = PERCENT):
    """Shared shingles that sets of n and m need: percent * (n + m - o) <= 100 * o."""
    return -(-percent * (n + m) // (100 + percent))


def least_common(hashes: np.ndarray, start: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The fewest groups that each set has in common with any set it is linked to, on any of its levels."""
    least = np.append(_levels(percent)[0], 1 << 62)
    size = np.diff(start)
    common = np.full(len(size), 1 << 40)
    owner = np.repeat(np.arange(len(size)), size)
    for here, level, base, at in _grouped(hashes, start, size > 0, owner, percent):
        filled = np.unique(base[owner[here[owner]]] + at)
        count = np.bincount(np.flatnonzero(here)[np.searchsorted(base[here], filled, "right") - 1], minlength=len(size))
        largest = np.minimum(size * 100 // percent, least[level + 1] - 1)
        left = count - (size + largest) * (100 - percent) // (100 + percent)
        common[here] = np.minimum(common[here], left[here])
    return np.maximum(common, 1)


def band_values(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """BANDS numbers of each set, each the hash of its BAND_ROWS least shingles by as many orders; 0 for the empty set."""
    filled = np.diff(start) > 0
    out = np.zeros((len(filled), BANDS), U64)
    if filled.any():
        for band in range(BANDS):
            value = np.full(int(filled.sum()), band + 1, U64)
            for row in range(BAND_ROWS):
                order = mix(hashes ^ mix(np.array([BAND_ROWS * band + row + 1], U64)))
                value = mix(value ^ np.minimum.reduceat(order, start[:-1][filled]))
            out[filled, band] = value
    return out.view(np.int64)


def set_table(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, node, common (see `least_common`), bands of each document, as a written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, names, common = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            bands = np.zeros((b.num_rows, BANDS), np.int64)
            for i, j, h, start in _sets(text_column(b, "text")):
                size[i:j], names[i:j], common[i:j] = np.diff(start), set_names(h, start), least_common(h, start, percent)
                bands[i:j] = band_values(h, start)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(names), pa.array(common), bands],
                                             names=["doc_id", "n", "node", "common", "bands"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return materialize(rows.mapInArrow(run, "doc_id long, n long, node long, common long, bands array<long>"))


def families(nodes: DataFrame) -> DataFrame:
    """node, family (its smallest node) of the nodes that have a band in common with another one, as a written table."""
    bands = materialize(nodes.select("node", F.explode("bands").alias("band")))
    heads = bands.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head < last").select("band", "head")
    found = look_up(bands, heads, "band").select(F.col("head").alias("a"), F.col("node").alias("b"))
    return materialize(components(found).withColumnRenamed("component", "family"))


def _grouped(hashes: np.ndarray, start: np.ndarray, use: np.ndarray, owner: np.ndarray, percent: int):
    """For each level step: the marked sets that are at it, their levels, where their groups start, and the group of each of
    their shingles."""
    least, _, groups = _levels(percent)
    size = np.diff(start)
    low = np.searchsorted(least, np.maximum(size, 1), "right") - 1
    high = np.searchsorted(least, np.maximum(size, 1) * 100 // percent, "right") - 1
    spread = mix(hashes ^ U64(0x5851F42D4C957F2D)) >> U64(20)
    for step in range(int((high - low).max(initial=-1)) + 1):
        level = low + step
        here = use & (size > 0) & (level <= high)
        if here.any():
            many = np.where(here, groups[level], 0)
            mine = here[owner]
            yield here, level, np.cumsum(many) - many, (spread[mine] % many[owner[mine]].astype(U64)).astype(np.int64)


def group_keys(hashes: np.ndarray, start: np.ndarray, use: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the marked sets, and whose they are: two linked sets that differ have a key in common."""
    _, differ, groups = _levels(percent)
    size = np.diff(start)
    owner = np.repeat(np.arange(len(size)), size)
    spread, keys, owners = mix(hashes ^ U64(0x14057B7EF767814F)), [], []
    for here, level, base, at in _grouped(hashes, start, use, owner, percent):
        mine = here[owner]
        who, at = owner[mine], base[owner[mine]] + at
        content = np.zeros(int(np.where(here, groups[level], 0).sum()), U64)
        np.add.at(content, at, spread[mine])
        filled = np.flatnonzero(np.bincount(at, minlength=len(content)))
        whose = np.flatnonzero(here)[np.searchsorted(base[here], filled, "right") - 1]
        place = (filled - base[whose]).astype(U64) + (level[whose].astype(U64) << U64(32))
        keys.append(mix(content[filled] + mix(place)))
        owners.append(whose)
        few = here & (np.bincount(whose, minlength=len(size)) <= differ[level])
        single = few[who]
        keys.append(mix(hashes[mine][single] + mix(level[who[single]].astype(U64) + U64(1 << 62))))
        owners.append(who[single])
    return (np.concatenate(keys), np.concatenate(owners)) if keys else (np.zeros(0, U64), np.zeros(0, np.int64))


PIECE = "shard int, base long, node binary, step binary, key binary"
KEY_BYTES = 5


def node_bitmap(nodes: DataFrame) -> np.ndarray | None:
    """FILTER_BITS bits (a power of two), marked by the low bits of the nodes; None without nodes."""
    parts = -(-FILTER_BITS // BITMAP_BITS)
    place = F.pmod("node", F.lit(parts * BITMAP_BITS)) + 1  # Spark's bitmaps begin with 1
    marks = nodes.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")).collect()
    if not marks:
        return None
    bits = np.zeros((parts, BITMAP_BITS // 8), np.uint8)
    for r in marks:
        bits[r["part"] - 1] = np.frombuffer(r["bitmap"], np.uint8)
    return bits.ravel()


def marked(bits: np.ndarray | None, node: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the nodes, and maybe others."""
    if bits is None:
        return np.zeros(len(node), bool)
    at = node.view(U64) % U64(8 * len(bits))
    return (bits[at >> U64(3)] >> (at & U64(7)).astype(np.uint8) & 1).astype(bool)


def _steps(at: np.ndarray) -> bytes:
    """Ascending numbers as their differences, all in the fewest bytes that hold the largest one."""
    step = np.diff(at, prepend=0)
    return step.astype(np.min_scalar_type(step.max())).tobytes()


def _ascending(steps: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, f"<u{len(steps) // n}"), dtype=np.int64)


def _routed(shards: int, percent: int, bits: np.ndarray | None = None):
    """Each set's keys, packed by shard, once for each set in a task, but for sets that the bitmap has; where rows name the node
    they stand for and its family, the keys of that node, under its family's name.

    Pieces with a base have nodes' numbers in place of nodes: base, base + 1 and so on.  The nodes themselves go once to a shard
    below 0, which is for them alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nodes, rows, seen = [], 0, 0, np.zeros(0, np.int64)
        for b in batches:
            named = "family" in b.schema.names
            for i, j, h, start in _sets(text_column(b, "text")):
                names = set_names(h, start)
                if named:
                    able = np.flatnonzero(names == b.column("node").to_numpy()[i:j])  # another row of the doc_id may have another text
                else:
                    able = np.flatnonzero(~marked(bits, names))
                use = np.zeros(len(names), bool)
                use[able[np.unique(names[able], return_index=True)[1]]] = True
                use &= ~np.isin(names, seen)
                seen = np.concatenate([seen, names[use]])
                key, who = group_keys(h, start, use, percent)
                held.append((key, b.column("family").to_numpy()[i:j][who] if named else nodes + (np.cumsum(use) - 1)[who]))
                nodes += int(use.sum())
                rows += len(key)
                if rows > HELD_KEYS:
                    yield from pack(held, None if named else seen)
                    held, nodes, rows, seen = [], 0, 0, seen[:0]
        if rows:
            yield from pack(held, None if named else seen)

    def pack(held: list, nodes: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        key, node = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        shard = (key >> U64(40)) % U64(shards)
        order = np.lexsort((key, node, shard) if nodes is None else (node, shard))
        key, node, shard = key[order], node[order], shard[order].astype(np.int64)
        out, base = [], None
        if nodes is None:  # sets of a family share keys
            once = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
            key, node, shard = key[once], node[once], shard[once]
        else:
            base = int(mix(mix(nodes.view(U64)).sum(keepdims=True)).view(np.int64)[0])
            out.append((-1 - base % (1 << 30), base, nodes.tobytes(), None, None))
        for s, r in split(shard):
            who, at = (None, node[r]) if nodes is not None else np.unique(node[r], return_inverse=True)
            out.append((s, base, None if who is None else who.tobytes(), _steps(at), key[r].view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()))
        for i in range(0, len(out), 64):
            part = list(zip(*out[i : i + 64], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int64()), *(pa.array(p, pa.binary()) for p in part[2:])],
                                             names=["shard", "base", "node", "step", "key"])

    return run


def _numbers(base: int, at: np.ndarray) -> np.ndarray:
    """The numbers that stand for the nodes at these places of a piece; they wrap around at 64 bits."""
    return (np.array([base], np.int64).view(U64) + at.astype(U64)).view(np.int64)


def _stars(table: pa.Table) -> pa.Table:
    """a, b, keys: the smallest node of a key of the shard and another one that has it, with their number of such keys; and for the
    smallest nodes (a = b) the number of keys in which they are that.  Nodes may be numbers here; the shards below 0 tell the
    nodes (b) of the numbers (a), with keys 0."""
    base, node, step, key = (table.column(c).to_pylist() for c in ("base", "node", "step", "key"))
    if table.column("shard")[0].as_py() < 0:
        node = [np.frombuffer(x, "<i8") for x in node]
        number = np.concatenate([_numbers(k, np.arange(len(x))) for k, x in zip(base, node, strict=True)])
        return pa.table({"a": pa.array(number), "b": pa.array(np.concatenate(node)), "keys": pa.array(np.zeros(len(number), np.int64))})
    end = np.cumsum([len(x) // KEY_BYTES for x in key])
    part = np.concatenate([np.frombuffer(x, np.uint8) for x in key]).reshape(-1, KEY_BYTES)
    key = np.zeros((len(part), 8), np.uint8)
    key[:, :KEY_BYTES] = part
    key = key.view("<u8").ravel()
    ordered = np.sort(key)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered, part
    at = Members(shared).find(key)[0]  # nodes are spelt out for shared keys alone
    key, whose = key[at], []
    cut = np.searchsorted(at, np.append(0, end))
    for k, (first, last) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if first < last:
            begin = end[k - 1] if k else 0
            place = _ascending(step[k], int(end[k] - begin))[at[first:last] - begin]
            whose.append(np.frombuffer(node[k], "<i8")[place] if node[k] is not None else _numbers(base[k], place))
    node = np.concatenate(whose) if whose else np.zeros(0, np.int64)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    once = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])] if len(key) else np.zeros(0, bool)
    key, node = key[once], node[once]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(key)))
    more = np.repeat(size > 1, size)  # a key may be that of one node of several tasks
    pairs, times = _counted(np.stack([np.repeat(node[start], size)[more], node[more]], 1))
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1]), "keys": pa.array(times)})


def key_stars(docs: DataFrame, nodes: DataFrame, family: DataFrame, shards: int, percent: int = PERCENT, repeated: DataFrame | None = None) -> DataFrame:
    """What `_stars` finds in all shards, with families in place of their nodes, as a written table.

    nodes (node, rep), family (node, family) and repeated (node) are written tables.  Nodes of families and repeated ones, those of
    several documents, get their keys from a document that has the set and is joined with them; all others (but for a few, by
    the bitmap) straight from the documents.  (A node of several documents that isn't among the repeated has a number in each task.)
    """
    apart = None
    bits = node_bitmap(family.select("node") if repeated is None else family.select("node").unionByName(repeated))
    routed = docs.select("text").mapInArrow(_routed(shards, percent, bits), PIECE)
    if bits is not None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(marked(bits, b.column("node").to_numpy())))

        apart = nodes.select("node", "rep").mapInArrow(run, "node long, rep long").join(family, "node", "left")
        apart = materialize(apart.withColumn("family", F.coalesce("family", "node")))
        texts = wanted(docs.select(F.col("doc_id").alias("rep"), "text"), apart.select("rep"))
        texts = joined_texts(apart, texts).select("node", "family", "text")
        routed = routed.unionByName(texts.mapInArrow(_routed(shards, percent), PIECE))
    found = materialize(routed.groupBy("shard").applyInArrow(_stars, "a long, b long, keys long"))
    stars = found.filter("keys > 0")
    names = found.filter("keys = 0").select("a", F.col("b").alias("node"))
    if apart is not None:
        names = names.unionByName(apart.select(F.col("family").alias("a"), F.col("family").alias("node")).distinct())
    for end in "ba":
        stars = materialize(look_up(stars, names.select(F.col("a").alias(end), "node"), end).drop(end).withColumnRenamed("node", end))
    return stars.select("a", "b", "keys")


def _counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often they occur."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]).any(1)]) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.diff(np.append(first, len(pairs)))


def star_edges(stars: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: those edges of the stars whose outer node (of `nodes`: node, common) shares as many keys as a link needs."""
    shared = stars.groupBy(F.col("b").alias("node")).agg(F.sum("keys").alias("shared"))
    able = nodes.join(shared, "node").filter("shared >= common").select(F.col("node").alias("b"))
    return stars.filter("a <> b").select("a", "b").join(able, "b").select("a", "b")


def candidates(stars: DataFrame, nodes: DataFrame, family: DataFrame) -> DataFrame:
    """node, component: the clusters made of families and of what their stars connect."""
    common = nodes.join(family, "node", "left").groupBy(F.coalesce("family", "node").alias("node")).agg(F.min("common").alias("common"))
    joined = materialize(components(star_edges(stars, common)))
    heads = family.select("family").distinct().join(joined.withColumnRenamed("node", "family"), "family", "left")
    members = look_up(family, heads.select("family", F.coalesce("component", "family").alias("component")), "family")
    return members.select("node", "component").unionByName(joined.join(family.select("node"), "node", "left_anti"))


def may_link(high: np.ndarray, least, most, q: np.ndarray, n, m, percent: int = PERCENT) -> np.ndarray:
    """Whether anything in boxes (largest coordinates, least and most size) can be linked with anything in boxes (q, n, m)."""
    fits = (least * percent <= 100 * m) & (n * percent <= 100 * most)
    # Of all sizes that two boxes leave, the smallest need the smallest overlap.
    return fits & (np.minimum(high, q).sum(-1) >= least_overlap(np.maximum(n, -(-least * percent // 100)), np.maximum(least, -(-n * percent // 100)), percent))


class CountTree:
    """An R-tree over group counts, packed by size and then by coordinates; level 0 holds the points, each further one boxes of BOX."""

    def __init__(self, points: np.ndarray, size: np.ndarray, percent: int = PERCENT):
        self.percent, self.visited = percent, 0
        self.order = np.lexsort((points[:, 1], points[:, 0], size))
        self.size = size[self.order]
        self.levels = [(points[self.order], self.size, self.size)]
        while len(self.levels[-1][1]) > 1:
            high, least, most = self.levels[-1]
            edge = np.arange(0, len(least), BOX)
            self.levels.append((np.maximum.reduceat(high, edge, axis=0), np.minimum.reduceat(least, edge), np.maximum.reduceat(most, edge)))

    def search(self, i: int) -> np.ndarray:
        """Positions after i (in packed order) whose bound reaches the overlap they need with i."""
        q, n = self.levels[0][0][i], self.size[i]
        at = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            high, least, most = self.levels[level]
            if level < len(self.levels) - 1:
                at = (at[:, None] * BOX + np.arange(BOX)).ravel()
            at = at[(at < len(least)) & ((at + 1) * BOX**level - 1 > i)]
            self.visited += len(at)
            at = at[may_link(high[at], least[at], most[at], q, n, n, self.percent)]
        return at


def count_points(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Shingles of each set in each group."""
    owner = np.repeat(np.arange(len(start) - 1), np.diff(start))
    code = owner * GROUPS + (mix(hashes) >> U64(58)).astype(np.int64) % GROUPS
    return np.bincount(code, minlength=(len(start) - 1) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def links(hashes: np.ndarray, start: np.ndarray, known: np.ndarray | None = None, side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Verified pairs of sets that connect all that is linked; sets of equal `known` count as connected, and sets of
    one `side` have been searched among themselves."""
    m = len(start) - 1
    if m < 2:
        return []
    size = np.diff(start)
    tree = CountTree(count_points(hashes, start), size, percent)
    group = np.unique(known, return_inverse=True)[1][tree.order] if known is not None else np.arange(m)
    found = []
    sets = [hashes[start[k] : start[k + 1]] for k in tree.order]
    side = side[tree.order] if side is not None else None

    def join(i: int, j: int) -> None:
        found.append((int(tree.order[i]), int(tree.order[j])))
        group[group == group[j]] = group[i]

    for i in range(m - 1):
        if group[0] == group[-1] and (group == group[0]).all():
            break
        left = tree.search(i)
        left = left[group[left] != group[i]]
        if side is not None:
            left = left[side[left] != side[i]]
        tries = 0
        while len(left) and tries < TRIES:
            j = left[0]
            if len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= least_overlap(len(sets[i]), len(sets[j]), percent):
                join(i, j)
                left = left[group[left] != group[i]]
            else:
                left = left[1:]
                tries += 1
        if len(left):
            length = tree.size[left]
            body = np.concatenate([sets[j] for j in left])
            place = np.minimum(np.searchsorted(sets[i], body), len(sets[i]) - 1)
            shared = np.add.reduceat(sets[i][place] == body, np.cumsum(length) - length, dtype=np.int64)
            for j in left[shared >= least_overlap(len(sets[i]), length, percent)]:
                if group[j] != group[i]:
                    join(i, j)
    return found


def _joined(percent: int):
    """Links of the jobs of one unit; a job is a cluster, a leaf (side null), or a pair of leaves (sides)."""
    def run(table: pa.Table) -> pa.Table:
        node, known, job = (table.column(c).to_numpy() for c in ("node", "known", "job"))
        side = table.column("side").to_numpy()
        col = table.column("text").combine_chunks().cast(pa.large_string())
        col = pa.concat_arrays(col.chunks) if isinstance(col, pa.ChunkedArray) else col
        hashes, size, names = [], [], []
        for _, _, h, start in _sets(col):
            hashes.append(h)
            size.append(np.diff(start))
            names.append(set_names(h, start))
        hashes, size, names = np.concatenate(hashes), np.concatenate(size), np.concatenate(names)
        begin = np.cumsum(size) - size
        right = np.flatnonzero(names == node)  # another row of the same doc_id may have another text
        order = right[np.lexsort((node[right], job[right]))]
        order = order[np.r_[True, (job[order][1:] != job[order][:-1]) | (node[order][1:] != node[order][:-1])]] if len(order) else order
        a, b = [], []
        for _, r in split(job[order]):
            pick = order[r]
            part = np.concatenate([hashes[begin[k] : begin[k] + size[k]] for k in pick])
            start = np.concatenate([[0], np.cumsum(size[pick])])
            apart = side[pick] if side[pick[0]] >= 0 else None
            for x, y in links(part, start, known[pick], apart, percent):
                a.append(node[pick[x]])
                b.append(node[pick[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def joined_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """rows and their texts, both by rep.  Rows are dealt out at all sizes and never broadcast, so that what is shuffled
    is in proportion to the texts that are asked for."""
    return rows.hint("merge").join(texts, rows["rep"].eqNullSafe(texts["rep"]))


def wanted(texts: DataFrame, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of `texts` (rep, ...) whose rep is among `ids`, and some others: a bitmap of hashes, of fixed size, is broadcast so
    that most texts that a join would drop aren't shuffled for it."""
    place = F.pmod(F.xxhash64("rep"), F.lit(bits))
    marks = ids.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit div 8 + 1 AS int), 1)")), 16, 10).cast("int")
    seen = texts.withColumns({"part": F.bitmap_bucket_number(place), "bit": at}).join(F.broadcast(marks), "part")
    return seen.filter(F.getbit(byte.cast("long"), F.pmod(F.col("bit"), F.lit(8)).cast("int")) == 1).select(*texts.columns)


BOXES = "cluster long, at long, least long, most long, high binary"


def _bytes(points: np.ndarray) -> list[bytes]:
    return [p.astype("<u4").tobytes() for p in points]


def _from_bytes(points) -> np.ndarray:
    return np.frombuffer(b"".join(points), "<u4").reshape(-1, GROUPS).astype(np.int64)


def boxes_of(rows: DataFrame) -> DataFrame:
    """One box for each (cluster, at) of smaller ones or of points (least, most, high)."""
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        first = batch.iloc[0]
        high = _from_bytes(batch["high"]).max(0)
        return pd.DataFrame([(first["cluster"], first["at"], batch["least"].min(), batch["most"].max(), _bytes([high])[0])],
                            columns=["cluster", "at", "least", "most", "high"])

    return rows.groupBy("cluster", "at").applyInPandas(run, BOXES)


def box_pairs(leaves: DataFrame, percent: int = PERCENT) -> DataFrame:
    """cluster, i, j: pairs of leaves (i < j) of a cluster between which there may be links, by pairs of boxes from the root down.

    leaves (cluster, at, least, most, high) is a written table; leaves of a cluster are numbered in a row.
    """
    spans = leaves.groupBy("cluster").agg((F.max("at") - F.min("at") + 1).alias("n")).agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while spans > 2:
        levels.append(materialize(boxes_of(levels[-1].withColumn("at", F.expr(f"at div {BOX}")))))
        spans = (spans - 2) // BOX + 2  # boxes that as many in a row can touch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = ([np.asarray(b.column(f"{c}{k}")) for c in ("least", "most")] for k in "ij")
            high = [_from_bytes(b.column(f"high{k}").to_pylist()) for k in "ij"]
            yield b.select(["cluster", "i", "j"]).filter(pa.array(may_link(high[0], *x, high[1], *y, percent)))

    def side(level: DataFrame, k: str) -> DataFrame:
        return level.select("cluster", F.col("at").alias(k), F.expr(f"at div {BOX}").alias(f"above{k}"), *[F.col(c).alias(c + k) for c in ("least", "most", "high")])

    # The boxes of the highest level are one or two in a cluster.
    top = levels[-1]
    pairs = side(top, "i").join(side(top, "j").drop("abovej"), "cluster").filter("i <= j").drop("abovei").mapInArrow(run, "cluster long, i long, j long")
    for level in reversed(levels[:-1]):
        above = pairs.select("cluster", F.col("i").alias("abovei"), F.col("j").alias("abovej"))
        met = above.join(side(level, "i"), ["cluster", "abovei"]).join(side(level, "j"), ["cluster", "abovej"]).filter("i <= j")
        pairs = materialize(met.drop("abovei", "abovej").mapInArrow(run, "cluster long, i long, j long"))
    return pairs.filter("i < j")


def verified_links(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, units: int, percent: int = PERCENT) -> DataFrame:
    """a, b: links that connect all nodes of a cluster that are connected by links.

    nodes: node, rep (a document that has the set), n.  clusters: node, component.  Both are written tables.
    """
    member = clusters.withColumnRenamed("component", "cluster").join(nodes, "node")
    sums = member.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    member = materialize(member.join(sums, "cluster").withColumn("whole", (F.col("c") <= LEAF) & (F.col("s") <= LEAF_SHINGLES)))

    def with_texts(rows: DataFrame, ids: DataFrame) -> DataFrame:
        return joined_texts(rows, wanted(docs.select(F.col("doc_id").alias("rep"), "text"), ids.select("rep")))

    def search(rows: DataFrame, ids: DataFrame) -> DataFrame:
        return with_texts(rows, ids).select("unit", "job", "side", "node", "known", "text").groupBy("unit").applyInArrow(_joined(percent), "a long, b long")

    alone = F.lit(-1).alias("side")
    small = member.filter("whole").select(F.pmod(F.xxhash64("cluster"), F.lit(units)).alias("unit"), F.col("cluster").alias("job"), alone, "node",
                                          F.col("node").alias("known"), "rep")
    large = member.filter("NOT whole").select("cluster", "node", "rep", "n", "c")
    if large.isEmpty():
        return materialize(search(small, member))

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            right, high = np.zeros(b.num_rows, bool), [b""] * b.num_rows
            node = b.column("node").to_numpy()
            for i, j, h, start in _sets(text_column(b, "text")):
                right[i:j] = set_names(h, start) == node[i:j]
                high[i:j] = _bytes(count_points(h, start))
            kept = b.select(["cluster", "node", "rep", "n", "c"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(high, pa.binary())], names=[*kept.schema.names, "high"]).filter(pa.array(right))

    seen = with_texts(large, large).select("cluster", "node", large["rep"], "n", "c", "text").mapInArrow(
        points, "cluster long, node long, rep long, n long, c long, high binary")
    seen = materialize(seen.groupBy("cluster", "node").agg(*[F.first(c).alias(c) for c in ("rep", "n", "c", "high")]))
    # Leaves are runs of at most LEAF nodes and about LEAF_SHINGLES shingles, in order of size and coordinates.
    weight = F.greatest(F.col("n"), F.lit(-(-LEAF_SHINGLES // LEAF)))
    order = [F.col("cluster"), F.col("n"), F.hex(F.reverse(F.substring("high", 1, 4))), F.hex(F.reverse(F.substring("high", 5, 4))), F.col("node")]
    packed = materialize(running_total(seen.repartition("cluster", "node"), order, weight, "ahead").withColumn("at", F.expr(f"ahead div {LEAF_SHINGLES}")).drop("ahead"))
    leaves = materialize(boxes_of(packed.select("cluster", "at", F.col("n").alias("least"), F.col("n").alias("most"), "high")))

    everywhere = F.pmod(F.xxhash64("node", F.lit("shared")), F.lit(1 << 30)) < F.lit(SHARED_NODES * (1 << 30)) / F.col("c")
    copied = packed.filter(everywhere).drop("at").join(leaves.select("cluster", "at"), "cluster")
    rows = packed.select("cluster", "at", "node", "rep").unionByName(copied.select("cluster", "at", "node", "rep")).distinct()
    rows = rows.withColumn("job", F.xxhash64("cluster", "at"))
    found = materialize(search(small.unionByName(rows.select(F.col("job").alias("unit"), "job", alone, "node", F.col("node").alias("known"), "rep")), member))

    label = components(found).withColumnRenamed("component", "known")
    packed = packed.drop("high").join(label, "node", "left").withColumn("known", F.coalesce("known", "node"))
    largest = packed.groupBy("cluster", "known").count().groupBy("cluster").agg(F.max_by("known", F.struct("count", "known")).alias("main"))
    packed = materialize(packed.join(largest, "cluster").withColumn("other", F.col("known") != F.col("main")))
    open_ = packed.groupBy("cluster", "at").agg(F.max("other").alias("open"))
    pairs = box_pairs(leaves, percent)
    for k in "ij":
        pairs = pairs.join(open_.withColumnsRenamed({"at": k, "open": f"open{k}"}), ["cluster", k])
    pairs = pairs.filter("openi OR openj").withColumn("job", F.xxhash64("cluster", "i", "j"))
    sent = None  # a leaf sends all its nodes where the other one has nodes outside the main component, else only its own such nodes
    for number, (k, o) in enumerate(("ij", "ji")):
        one = packed.join(pairs.select("cluster", F.col(k).alias("at"), "job", F.col(f"open{o}").alias("all")), ["cluster", "at"]).filter("all OR other")
        one = one.select(F.col("job").alias("unit"), "job", F.lit(number).alias("side"), "node", "known", "rep")
        sent = one if sent is None else sent.unionByName(one)
    sent = materialize(sent)
    return found.union(materialize(search(sent, sent)))


def _labelled(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, n, node (of the row's set), root (a name of what links reach from it) and component_id of each document."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    sets = set_table(docs, percent)
    nodes = materialize(sets.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "common", "bands")]))
    family = families(nodes)
    repeated = nodes.filter("copies > 1").select("node")
    clusters = materialize(candidates(key_stars(docs, nodes, family, shards, percent, repeated), nodes, family))
    nodes = nodes.select("node", "rep", "n")
    linked = components(verified_links(docs, nodes, clusters, shards, percent))
    label = nodes.join(linked, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("root"))
    least = label.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = label.join(least, "root").select("node", "root", "component_id")
    return sets.select("doc_id", "n", "node").join(named, "node", "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach) of each document."""
    return _labelled(docs, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _with_node(docs: DataFrame) -> DataFrame:
    """`docs` and the node of each row's set, as column __node__."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = np.zeros(b.num_rows, np.int64)
            for i, j, h, start in _sets(text_column(b, "text")):
                names[i:j] = set_names(h, start)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names)], names=[*b.schema.names, "__node__"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__node__", LongType())]))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all columns, of which each group of linked ones keeps its first: the row with the smallest doc_id
    (null last), then the smallest node, then the smallest text; rows without words stay."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    rows = materialize(_labelled(docs, percent).groupBy("doc_id", "node", "root").agg(F.count("*").alias("copies")))
    first = materialize(rows.filter("root IS NOT NULL").groupBy("root").agg(F.min(place).alias("first")).select("root", "first.node", "first.doc_id"))
    mine = rows.join(first.select("root", F.col("node").alias("first_node"), F.col("doc_id").alias("first_id")), "root", "left").withColumn(
        "gone", F.col("root").isNotNull() & ~((F.col("node") == F.col("first_node")) & F.col("doc_id").eqNullSafe(F.col("first_id"))))
    some = F.max(F.col("gone")) | (F.max(F.when(F.col("root").isNotNull() & ~F.col("gone"), F.col("copies")).otherwise(1)) > 1)
    ids = materialize(mine.groupBy("doc_id").agg(F.min("gone").alias("whole"), some.alias("some")).filter("some"))
    # An id goes whole, or only some of its rows do and they are looked at one by one.
    kept = docs.join(ids.filter("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_anti").select(*[docs[c] for c in docs.columns])
    part = ids.filter("NOT whole OR doc_id IS NULL")
    if part.isEmpty():
        return kept
    none = not part.filter("doc_id IS NULL").isEmpty()
    looked = docs.join(part.filter("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_semi").select(*[docs[c] for c in docs.columns])
    if none:
        kept, looked = kept.filter(docs["doc_id"].isNotNull()), looked.union(docs.filter(docs["doc_id"].isNull()))
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    copies = Window.partitionBy("doc_id", "__node__").orderBy("text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    once = _with_node(looked.filter(words)).withColumn("__copy__", F.row_number().over(copies)).filter("__copy__ = 1")
    names = first.select(F.col("node").alias("__first__"), F.col("doc_id").alias("__id__"))
    stay = once.join(names, (once["__node__"] == names["__first__"]) & once["doc_id"].eqNullSafe(names["__id__"]), "left_semi")
    return kept.union(looked.filter(~words)).union(stay.select(*[f"`{c}`" for c in docs.columns]))
