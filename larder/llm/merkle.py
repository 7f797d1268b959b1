"""A Merkle manifest of a table: leaves, roots and proofs by pivoting the slots of a parent into columns.

A row's leaf is the hash of its fields, each written as byte count, colon and value, or "-" for null.  Every source is a tree:
its leaves ascend by doc_id, and every `FANOUT` consecutive nodes hash to a parent while there is more than one.  The sources'
roots, in the order of the sources, are the leaves of one more tree, whose root stands for the table.

*Slot pivot.*  A node's place modulo the fanout is its slot.  Conditional aggregates over a parent's nodes put the digest of each
slot in a column of its own; the columns in a row, hashed, are the parent, and without the node's own column they are its siblings.

*Spread.*  Places come from ranges of (source, doc_id), so the largest source is cut into as many as it needs.  A
block of `FANOUT ** LEVELS` consecutive nodes is one group of a single shuffle: all its levels are aggregates over windows that
share its partitioning and order.  Block tops are the nodes of the next such round, a 2,187th of the rows, and a block's path
above is joined to its nodes by block.  No task sees more than a block of one tree, and the driver sees the largest tree's size.

*Proof.*  A leaf's path is a pair (left, right) of siblings' digests for each level, up to the table's root; joined and hashed
it is the proof, and folding a leaf along it gives the root again if nothing was changed.

Defined cases: rows of equal source and doc_id are in order of their leaf; null doc_ids come first and are never tampered with;
null and empty texts differ by their leaf; a source of one row has its leaf as root, and a table of one source has
that source's root; an empty table gives no row; very long texts are hashed as they are; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.ordering import in_ranges, totals_before
from larder.session import materialize

FANOUT = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>) AS path"


def digest(text: Column) -> Column:
    """Lowercase hex of sha256."""
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """Byte count, colon, value; "-" for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The hash of a row's fields, some of them replaced."""
    return digest(F.concat(*[field(changed.get(name, F.col(name))) for name in FIELDS]))


def climb(nodes: DataFrame, largest: int, over: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add `path`, a node's siblings level by level, and `top`, the root of its tree, to nodes (tree, idx, size, digest, ...).

    Nodes of a tree are numbered 0 to size - 1 by idx; no tree has more than `largest`.  `over` takes (tree, digest) of all
    trees' roots to (tree, path, root) in one more tree over them, by which each path is then continued.  That join
    meets the nodes of the last round, which are few in any tree.
    """
    block, span, kept = f"_p{LEVELS}", FANOUT ** LEVELS, nodes.columns
    places = [F.expr(f"idx div {FANOUT ** level}").alias(f"_p{level}") for level in range(LEVELS + 1)]
    now = nodes.select("*", *places, F.col("digest").alias("_h"), F.expr(NO_PATH)).repartition("tree", block)
    for level in range(1, LEVELS + 1):
        parent = Window.partitionBy("tree", *[f"_p{k}" for k in range(LEVELS, level - 1, -1)])
        slot = F.pmod(F.col(f"_p{level - 1}"), F.lit(FANOUT))
        child = [F.col(f"_c{s}") for s in range(FANOUT)]
        now = now.select("*", *[F.max(F.when(slot == s, F.col("_h"))).over(parent).alias(f"_c{s}") for s in range(FANOUT)])
        left = F.concat_ws("", *[F.when(slot > s, child[s]) for s in range(FANOUT)])
        right = F.concat_ws("", *[F.when(slot < s, child[s]) for s in range(FANOUT)])
        more = F.col("size") > FANOUT ** (level - 1)  # more than one node on this level
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        now = now.select(
            *kept, *[f"_p{k}" for k in range(LEVELS + 1)],
            F.when(more, digest(F.concat_ws("", *child))).otherwise(F.col("_h")).alias("_h"),
            F.when(more, F.concat("path", step)).otherwise(F.col("path")).alias("path"))
    if largest > span:
        tops = materialize(now.filter(F.col("idx") % span == 0).select(
            "tree", F.col(block).alias("idx"), F.ceil(F.col("size") / span).alias("size"), F.col("_h").alias("digest")))
        above = climb(tops, -(-largest // span), over).drop("size", "digest").withColumnsRenamed({"idx": block, "path": "_up"})
        return now.join(above, ["tree", block]).select(
            *kept, F.concat("path", "_up").alias("path"), *[c for c in above.columns if c not in ("tree", block, "_up")])
    now = now.withColumnRenamed("_h", "top")
    if over is None:
        return now.select(*kept, "path", "top")
    roots = over(now.filter("idx = 0").select("tree", F.col("top").alias("digest"))).withColumnRenamed("path", "_up")
    return now.join(roots, "tree").select(*kept, F.concat("path", "_up").alias("path"), "top", "root")


def number(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add idx, the place of a row among those of its tree in the given order, and size, their count."""
    ranged = in_ranges(rows, [F.col("tree"), *order])
    parts = ranged.groupBy("tree", "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = totals_before(parts, "_n", "_before", ("tree",))
    sizes = parts.groupBy("tree").agg(F.sum("_n").alias("size"))
    places = before.join(sizes, "tree").select("tree", "_range", (F.col("_before") - F.col("_first")).alias("_shift"), "size")
    return ranged.join(places, ["tree", "_range"]).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def fold(path: Column, node: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda h, step: digest(F.concat(step["left"], h, step["right"])))


def joined(path: Column) -> Column:
    """All siblings' digests in a row."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"])))


def manifest(docs: DataFrame, tampered: Column, tampered_text: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    A row for which `tampered` holds is checked with `tampered_text` (both over the columns of documents) in place of its text.
    """
    rows = docs.select(*FIELDS, F.coalesce(tampered, F.lit(False)).alias("_tampered"))
    rows = materialize(rows.select(
        "doc_id", "source", leaf().alias("digest"), F.when(F.col("_tampered"), leaf(text=tampered_text)).alias("found")))
    # "=" + source, or "-" for null, is never null and sorts like the sources, null first.
    rows = rows.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")).alias("tree"), "doc_id", "digest", "found")
    leaves = number(rows, [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.monotonically_increasing_id()])
    trees, largest = leaves.filter("idx = 0").agg(F.count("*"), F.max("size")).first()

    def over(roots: DataFrame) -> DataFrame:
        named = roots.select(F.lit("sources").alias("tree"), F.col("tree").alias("name"), "digest")
        return climb(number(named, [F.col("name")]), trees).select(F.col("name").alias("tree"), "path", F.col("top").alias("root"))

    return climb(leaves, largest or 0, over).select(
        "doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root", digest(joined(F.col("path"))).alias("proof_sha256"),
        fold(F.col("path"), F.coalesce("found", "digest")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
