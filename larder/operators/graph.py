"""Attribute graph, node features, and the random views used in contrastive learning."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform
from .cooccurrence import household_cooccurrence, mirror
from .pairs import pair_sums
from .ranking import with_global_rank
from .vector_sums import weighted_sums

# Weight of a household edge against an item edge, and the guard in the z-score.
HOUSEHOLD_FACTOR = 0.5
STD_GUARD = 1e-6


def attribute_vocabulary(item_attrs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Distinct attribute ids of the items, and of the households when given."""
    ids = item_attrs.select("attr_id")
    if history is not None:
        ids = ids.unionByName(history.select("attr_id"))
    return ids.where(F.col("attr_id").isNotNull()).distinct()


def indexed_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """(attr_id, idx) with idx from 0 in attribute-id order."""
    return with_global_rank(vocabulary, F.col("attr_id"), "idx")


def undirected_edges(
    item_attrs: DataFrame,
    history: DataFrame | None = None,
    use_household_edges: bool = True,
    min_cooccur: float = 3,
) -> DataFrame:
    """Item weight (sum of p_a * p_b) plus half the household weight, edges below min_cooccur left out."""
    edges = pair_sums(item_attrs, "upc_nbr", "attr_id", F.col("p_attr"))
    if history is not None and use_household_edges:
        extra = household_cooccurrence(history).withColumn("w", F.col("w") * HOUSEHOLD_FACTOR)
        edges = edges.unionByName(extra).groupBy("src", "dst").agg(F.sum("w").alias("w"))
    return edges.where(F.col("w") >= min_cooccur)


def build_attribute_graph(
    item_attrs: DataFrame,
    history: DataFrame | None = None,
    use_household_edges: bool = True,
    min_cooccur: float = 3,
) -> DataFrame:
    """Directed edges (src, dst, w): both directions, and a self-loop of weight 1 on each attribute."""
    used = history if use_household_edges else None
    loops = attribute_vocabulary(item_attrs, used).select(
        F.col("attr_id").alias("src"), F.col("attr_id").alias("dst"), F.lit(1.0).alias("w")
    )
    return mirror(undirected_edges(item_attrs, history, use_household_edges, min_cooccur)).unionByName(loops)


def graph_stats(edges: DataFrame) -> DataFrame:
    """One row: nodes, directed entries with self-loops, undirected edges, density in percent."""
    loop = F.col("src") == F.col("dst")
    return edges.agg(
        F.count_if(loop).alias("nodes"),
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("src") < F.col("dst")).alias("undirected_edges"),
    ).withColumn("density_pct", F.try_divide(100.0 * F.col("entries"), F.col("nodes") * F.col("nodes")))


def family_features(vocabulary: DataFrame, attr_meta: DataFrame) -> DataFrame:
    """(attr_id, family array<double>): one-hot over the sorted families; all zero for an unknown attribute."""
    families = attr_meta.agg(F.array_sort(F.collect_set("attr_family")).alias("f")).select("f").scalar()
    by_id = attr_meta.select("attr_id", "attr_family").dropDuplicates(["attr_id"])
    return (
        vocabulary.join(by_id, "attr_id", "left")
        .withColumn("_families", families)
        .select("attr_id", F.expr("transform(_families, f -> if(f <=> attr_family, 1.0D, 0.0D))").alias("family"))
    )


def popularity_features(vocabulary: DataFrame, item_attrs: DataFrame) -> DataFrame:
    """(attr_id, popularity array<double>): log1p of rows and of distinct items."""
    # Rows are counted per (attribute, item) first, so a popular attribute is spread over its items.
    per_item = item_attrs.groupBy("attr_id", "upc_nbr").agg(F.count(F.lit(1)).alias("n"))
    counts = per_item.groupBy("attr_id").agg(F.sum("n").alias("n_rows"), F.count("upc_nbr").alias("n_items"))
    zero = F.lit(0)
    return vocabulary.join(counts, "attr_id", "left").select(
        "attr_id",
        F.array(
            F.log1p(F.coalesce("n_rows", zero).cast("double")), F.log1p(F.coalesce("n_items", zero).cast("double"))
        ).alias("popularity"),
    )


def nutrition_features(vocabulary: DataFrame, item_attrs: DataFrame, item_nutrition: DataFrame) -> DataFrame:
    """(attr_id, nutrition array<double>): mean of each nutrition column over an attribute's items, z-scored over all attributes.

    A missing mean counts as 0 before the z-score.
    """
    cols = [c for c in item_nutrition.columns if c not in ("upc_id", "upc_nbr")]
    means = (
        item_attrs.select("upc_nbr", "attr_id")
        .join(item_nutrition, F.col("upc_nbr") == F.col("upc_id"))
        .groupBy("attr_id")
        .agg(*[F.avg(F.expr(f"nullif(`{c}`, double('NaN'))")).alias(c) for c in cols])
    )
    filled = vocabulary.join(means, "attr_id", "left").select(
        "attr_id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols]
    )
    spread = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]
    stats = filled.agg(F.struct(*spread).alias("stats")).select("stats").scalar()
    scored = [(F.col(c) - F.col("_s")[c]["m"]) / (F.col("_s")[c]["s"] + STD_GUARD) for c in cols]
    return filled.withColumn("_s", stats).select("attr_id", F.array(*scored).alias("nutrition"))


def build_node_features(
    vocabulary: DataFrame, attr_meta: DataFrame, item_attrs: DataFrame, item_nutrition: DataFrame | None = None
) -> DataFrame:
    """(attr_id, features array<double>): family one-hot, popularity, and nutrition when given."""
    out = family_features(vocabulary, attr_meta).join(popularity_features(vocabulary, item_attrs), "attr_id")
    blocks = ["family", "popularity"]
    if item_nutrition is not None:
        out = out.join(nutrition_features(vocabulary, item_attrs, item_nutrition), "attr_id")
        blocks.append("nutrition")
    return out.select("attr_id", F.concat(*blocks).alias("features"))


def drop_edges(edges: DataFrame, p: float, seed: int, view: int) -> DataFrame:
    """Keep each directed entry, self-loops included, with probability 1 - p."""
    u = hash_uniform(F.lit(seed), F.lit(view), F.col("src"), F.col("dst"))
    return edges.where(u > p)


def mask_features(nodes: DataFrame, p: float, seed: int, view: int) -> DataFrame:
    """Set each feature to 0 with probability p."""
    def one(x, k):
        return F.when(hash_uniform(F.lit(seed), F.lit(view), F.col("attr_id"), k) > p, x).otherwise(0.0)

    return nodes.select("attr_id", F.transform("features", one).alias("features"))


def denoise_mask(cells: DataFrame, p: float, seed: int, epoch: int) -> DataFrame:
    """Keep each cell with probability 1 - p; drawn anew for each epoch."""
    u = hash_uniform(F.lit(seed), F.lit(epoch), F.col("src"), F.col("dst"))
    return cells.where(u > p)


def neighbor_mean(edges: DataFrame, nodes: DataFrame, dim: int, vector: str = "features") -> DataFrame:
    """(attr_id, neighbors): weighted sum of incoming neighbours' vectors over max(sum of weights, 1).

    Sums are partial before the shuffle, so a hub costs one row per task. A node with no incoming entry gets zeros.
    """
    messages = edges.join(nodes.select(F.col("attr_id").alias("src"), F.col(vector).alias("v")), "src")
    sums = weighted_sums(messages.withColumnRenamed("dst", "attr_id"), "attr_id", F.col("w"), F.col("v"))
    degree = F.greatest(F.col("weight"), F.lit(1.0))
    means = sums.select("attr_id", F.transform("sums", lambda s: s / degree).alias("m"))
    return nodes.select("attr_id").join(means, "attr_id", "left").select(
        "attr_id", F.coalesce("m", F.array_repeat(F.lit(0.0), dim)).alias("neighbors")
    )
