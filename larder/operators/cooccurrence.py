"""Attribute co-occurrence and shifted positive pointwise mutual information."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pairs import pair_sums


def mirror(edges: DataFrame) -> DataFrame:
    """Both directions of each undirected edge (src, dst, w)."""
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select("w", F.explode(ends).alias("e")).select("e.src", "e.dst", "w")


def item_cooccurrence(item_attrs: DataFrame) -> DataFrame:
    """Number of items that hold both attributes, one row per undirected pair."""
    return pair_sums(item_attrs, "upc_nbr", "attr_id", F.lit(1.0))


def household_cooccurrence(history: DataFrame) -> DataFrame:
    """Sum over households of the geometric mean of two scores, one row per undirected pair."""
    return pair_sums(history, "household_id", "attr_id", F.sqrt("hist_score"))


def marginals(cells: DataFrame) -> DataFrame:
    """(attr_id, total): row sums of a mirrored cell list."""
    return cells.groupBy(F.col("src").alias("attr_id")).agg(F.sum("w").alias("total"))


def sppmi(cells: DataFrame, shift: float = 1.0) -> DataFrame:
    """Cells > 0 of max(ln(c_ij * T / (r_i * c_j)) - shift, 0) of a mirrored cell list.

    The shift is subtracted after the logarithm. Absent cells would become -shift,
    so it may not be negative.
    """
    if shift < 0:
        raise ValueError("shift must be >= 0")
    rows = marginals(cells)
    total = rows.agg(F.sum("total")).scalar()
    ratio = F.try_divide(F.col("w") * total, F.col("row_total") * F.col("col_total"))
    return (
        cells.join(rows.select(F.col("attr_id").alias("src"), F.col("total").alias("row_total")), "src")
        .join(rows.select(F.col("attr_id").alias("dst"), F.col("total").alias("col_total")), "dst")
        .select("src", "dst", (F.ln(ratio) - F.lit(float(shift))).alias("w"))
        .where(F.col("w") > 0)
    )


def matrix_stats(cells: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row: attributes, non-zero cells, sum of cells, density and sparsity in percent."""
    n = vocabulary.agg(F.count(F.lit(1))).scalar()
    counts = cells.agg(F.count(F.lit(1)).alias("cells"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("total"))
    density = F.coalesce(F.try_divide(F.lit(100.0) * F.col("cells"), n * n), F.lit(0.0))
    return counts.select(
        n.alias("attributes"), "cells", "total", density.alias("density_pct"), (100.0 - density).alias("sparsity_pct")
    )
