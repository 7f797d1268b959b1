"""Exact global ranks, splits and top-k without a single-task sort of the data."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import running_total


def with_running_total(df: DataFrame, key: Column, value: Column, name: str, ranges: int | None = None) -> DataFrame:
    """Add the sum of `value` over all rows with a smaller key; keys are unique strings."""
    return running_total(df.withColumn("_key", key), [F.col("_key")], value, name, ranges).drop("_key")


def with_global_rank(df: DataFrame, key: Column, name: str, ranges: int | None = None) -> DataFrame:
    """Add the 0-based rank of a unique string key."""
    return with_running_total(df, key, F.lit(1), name, ranges)


def top_k(scored: DataFrame, group: str | list[str], score: str, tie: str, k: int, rank: str = "rank") -> DataFrame:
    """The k best rows of each group, rank from 1 without gaps."""
    w = Window.partitionBy(group).orderBy(F.desc(score), tie)
    return scored.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
