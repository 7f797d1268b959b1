"""Joins in which a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialize

MOST_HOT = 1000


def look_up(rows: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Inner join of `rows`, a written table, with `values`, which has each key once; null keys go.

    A key with more than a 1/MOST_HOT of the rows is met by broadcast: there are fewer than MOST_HOT such keys, whatever the
    table.  All others are shuffled, and none of them holds more than that share.
    """
    counts = rows.groupBy(key).count()
    total = rows.count()
    hot = materialize(counts.filter(F.col("count") * MOST_HOT > total).select(key).join(values, key))
    met = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(values, key)
    return met.unionByName(rest)
