"""Repeatable randomness.

Every random choice is a function of a seed and row keys, so a lost executor
recomputes the same choice and any SQL engine with md5 can check it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def hash_hex(*parts) -> Column:
    """md5 text of the parts joined by '|'."""
    return _digest(*parts)


def hash_int(*parts) -> Column:
    """Non-negative bigint from the first 15 hex digits (60 bits)."""
    return F.conv(F.substring(_digest(*parts), 1, 15), 16, 10).cast("bigint")


def hash_uniform(*parts) -> Column:
    """Double in [0, 1) from the first 8 hex digits."""
    return F.conv(F.substring(_digest(*parts), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
