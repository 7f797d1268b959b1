"""How many ranges of consecutive ids hold documents of some size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 24 << 20


def bucket_count(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 12) -> int:
    """Buckets so that one holds about `bucket_bytes` of text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, -(-total // bucket_bytes))
