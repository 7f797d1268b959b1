"""Global order without a single-task sort: rows in ranges of consecutive keys, and running totals over them.

Spark's range exchange samples the keys and finds a row's range by binary search, so neither the driver nor a task sees more
than a sample, whatever the number of ranges. The ranges are written to the shared folder, and everything that follows
(counts, totals, offsets) reads that table: a second sampling could cut elsewhere.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import materialize

RANGES_PER_STRIDE = 1024
_ROW = (1 << 33) - 1  # the bits of monotonically_increasing_id that number a partition's rows


def in_ranges(df: DataFrame, keys: list[Column], ranges: int | None = None) -> DataFrame:
    """A written table of the rows with `_range` (ascends with the keys) and `_at` (0, 1, ... in a range, by the keys).

    `ranges` is the number of ranges; without it the session's number of shuffle partitions, which Spark may lower.
    Rows of equal keys may be in either order, and one range holds them all unless the keys tell them apart.
    """
    cut = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    placed = cut.sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)).alias("_at"))
    return materialize(placed)


def totals_before(sums: DataFrame, value: str, name: str, group: tuple[str, ...] = ()) -> DataFrame:
    """Add the sum of `value` over the rows of the same group with a smaller `_range`; a row a group and range.

    Ranges are added up in strides first, so that no task sorts more than a stride of them or one row a stride.
    """
    strided = sums.withColumn("_stride", F.floor(F.col("_range") / RANGES_PER_STRIDE))
    earlier = lambda part, order: Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = strided.groupBy(*group, "_stride").agg(F.sum(value).alias("_whole")).select(
        *group, "_stride", F.coalesce(F.sum("_whole").over(earlier(group, "_stride")), F.lit(0)).alias("_ahead"))
    within = F.coalesce(F.sum(value).over(earlier((*group, "_stride"), "_range")), F.lit(0))
    return strided.withColumn("_within", within).join(whole, [*group, "_stride"]).withColumn(
        name, F.col("_ahead") + F.col("_within")).drop("_stride", "_ahead", "_within")


def running_total(df: DataFrame, keys: list[Column], value: Column, name: str, ranges: int | None = None) -> DataFrame:
    """Add the sum of `value` (long) over all rows that come before a row in the order of the keys, which are unique."""
    cut = df.withColumn("_value", value.cast("long"))
    cut = (cut.repartitionByRange(ranges, *keys) if ranges else cut.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    placed = cut.select("*", F.spark_partition_id().alias("_range"))
    schema = StructType([*placed.schema.fields, StructField("_inside", LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            values = np.asarray(batch.column("_value").fill_null(0))
            after = total + np.cumsum(values)
            if len(after):
                total = int(after[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(after - values, pa.int64())], names=[*batch.schema.names, "_inside"])

    ranged = materialize(placed.mapInArrow(add, schema))
    offsets = totals_before(ranged.groupBy("_range").agg(F.sum("_value").alias("_n")), "_n", "_offset").select("_range", "_offset")
    return ranged.join(offsets, "_range").withColumn(name, F.col("_offset") + F.col("_inside")).drop("_value", "_range", "_inside", "_offset")
