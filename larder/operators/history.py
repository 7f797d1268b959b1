"""Household-item table and time-decayed household-by-attribute history."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..session import materialize


def build_hh_item(txns: DataFrame, basket: str = "txn") -> DataFrame:
    """Transactions under their output names. basket is the transaction ('txn') or household and day ('household_day')."""
    if basket not in ("txn", "household_day"):
        raise ValueError(f"unknown basket: {basket}")
    ts = F.col("txn_date").cast("timestamp_ntz")
    composite = F.concat_ws("_", F.col("household_id").cast("string"), F.to_date("txn_date").cast("string"))
    basket_id = F.col("txn_id") if basket == "txn" else composite
    return txns.select(
        "household_id",
        F.col("upc_nbr").alias("upc_id"),
        basket_id.alias("basket_id"),
        ts.alias("ts"),
        F.col("item_qount").alias("quantity"),
    )


def _clock(ts: Column) -> Column:
    """Seconds since midnight."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def days_between(ref: Column, ts: Column) -> Column:
    """Whole days from ts to ref: the floor of the exact difference."""
    return F.datediff(ref, ts) - (_clock(ref) < _clock(ts)).cast("int")


def build_hh_attr_history(
    txns: DataFrame,
    item_attrs: DataFrame,
    decay_days: float = 90.0,
    ref_date: str | None = None,
    min_score: float = 0.01,
) -> DataFrame:
    """(household_id, attr_id, hist_score, last_seen_days).

    A purchase weighs quantity * p_attr * exp(-days_ago / decay_days): decay_days is
    the time to fall to 1/e. Days are whole ones: of two timestamps, the floor of their difference. The reference day is the last purchase of any mapped item
    unless given. Purchases of one item by one household are summed before they fan
    out to the item's attributes, so the join and the last shuffle carry pairs
    (household, item), not transactions, and no rows by attribute.
    """
    mapped = item_attrs.where("upc_nbr IS NOT NULL AND attr_id IS NOT NULL").select("upc_nbr", "attr_id", "p_attr")
    timed = isinstance(txns.schema["txn_date"].dataType, (TimestampType, TimestampNTZType))
    kind = "timestamp_ntz" if timed else "date"
    bought = txns.where(F.col("upc_nbr").isNotNull()).select(
        "household_id", "upc_nbr", F.col("txn_date").cast(kind).alias("day"), F.col("item_qount").alias("quantity")
    )
    if ref_date is None:
        last_by_item = bought.groupBy("upc_nbr").agg(F.max("day").alias("day"))
        # Merged, as Spark takes one column of a well-packed map for small and would broadcast a row a map row.
        ref = last_by_item.join(mapped.select("upc_nbr").hint("merge"), "upc_nbr", "left_semi").agg(F.max("day")).scalar()
    else:
        ref = F.lit(ref_date).cast(kind)

    quantity = F.when(~F.isnan("quantity"), F.col("quantity"))
    days_ago = days_between(ref, F.col("day")) if timed else F.datediff(ref, F.col("day"))
    by_item = (
        bought.where(F.col("household_id").isNotNull())
        .select("household_id", "upc_nbr", days_ago.alias("days_ago"), quantity.cast("double").alias("quantity"))
        .groupBy("household_id", "upc_nbr")
        .agg(
            F.sum(F.col("quantity") * F.exp(-F.col("days_ago") / F.lit(float(decay_days)))).alias("weight"),
            F.min("days_ago").alias("days_ago"),
        )
    )
    # A pair travels to its household once, with the codes of its item's attributes, and fans out there: the last grouping needs
    # no shuffle of its own. Codes are numbers of a written table, so that they mean the same to both joins.
    codes = materialize(mapped.select("attr_id").distinct().withColumn("code", F.monotonically_increasing_id()))
    # Two plain arrays take a third of the bytes that an array of structs does.
    held = mapped.join(codes, "attr_id").groupBy("upc_nbr").agg(F.collect_list(F.struct("code", "p_attr")).alias("held"))
    held = held.select("upc_nbr", F.col("held.code").alias("code"), F.col("held.p_attr").alias("p_attr"))
    pairs = by_item.join(held, "upc_nbr").select("household_id", "weight", "days_ago", "code", "p_attr").repartition("household_id")
    return (
        pairs.select("household_id", "weight", "days_ago", F.inline(F.arrays_zip("code", "p_attr")))
        .groupBy("household_id", "code")
        .agg(
            F.sum(F.col("weight") * F.col("p_attr")).alias("hist_score"),
            F.min("days_ago").cast("bigint").alias("last_seen_days"),
        )
        .where(F.col("hist_score") > min_score)
        .join(codes, "code")
        .select("household_id", "attr_id", "hist_score", "last_seen_days")
    )


def top_attributes(history: DataFrame, k: int) -> DataFrame:
    """The k strongest attributes of each household, rank from 1, ties by attribute id."""
    w = Window.partitionBy("household_id").orderBy(F.desc("hist_score"), "attr_id")
    return history.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
