"""Scans and sinks of the pipeline's tables."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

# Column names of the input tables.
ITEM_COLUMNS = [
    "upc_nbr", "item_dsc", "smic_class_cd", "smic_category_cd", "department_nm",
    "shelf_nm", "health_clain_type_dsc", "nutrition_nm", "iri_brands_nm",
]
TXN_COLUMNS = ["household_id", "upc_nbr", "txn_id", "txn_date", "item_qount"]
HOUSEHOLD_COLUMNS = ["household_id", "age_group", "segment", "income_group"]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The table, or None when the path does not exist; any other failure is raised."""
    try:
        return read_table(spark, path, fmt, **options)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_items(source: DataFrame) -> DataFrame:
    return source.select(*ITEM_COLUMNS)


def scan_transactions(source: DataFrame, as_of: Column | str | None = None, months: int = 24) -> DataFrame:
    """Transactions of the last two years before as_of (today unless given)."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return source.select(*TXN_COLUMNS).where(F.col("txn_date") >= F.add_months(day, -months))


def scan_households(source: DataFrame) -> DataFrame:
    return source.select(*HOUSEHOLD_COLUMNS)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> int:
    """Write Parquet and return the row count, taken in the same pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(seen.get["rows"])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out
