"""Wide nutrition table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nutrient_value, with_nutrition_pairs

# Nutrient name -> column name, and the suffixes of the columns to keep.
NUTRITION_COLUMNS = {
    "added sugar": "added_sugar_g",
    "calcium": "calcium_mg",
    "calories": "calories",
    "cholesterol": "cholesterol_mg",
    "protein": "protein_g",
    "sodium": "sodium_mg",
    "total fat": "total_fat_g",
    "fiber": "fiber_g",
}
KEPT_SUFFIXES = ("_g", "_mg", "calories")


def nutrient_names(items: DataFrame) -> DataFrame:
    """(name): the names that occur in the data."""
    return with_nutrition_pairs(items).select(F.explode("_pairs.name").alias("name")).distinct()


def build_item_nutrition(items: DataFrame, names: list[str] = list(NUTRITION_COLUMNS)) -> DataFrame:
    """One row per item: upc_id and one column per kept nutrient among `names`.

    Names become columns, so the caller says which; the known ones are the default. Wide rows are made
    in place from the parsed list, without a grouping.
    """
    columns = {n: NUTRITION_COLUMNS.get(n, n) for n in names}
    kept = {n: c for n, c in columns.items() if c.endswith(KEPT_SUFFIXES)}
    values = [F.expr(nutrient_value(n)).alias(c) for n, c in kept.items()]
    return with_nutrition_pairs(items).select(F.col("upc_nbr").alias("upc_id"), *values)


def nutrition_long(items: DataFrame) -> DataFrame:
    """(upc_id, nutrient, value): the parsed list as rows."""
    # Outer, as Spark would else test the list's size below the shuffle, and so read each text twice; a pair has a name.
    rows = with_nutrition_pairs(items).select(
        F.col("upc_nbr").alias("upc_id"), F.expr("inline_outer(_pairs) AS (nutrient, value)")
    )
    return rows.where(F.col("nutrient").isNotNull())


def pivot_nutrition(items: DataFrame, names: list[str] = list(NUTRITION_COLUMNS)) -> DataFrame:
    """The wide table by a pivot of the long one: items with no nutrition have null columns."""
    wide = nutrition_long(items).groupBy("upc_id").pivot("nutrient", list(names)).agg(F.first("value"))
    renamed = wide.withColumnsRenamed(NUTRITION_COLUMNS)
    kept = [c for c in renamed.columns if c != "upc_id" and c.endswith(KEPT_SUFFIXES)]
    return items.select(F.col("upc_nbr").alias("upc_id")).join(renamed.select("upc_id", *kept), "upc_id", "left")
