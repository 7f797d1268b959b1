"""Attribute vocabulary and item-to-attribute map."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import code, slug, strip_space, with_nutrition_pairs

# Upper limits of the low, medium and high bin of each nutrient; all start at 0.
NUTRIENT_LIMITS = {
    "added sugar": (5, 15, 999),
    "calories": (100, 200, 999),
    "protein": (5, 15, 999),
    "sodium": (200, 500, 9999),
    "total fat": (5, 15, 999),
    "cholesterol": (10, 50, 999),
    "fiber": (3, 10, 999),
}
LEVELS = ("low", "medium", "high")

# Fixed values: (source column, family, attribute-id prefix, id form).
SINGLE_VALUED = [
    ("iri_brands_nm", "brand", "brand_", slug),
    ("smic_category_cd", "category", "category_", code),
    ("smic_class_cd", "class", "class_", code),
    ("department_nm", "department", "dept_", slug),
    ("shelf_nm", "shelf", "shelf_", slug),
]
CLAIMS = ("health_clain_type_dsc", "health_claim", "health_")


def _attribute(attr_id: str, family: str, name: str, source: str) -> str:
    return (
        f"named_struct('attr_id', {attr_id}, 'attr_family', '{family}', "
        f"'display_name', {name}, 'evidence_sources', '{source}')"
    )


def _claims() -> str:
    column, family, prefix = CLAIMS
    parts = f"ifnull(split({column}, '/'), cast(array() AS array<string>))"
    stripped = f"transform({parts}, c -> {strip_space('c')})"
    return f"transform({stripped}, c -> {_attribute(slug(prefix, 'c'), family, 'c', column)})"


def _catalog() -> str:
    singles = [_attribute(form(p, c), family, f"cast({c} AS string)", c) for c, family, p, form in SINGLE_VALUED]
    return f"concat(array({', '.join(singles)}), {_claims()})"


def _nutrition_levels() -> str:
    """Each parsed pair as the attribute of the bin its value falls in, null without a bin."""
    cases = []
    for nutrient, limits in NUTRIENT_LIMITS.items():
        stem = f"nutrition_{nutrient.replace(' ', '_')}_"
        steps = " ".join(f"WHEN e.value < {hi} THEN '{stem}{level}'" for hi, level in zip(limits, LEVELS))
        cases.append(f"WHEN '{nutrient}' THEN CASE WHEN e.value < 0 THEN NULL {steps} END")
    attr_id = f"CASE e.name {' '.join(cases)} END"
    return f"transform(_pairs, e -> {_attribute(attr_id, 'nutrition', 'e.name', 'nutrition_nm')})"


def _exploded(items: DataFrame, blocks: str, *keep: str) -> DataFrame:
    """One row per item attribute, in a single pass over the items."""
    # Outer, as Spark would else build the list a second time to test its size, below any shuffle.
    return items.select(*keep, F.expr(f"inline_outer({blocks})")).where(F.col("attr_id").isNotNull())


def nutrition_vocabulary(spark) -> DataFrame:
    """The 21 nutrition attributes; they do not depend on the data."""
    rows = [
        (f"nutrition_{n.replace(' ', '_')}_{level}", "nutrition", f"{n} - {level}")
        for n in NUTRIENT_LIMITS
        for level in LEVELS
    ]
    frame = spark.createDataFrame(rows, "attr_id string, attr_family string, display_name string")
    return frame.withColumn("display_name", F.initcap("display_name"))


def build_attr_meta(items: DataFrame) -> DataFrame:
    """Attribute vocabulary (attr_id, attr_family, display_name, definition_json).

    Values are made distinct as spelled, so two spellings with one slug keep two rows.
    """
    found = _exploded(items, _catalog()).select("attr_id", "attr_family", "display_name").distinct()
    return found.unionByName(nutrition_vocabulary(items.sparkSession)).withColumn(
        "definition_json", F.lit(None).cast("string")
    )


def health_vocabulary(items: DataFrame) -> DataFrame:
    return _exploded(items, _claims()).select(
        "attr_id", "attr_family", "display_name"
    ).distinct()


def _as_map(rows: DataFrame) -> DataFrame:
    return (
        rows.select("upc_nbr", "attr_id", F.lit(1.0).alias("p_attr"), "evidence_sources")
        .dropDuplicates(["upc_nbr", "attr_id"])
    )


def build_map_item_attribute(items: DataFrame) -> DataFrame:
    """Item-to-attribute map (upc_nbr, attr_id, p_attr, evidence_sources), unique per item and attribute.

    All families come from one exploded scan; the only shuffle is the de-duplication.
    """
    blocks = f"concat({_catalog()}, {_nutrition_levels()})"
    return _as_map(_exploded(with_nutrition_pairs(items), blocks, "upc_nbr"))


def build_health_mapping(items: DataFrame) -> DataFrame:
    return _as_map(_exploded(items, _claims(), "upc_nbr"))


def build_nutrition_mapping(items: DataFrame) -> DataFrame:
    """Items binned by nutrient value; no bin or no value gives no row."""
    return _exploded(with_nutrition_pairs(items), _nutrition_levels(), "upc_nbr").select(
        "upc_nbr", "attr_id", F.lit(1.0).alias("p_attr"), "evidence_sources"
    )
