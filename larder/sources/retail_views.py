"""The star-schema test tables seen as item, transaction, household and vector tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    nutrition = F.concat(
        F.lit('[["Calories", '), (F.col("p_size") * 6).cast("string"),
        F.lit('], ["Added Sugar", '), (key % 30).cast("string"),
        F.lit('], ["Fiber", '), (key % 13).cast("string"), F.lit("]]"),
    )
    return _load(spark, sf_dir, "part").select(
        key.cast("string").alias("upc_nbr"),
        F.col("p_name").alias("item_dsc"),
        F.col("p_size").alias("smic_class_cd"),
        F.col("p_type").alias("smic_category_cd"),
        F.substring_index("p_name", " ", 1).alias("department_nm"),
        F.col("p_name").alias("shelf_nm"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("/")).alias("health_clain_type_dsc"),
        F.when(key % 11 != 0, nutrition).alias("nutrition_nm"),
        F.col("p_brand").alias("iri_brands_nm"),
    )


def items_with_nutrition_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose nutrition is printed as lists, tuples, with either quote, signs, open commas, brackets in names, None or junk."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    forms = [
        '[["Calories", #], ["Fiber", 2]]', '(("calories", #), ("fiber", 2))', "[['Calories', #], ['it\\'s \"x\"', .5]]", '[["calories", +#], ["sodium", -1e2],]',
        '[["Vitamin A (RAE), total", #], ["a, None, b", None]]', '[["calories", "#d"], (" Fiber ", "#")]', '[["calories", #d]]', '[["x"]]', '[["a", 1], ["A ", #]]',
    ]
    text = F.element_at(F.array(*[F.lit(f) for f in forms]), (key % len(forms) + 1).cast("int"))
    return _load(spark, sf_dir, "part").select(key.cast("string").alias("upc_nbr"), F.replace(text, F.lit("#"), size).alias("nutrition_nm"))


def timed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with an hour of the day from the order's number."""
    hour = F.make_dt_interval(F.lit(0), (F.col("txn_id").cast("bigint") % 24).cast("int"))
    return transactions(spark, sf_dir).withColumn("txn_date", F.col("txn_date").cast("timestamp_ntz") + hour)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = _load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("household_id"),
        F.col("l_partkey").cast("string").alias("upc_nbr"),
        F.col("l_orderkey").cast("string").alias("txn_id"),
        F.to_date("o_orderdate").alias("txn_date"),
        F.col("l_quantity").alias("item_qount"),
    )


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return _load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("household_id"),
        F.concat(F.lit("age_"), (F.col("c_nationkey") % 5).cast("string")).alias("age_group"),
        F.col("c_mktsegment").alias("segment"),
        F.when(balance < 0, "low").when(balance < 5000, "mid").otherwise("high").alias("income_group"),
    )


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(attr_id, attr_family, vector) from the embeddings table."""
    return _load(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("attr_"), F.col("vec_id").cast("string")).alias("attr_id"),
        F.col("label").cast("string").alias("attr_family"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def provider_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three providers: the vectors as they are, reversed, and with even positions doubled then normalised."""
    base = labelled_vectors(spark, sf_dir)
    doubled = F.transform("vector", lambda x, k: F.when(k % 2 == 0, x * 2.0).otherwise(x))
    forms = F.array(
        F.struct(F.lit("plain").alias("provider"), F.col("vector").alias("v")),
        F.struct(F.lit("reversed").alias("provider"), F.reverse("vector").alias("v")),
        F.struct(F.lit("weighted").alias("provider"), l2_normalize(doubled).alias("v")),
    )
    return base.select("attr_id", "attr_family", F.explode(forms).alias("f")).select(
        "attr_id", "attr_family", F.col("f.provider").alias("provider"), F.col("f.v").alias("vector")
    )


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, vector): frozen vectors of the items that have one."""
    # Merged, as Spark takes one well-packed column for small and would broadcast the keys of all items.
    parts = _load(spark, sf_dir, "part").select("p_partkey").hint("merge")
    vecs = _load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return parts.join(vecs, F.col("p_partkey") == F.col("vec_id")).select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
