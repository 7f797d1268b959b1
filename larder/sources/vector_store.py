"""Versioned store of attribute vectors, and frozen item vectors."""

import functools
import time
import uuid
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STORE_SCHEMA = (
    "attr_id string, vocab_version string, built_from string, dim int, vector array<double>, "
    "created_at timestamp, provider string, model_version string"
)

COMMIT_SCHEMA = "folder string, provider string, model_version string, made bigint"


def store_rows(
    vectors: DataFrame,
    provider: str,
    model_version: str,
    vocab_version: str = "v1",
    built_from: str = "",
    created_at: Column | None = None,
) -> DataFrame:
    """Vectors (attr_id, vector) with their provenance columns."""
    return vectors.select(
        "attr_id",
        F.lit(vocab_version).alias("vocab_version"),
        F.lit(built_from).alias("built_from"),
        F.size("vector").alias("dim"),
        F.col("vector").cast("array<double>").alias("vector"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
        F.lit(provider).alias("provider"),
        F.lit(model_version).alias("model_version"),
    )


def write_vectors(rows: DataFrame, path: str) -> None:
    """Write store rows as one commit; only the providers and versions among them are replaced.

    Rows go to a folder of their own below `path`/data. They become visible by the last step alone, a small table below
    `path`/commits that names the folder, its versions and when it was made, so a write that stops half-way is never read, and
    readers of the version before keep their files.
    """
    spark = rows.sparkSession
    folder = uuid.uuid4().hex
    rows.write.partitionBy("provider", "model_version").parquet(f"{path}/data/{folder}")
    written = spark.read.schema(STORE_SCHEMA).parquet(f"{path}/data/{folder}")
    versions = written.select("provider", "model_version").distinct()
    later = F.lit(time.time_ns())  # a later commit of a version replaces it
    versions.select(F.lit(folder).alias("folder"), "provider", "model_version", later.alias("made")).coalesce(1).write.parquet(
        f"{path}/commits/{folder}")


def committed(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(folder, provider, model_version) of the store's versions, the last commit of each; a row a version, not a vector."""
    commits = spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{path}/commits")
    newest = commits.groupBy("provider", "model_version").agg(F.max_by("folder", F.struct("made", "folder")).alias("folder"))
    return sorted((r["folder"], r["provider"], r["model_version"]) for r in newest.collect())


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed versions, as of now."""
    rows = spark.createDataFrame([], STORE_SCHEMA)
    folders: dict[str, list[tuple[str, str]]] = {}
    for folder, *version in committed(spark, path):
        folders.setdefault(folder, []).append(tuple(version))
    for folder, versions in folders.items():
        data = spark.read.schema(STORE_SCHEMA).parquet(f"{path}/data/{folder}")
        chosen = functools.reduce(or_, [(F.col("provider") == p) & (F.col("model_version") == v) for p, v in versions])
        rows = rows.unionByName(data.where(chosen))
    return rows


def load_vectors(spark: SparkSession, path: str, provider: str, model_version: str) -> DataFrame:
    """The vectors of one provider and version, read from their partition alone; raises when there are none."""
    for folder, *version in committed(spark, path):
        if version == [provider, model_version]:
            return spark.read.schema(STORE_SCHEMA).parquet(f"{path}/data/{folder}").where(
                (F.col("provider") == provider) & (F.col("model_version") == model_version))
    raise ValueError(f"no vectors of provider {provider}, version {model_version} in {path}")


def latest_vectors(store: DataFrame) -> DataFrame:
    """Each provider's rows of its latest version, by the version text."""
    newest = store.groupBy("provider").agg(F.max("model_version").alias("model_version"))
    return store.join(newest, ["provider", "model_version"])


def frozen_item_vectors(vectors: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """(item_id, vector) from (idx, vector); ids come from (item_id, idx) when given, else 'item_{idx}'."""
    missing = {"idx", "vector"} - set(vectors.columns)
    if missing:
        raise ValueError(f"item vectors lack columns: {sorted(missing)}")
    if id_map is None:
        return vectors.select(F.concat(F.lit("item_"), F.col("idx").cast("string")).alias("item_id"), "vector")
    return id_map.select("item_id", "idx").join(vectors.select("idx", "vector"), "idx").select("item_id", "vector")
