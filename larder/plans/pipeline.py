"""The whole pipeline: ETL, embeddings, comparison, alignment, scoring."""

from pyspark.sql import DataFrame, SparkSession

from ..operators import attributes as A
from ..operators import history as H
from ..operators import nutrition as N
from ..operators.alignment import align_attributes, train_alignment, write_training
from ..operators.comparison import compare_embeddings
from ..operators.params import read_params, write_params
from ..operators.scoring import affinity_summary, affinity_topk, household_affinity_topk
from ..session import materialize
from ..sources import tables as T
from ..sources.vector_store import latest_vectors, load_vectors, read_store
from .providers import DEFAULT_SPECS, run_all_providers, version_of


def run_etl(
    items: DataFrame, txns: DataFrame, households: DataFrame, data_path: str, as_of: str | None = None
) -> DataFrame:
    """Write the six tables below data_path; returns (table_name, row_count), counted while writing.

    The map is written first and read back, so that it is built once.
    """
    spark = items.sparkSession
    items, txns = T.scan_items(items), T.scan_transactions(txns, as_of)
    counts = {
        "attr_meta": T.write_table(A.build_attr_meta(items), f"{data_path}/attr_meta"),
        "map_item_attribute": T.write_table(A.build_map_item_attribute(items), f"{data_path}/map_item_attribute"),
        "hh_item": T.write_table(H.build_hh_item(txns), f"{data_path}/hh_item"),
    }
    item_attrs = T.read_table(spark, f"{data_path}/map_item_attribute")
    history = H.build_hh_attr_history(txns, item_attrs)
    counts["hh_attr_history"] = T.write_table(history, f"{data_path}/hh_attr_history")
    counts["item_nutrition"] = T.write_table(N.build_item_nutrition(items), f"{data_path}/item_nutrition")
    counts["hh_meta"] = T.write_table(T.scan_households(households), f"{data_path}/hh_meta")
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


def run_comparison(
    spark: SparkSession, data_path: str, vectors_path: str, providers: list[str]
) -> dict[str, DataFrame] | None:
    """Compare the latest versions of the providers; coherence only where the vocabulary table exists."""
    latest = latest_vectors(read_store(spark, vectors_path))
    return compare_embeddings(latest, providers, T.read_optional(spark, f"{data_path}/attr_meta"))


def run_alignment(
    spark: SparkSession,
    data_path: str,
    models_path: str,
    frozen_items: DataFrame,
    provider: str = "cooc_ae_item",
    specs: list[dict] | None = None,
    config: dict | None = None,
) -> dict[str, float]:
    """Train the alignment of one provider's vectors; writes best and final weights, metrics and history."""
    version = version_of(provider, specs)
    vectors = load_vectors(spark, f"{models_path}/attr_embeddings", provider, version)
    item_attrs = T.read_table(spark, f"{data_path}/map_item_attribute")
    result = train_alignment(item_attrs, frozen_items, vectors, config)
    out = f"{models_path}/alignment_{provider}"
    write_params(spark, result["best"], f"{out}/best_model")
    write_params(spark, result["final"], f"{out}/final_model")
    write_training(result, f"{out}/training_history", f"{out}/metrics")
    return result["metrics"]


def _aligned(spark: SparkSession, models_path: str, provider: str, specs: list[dict] | None) -> DataFrame:
    vectors = load_vectors(spark, f"{models_path}/attr_embeddings", provider, version_of(provider, specs))
    return align_attributes(vectors, read_params(spark, f"{models_path}/alignment_{provider}/best_model"))


def score_items(
    spark: SparkSession, models_path: str, frozen_items: DataFrame, output_path: str,
    provider: str = "cooc_ae_item", specs: list[dict] | None = None, top_k: int = 50,
) -> DataFrame:
    """Write the top attributes of every item; returns the one-row summary."""
    best = affinity_topk(frozen_items, _aligned(spark, models_path, provider, specs), top_k)
    T.write_table(best, output_path)
    return affinity_summary(T.read_table(spark, output_path))


def score_households(
    spark: SparkSession, data_path: str, models_path: str, output_path: str,
    provider: str = "cooc_ae_item", specs: list[dict] | None = None, top_k: int = 50,
) -> DataFrame:
    """Write the top attributes of every household; returns the one-row summary."""
    history = T.read_table(spark, f"{data_path}/hh_attr_history")
    best = household_affinity_topk(history, _aligned(spark, models_path, provider, specs), top_k)
    T.write_table(best, output_path)
    return affinity_summary(T.read_table(spark, output_path), "household_id")


def run_pipeline(
    items: DataFrame,
    txns: DataFrame,
    households: DataFrame,
    frozen_items: DataFrame,
    root: str,
    specs: list[dict] | None = None,
    align_config: dict | None = None,
    as_of: str | None = None,
    top_k: int = 50,
) -> dict:
    """All steps in order, below `root`; scoring uses the first provider of the specs.

    The frozen vectors are written once, as training and scoring read them many times.
    """
    frozen_items = materialize(frozen_items)
    spark, specs = items.sparkSession, DEFAULT_SPECS if specs is None else specs
    data, models = f"{root}/data", f"{root}/models"
    names = [s["name"] for s in specs]
    out: dict = {"tables": run_etl(items, txns, households, data, as_of)}
    out["providers"] = run_all_providers(spark, data, f"{models}/attr_embeddings", specs)
    out["comparison"] = run_comparison(spark, data, f"{models}/attr_embeddings", names)
    out["alignment"] = run_alignment(spark, data, models, frozen_items, names[0], specs, align_config)
    out["items"] = score_items(spark, models, frozen_items, f"{models}/item_affinity", names[0], specs, top_k)
    out["households"] = score_households(spark, data, models, f"{models}/household_affinity", names[0], specs, top_k)
    return out
