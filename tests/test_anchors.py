"""Known values of the sf0.01 tables with brand, category, class and claim attributes only."""

import pytest
from pyspark.sql import functions as F

from larder.operators import attributes as A
from larder.operators import comparison as C
from larder.operators import cooccurrence as CO
from larder.operators import graph as G
from larder.operators import history as H
from larder.operators import sampling as P
from larder.session import materialize
from larder.sources import retail_views as V

SF = "/root/testdata/sf0.01"
FAMILIES = ["iri_brands_nm", "smic_category_cd", "smic_class_cd", "health_clain_type_dsc"]


@pytest.fixture(scope="module")
def tables(spark):
    full = materialize(A.build_map_item_attribute(V.items(spark, SF)))
    four = full.where(F.col("evidence_sources").isin(FAMILIES))
    return full, four, materialize(H.build_hh_attr_history(V.transactions(spark, SF), four))


def test_map_and_history(tables):
    _, four, history = tables
    assert four.count() == 10_000 and four.select("attr_id").distinct().count() == 97
    assert history.count() == 51_421 and history.select("household_id").distinct().count() == 1_441


def test_cooccurrence(tables):
    _, four, history = tables
    items = materialize(CO.item_cooccurrence(four))
    assert items.count() == 2_795 and items.agg(F.sum("w")).first()[0] == 20_000
    cells = CO.sppmi(CO.mirror(items), 1.0).agg(F.count("*"), F.max("w")).first()
    assert cells[0] == 202 and cells[1] == pytest.approx(0.6728342289928946, abs=1e-12)
    homes = CO.household_cooccurrence(history).agg(F.count("*"), F.sum("w")).first()
    assert homes[0] == 4_656 and homes[1] == pytest.approx(3_869_764.8736, rel=1e-8)
    assert G.undirected_edges(four, history, min_cooccur=3).count() == 4_656


def test_nutrition_bins(tables):
    full, _, _ = tables
    rows = full.where("evidence_sources = 'nutrition_nm'").groupBy("attr_id").count().collect()
    assert {r["attr_id"].removeprefix("nutrition_"): r["count"] for r in rows} == {
        "added_sugar_low": 304, "added_sugar_medium": 609, "added_sugar_high": 905,
        "calories_low": 565, "calories_medium": 625, "calories_high": 628,
        "fiber_low": 420, "fiber_medium": 980, "fiber_high": 418,
    }


def test_split(spark):
    items = V.items(spark, SF).select(F.col("upc_nbr").alias("item_id"))
    train = P.train_val_split(items, 0.8, seed=42).where("split = 'train'")
    assert train.agg(F.count("*"), F.sum(F.col("item_id").cast("bigint"))).first()[:] == (1_600, 1_587_968)


def test_coherence_and_norms(spark):
    vectors = V.labelled_vectors(spark, SF)
    row = C.coherence(C.nearest_neighbors(vectors.select("attr_id", "vector")), vectors.select("attr_id", "attr_family")).first()
    assert row["n_neighbors"] == 5_000 and row["coherence"] == pytest.approx(0.1026)
    norms = C.norm_stats(vectors.withColumn("provider", F.lit("p"))).first()
    assert norms["norm_mean"] == pytest.approx(1.0, abs=1e-6) and norms["norm_std"] == pytest.approx(3.6e-8, abs=1e-9)
