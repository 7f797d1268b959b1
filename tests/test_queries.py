import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import canon
from larder.plans import pipeline as PL
from larder.plans import providers as PR
from larder.sources import retail_views as V

SF = "/root/testdata/sf0.001"
CHECKED = [
    "attr_meta", "map_item_attribute", "item_nutrition", "hh_attr_history", "history_top_attrs", "cooc_household",
    "sppmi_item", "attr_graph", "node_features", "edge_dropout", "neighbor_mean", "vector_store_latest",
    "negatives_uniform", "negatives_popularity", "training_triples", "align_forward", "affinity_topk", "coherence",
    "full_etl",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", CHECKED)
def test_query_equals_sql(spark, db, key):
    got = canon(entry.queries()[key](spark, SF).toPandas())
    want = canon(db.execute(entry.oracle_sql()[key]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["household_id", "attr_id", "hist_score", "last_seen_days"]


def test_pipeline_end_to_end(spark, tmp_path):
    specs = [
        {"name": "cooc_ae_item", "model_version": "v1", "config": {"source": "item", "epochs": 2}},
        {"name": "cooc_ae_hh", "model_version": "v1", "config": {"source": "household", "epochs": 2}},
    ]
    out = PL.run_pipeline(
        V.items(spark, SF), V.transactions(spark, SF), V.households(spark, SF), V.item_vectors(spark, SF),
        str(tmp_path), specs, {"epochs": 1}, as_of="1999-06-30", top_k=5,
    )
    assert out["providers"].count() == 2 and out["tables"].count() == 6
    assert set(out["comparison"]) == {"similarity", "norms", "distances", "verdicts", "coherence"}
    assert out["comparison"]["verdicts"].first()["norm_verdict"] == "normalized"
    assert out["items"].first()["rows_per_item"] == 5.0
    assert set(out["alignment"]) == {"best_val_loss", "final_val_loss", "final_val_acc", "final_train_loss"}
    assert spark.read.option("header", True).csv(f"{tmp_path}/models/alignment_cooc_ae_item/training_history").count() == 1
    with pytest.raises(ValueError):
        PR.version_of("unknown", specs)


def test_keys_of_all_items_are_not_broadcast(spark):
    """One column of well-packed items looks small whatever their number; only the vectors' side may be taken to every task."""
    vectors = V.item_vectors(spark, SF)
    assert vectors.count() == 200
    assert "Broadcast" not in vectors._jdf.queryExecution().sparkPlan().toString()


def test_attribute_vectors_with_a_small_vocabulary_beside_many_vectors(spark, db):
    """The vocabulary's side is the one that is broadcast: embeddings lie above the threshold, as they do in larger tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "100000")
    try:
        got = canon(entry.queries()["attr_popularity"](spark, SF).toPandas())
    finally:
        spark.conf.set(key, before)
    assert got.equals(canon(db.execute(entry.oracle_sql()["attr_popularity"]).df()))
