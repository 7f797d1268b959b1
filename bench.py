"""Wall time of the headline queries.  Prints one JSON line.

The tables that queries share are built first and timed on their own; a query's time is the median of three runs (trained
models: one run). The total is of the shared tables and the headline queries, without the trained models.
"""

import json
import os
import time
from statistics import median

from larder.plans.queries import QUERIES, build_shared_tables
from larder.session import local_session

HEADLINE = [
    "attr_meta", "map_item_attribute", "item_nutrition", "hh_item", "hh_attr_history", "history_top_attrs",
    "cooc_item", "cooc_household", "sppmi_item", "sppmi_household", "attr_vocab", "attr_graph", "node_features",
    "edge_dropout", "neighbor_mean", "vector_store_latest", "infonce_loss", "negatives_uniform",
    "negatives_popularity", "train_val_split", "training_triples", "align_logits", "affinity_topk",
    "affinity_summary", "household_affinity_topk", "provider_similarity", "nearest_neighbors", "coherence",
    "distance_stats", "full_etl",
]
TRAINED = ["cooc_ae_item", "align_train", "gcl_embed"]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores, app="larder-bench")
    QUERIES["scan_items"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    start = time.time()
    build_shared_tables(spark, sf_dir)
    times = {"shared_tables": round(time.time() - start, 3)}
    for key in HEADLINE + TRAINED:
        taken = []
        for _ in range(RUNS if key in HEADLINE else 1):
            start = time.time()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - start)
        times[key] = round(median(taken), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(t for k, t in times.items() if k not in TRAINED), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
