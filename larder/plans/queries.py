"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as X
from ..operators import alignment as AL
from ..operators import attributes as A
from ..operators import autoencoder as AE
from ..operators import blocked_autoencoder as BA
from ..operators import comparison as C
from ..operators import contrastive as L
from ..operators import cooccurrence as CO
from ..operators import graph as G
from ..operators import graph_encoder as GE
from ..operators import history as H
from ..operators import neighborhoods as NB
from ..operators import nutrition as N
from ..operators import params as PA
from ..operators import sampling as P
from ..operators import scoring as R
from ..session import Scratch, materialize, scratch_path
from ..operators.blocks import BROADCAST_BYTES
from ..sources import retail_views as V
from ..sources import tables as T
from ..sources import vector_store as S
from . import pipeline as PL
from . import providers as PR

AS_OF = "1999-06-30"
REF_DATE = "1998-01-01"
PROVIDERS = ["plain", "reversed", "weighted"]
NUTRIENTS = ["added sugar", "calories", "fiber"]  # those that the item view prints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


_built: dict[tuple[str, str, str], DataFrame] = {}


def _once(name: str, spark: SparkSession, d: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A written table that the queries of one application share, as the steps of the pipeline do."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _built:
        _built[key] = materialize(build())
    return _built[key]


def _map(spark, d):
    return _once("map_item_attribute", spark, d, lambda: A.build_map_item_attribute(V.items(spark, d)))


def _history(spark, d, item_attrs=None):
    item_attrs = _map(spark, d) if item_attrs is None else item_attrs
    return H.build_hh_attr_history(V.transactions(spark, d), item_attrs)


def _map_and_history(spark, d):
    return _map(spark, d), _once("hh_attr_history", spark, d, lambda: _history(spark, d))


def build_shared_tables(spark: SparkSession, d: str) -> None:
    """The map and the history, written for the queries that read them."""
    _map_and_history(spark, d)


# ---- scans ---------------------------------------------------------------

@query
def scan_items(spark, d):
    return T.scan_items(V.items(spark, d))


@query
def scan_txn_window(spark, d):
    recent = T.scan_transactions(V.transactions(spark, d), as_of=AS_OF)
    return recent.withColumn("txn_date", F.col("txn_date").cast("string"))


@query
def scan_households(spark, d):
    return T.scan_households(V.households(spark, d))


@query
def table_counts(spark, d):
    items, txns = V.items(spark, d), V.transactions(spark, d)
    item_attrs = _map(spark, d)
    return T.table_counts({
        "attr_meta": A.build_attr_meta(items),
        "map_item_attribute": item_attrs,
        "hh_item": H.build_hh_item(txns),
        "hh_attr_history": H.build_hh_attr_history(txns, item_attrs),
        "item_nutrition": N.build_item_nutrition(items, NUTRIENTS),
        "hh_meta": T.scan_households(V.households(spark, d)),
    })


# ---- vocabulary and map ----------------------------------------------------

@query
def attr_meta(spark, d):
    return A.build_attr_meta(V.items(spark, d))


@query
def attr_meta_health(spark, d):
    return A.health_vocabulary(V.items(spark, d))


@query
def attr_meta_nutrition(spark, d):
    """The nutrition vocabulary with the number of items in each of its bins."""
    bins = A.build_nutrition_mapping(V.items(spark, d)).groupBy("attr_id").agg(F.count("*").alias("n_items"))
    return A.nutrition_vocabulary(spark).join(bins, "attr_id", "left").fillna(0, ["n_items"])


@query
def map_item_attribute(spark, d):
    return A.build_map_item_attribute(V.items(spark, d))


@query
def map_health(spark, d):
    return A.build_health_mapping(V.items(spark, d))


@query
def map_nutrition_bins(spark, d):
    return A.build_nutrition_mapping(V.items(spark, d))


@query
def item_nutrition(spark, d):
    return N.build_item_nutrition(V.items(spark, d), NUTRIENTS)


@query
def item_nutrition_pivot(spark, d):
    return N.pivot_nutrition(V.items(spark, d), NUTRIENTS)


@query
def nutrition_long(spark, d):
    return N.nutrition_long(V.items(spark, d))


@query
def nutrition_text(spark, d):
    """Nutrition printed in nine ways."""
    return N.nutrition_long(V.items_with_nutrition_text(spark, d))


# ---- household tables --------------------------------------------------------

@query
def hh_item(spark, d):
    return H.build_hh_item(V.transactions(spark, d))


@query
def hh_item_daily_basket(spark, d):
    return H.build_hh_item(V.transactions(spark, d), basket="household_day")


@query
def hh_attr_history(spark, d):
    return rounded(_history(spark, d), 6, "hist_score")


@query
def hh_attr_history_refdate(spark, d):
    out = H.build_hh_attr_history(V.transactions(spark, d), _map(spark, d), decay_days=365.0, ref_date=REF_DATE)
    return rounded(out, 5, "hist_score")


@query
def hh_attr_history_timestamps(spark, d):
    """Purchases at an hour of the day: days are floors of exact differences."""
    return rounded(H.build_hh_attr_history(V.timed_transactions(spark, d), _map(spark, d)), 6, "hist_score")


@query
def history_top_attrs(spark, d):
    return H.top_attributes(rounded(_history(spark, d), 6, "hist_score"), 5)


# ---- co-occurrence -------------------------------------------------------------

@query
def cooc_item(spark, d):
    return CO.item_cooccurrence(_map(spark, d)).withColumn("w", F.col("w").cast("bigint"))


@query
def cooc_household(spark, d):
    return rounded(CO.household_cooccurrence(_map_and_history(spark, d)[1]), 4, "w")


@query
def cooc_marginals(spark, d):
    cells = CO.mirror(CO.item_cooccurrence(_map(spark, d)))
    return CO.marginals(cells).withColumn("total", F.col("total").cast("bigint"))


@query
def cooc_stats(spark, d):
    item_attrs = _map(spark, d)
    stats = CO.matrix_stats(CO.mirror(CO.item_cooccurrence(item_attrs)), G.attribute_vocabulary(item_attrs))
    return rounded(stats, 6, "density_pct", "sparsity_pct")


@query
def sppmi_item(spark, d):
    return rounded(CO.sppmi(materialize(CO.mirror(CO.item_cooccurrence(_map(spark, d)))), 0.5), 6, "w")


@query
def sppmi_household(spark, d):
    return rounded(CO.sppmi(materialize(CO.mirror(CO.household_cooccurrence(_map_and_history(spark, d)[1]))), 0.0), 6, "w")


# ---- graph -----------------------------------------------------------------------

@query
def attr_vocab(spark, d):
    return G.indexed_vocabulary(materialize(G.attribute_vocabulary(*_map_and_history(spark, d))))


def _graph(spark, d):
    return G.build_attribute_graph(*_map_and_history(spark, d))


def _features(spark, d):
    items = V.items(spark, d)
    item_attrs = _map(spark, d)
    return G.build_node_features(
        G.attribute_vocabulary(item_attrs), A.build_attr_meta(items), item_attrs, N.build_item_nutrition(items, NUTRIENTS)
    )


def _long(df, column, digits=6):
    """(attr_id, pos, value): an array column as rows."""
    return df.select("attr_id", F.posexplode(column).alias("pos", "value")).withColumns(
        {"pos": F.col("pos").cast("bigint"), "value": F.round("value", digits)}
    )


@query
def attr_graph(spark, d):
    return rounded(_graph(spark, d), 4, "w")


@query
def attr_graph_item_only(spark, d):
    return G.build_attribute_graph(_map(spark, d), use_household_edges=False)


@query
def graph_stats(spark, d):
    return rounded(G.graph_stats(_graph(spark, d)), 6, "density_pct")


@query
def node_features_family(spark, d):
    items = V.items(spark, d)
    return _long(G.family_features(G.attribute_vocabulary(_map(spark, d)), A.build_attr_meta(items)), "family")


@query
def node_features_popularity(spark, d):
    item_attrs = _map(spark, d)
    return _long(G.popularity_features(G.attribute_vocabulary(item_attrs), item_attrs), "popularity")


@query
def node_features_nutrition(spark, d):
    items = V.items(spark, d)
    item_attrs = _map(spark, d)
    out = G.nutrition_features(G.attribute_vocabulary(item_attrs), item_attrs, N.build_item_nutrition(items, NUTRIENTS))
    return _long(out, "nutrition", 5)


@query
def node_features(spark, d):
    return _long(_features(spark, d), "features", 5)


@query
def edge_dropout(spark, d):
    return rounded(G.drop_edges(_graph(spark, d), 0.2, seed=7, view=1), 4, "w")


@query
def feature_mask(spark, d):
    return _long(G.mask_features(_features(spark, d), 0.1, seed=7, view=1), "features", 5)


@query
def denoise_mask(spark, d):
    cells = CO.mirror(CO.item_cooccurrence(_map(spark, d)))
    return G.denoise_mask(cells, 0.2, seed=7, epoch=3).withColumn("w", F.col("w").cast("bigint"))


@query
def neighbor_mean(spark, d):
    item_attrs, history = _map_and_history(spark, d)
    nodes = G.popularity_features(G.attribute_vocabulary(item_attrs), item_attrs)
    return _long(G.neighbor_mean(G.build_attribute_graph(item_attrs, history), nodes, 2, "popularity"), "neighbors")


# ---- vectors and the store -------------------------------------------------------------

@query
def l2_normalize(spark, d):
    scaled = V.labelled_vectors(spark, d).withColumn("vector", F.transform("vector", lambda x, k: x * (k + 1)))
    return _long(scaled.select("attr_id", X.l2_normalize("vector").alias("v")), "v")


def _store(spark, d):
    """A store of three providers; 'plain' has an older version that holds the reversed vectors."""
    path = scratch_path(spark, "store")
    vectors = V.provider_vectors(spark, d)
    created = F.to_timestamp(F.lit("2024-05-01 00:00:00"))
    for name in PROVIDERS:
        rows = vectors.where(F.col("provider") == name)
        S.write_vectors(S.store_rows(rows, name, f"{name}_2024-05-01", built_from="test", created_at=created), path)
    older = vectors.where(F.col("provider") == "reversed")
    S.write_vectors(S.store_rows(older, "plain", "plain_2024-04-01", created_at=created), path)
    return path


def _store_view(rows):
    return rows.select(
        "attr_id", "provider", "model_version", "vocab_version", "built_from", F.col("dim").cast("bigint").alias("dim"),
        F.round(F.get("vector", F.lit(0)), 6).alias("first_value"), F.round(X.vec_norm("vector"), 6).alias("norm"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


@query
def vector_store_write_read(spark, d):
    return _store_view(S.load_vectors(spark, _store(spark, d), "reversed", "reversed_2024-05-01"))


@query
def vector_store_latest(spark, d):
    return _store_view(S.latest_vectors(S.read_store(spark, _store(spark, d))))


@query
def frozen_item_vectors(spark, d):
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select(
        F.col("vec_id").alias("idx"), F.col("embedding").cast("array<double>").alias("vector")
    )
    id_map = spark.read.parquet(f"{d}/part.parquet").select(
        F.concat(F.lit("sku_"), F.col("p_partkey").cast("string")).alias("item_id"), F.col("p_partkey").alias("idx")
    )
    named = S.frozen_item_vectors(vectors, id_map).unionByName(S.frozen_item_vectors(vectors))
    return named.select("item_id", F.round(F.get("vector", F.lit(0)), 6).alias("first_value"))


@query
def infonce_loss(spark, d):
    z1 = V.labelled_vectors(spark, d)
    z2 = z1.withColumn("vector", F.reverse("vector"))
    return rounded(L.infonce_loss(z1, z2, 0.5), 6, "loss")


# ---- samples ---------------------------------------------------------------------------------

def _attr_vectors(spark, d, item_attrs):
    """Vectors of all mapped attributes: attribute number i takes the embedding numbered 3 i modulo their number."""
    vocabulary = G.indexed_vocabulary(materialize(G.attribute_vocabulary(item_attrs)))
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    n = vectors.agg(F.count(F.lit(1))).scalar()
    # The number is a column before the join: a broadcast does not wait for a subquery in its join key.
    numbered = vocabulary.withColumn("vec_id", F.pmod(F.col("idx") * 3, n))
    return materialize(
        numbered.join(vectors, "vec_id").select("attr_id", F.col("embedding").cast("array<double>").alias("vector"))
    )


def _sampled(spark, d):
    """(map, item vectors, attribute vectors)."""
    item_attrs = _map(spark, d)
    return item_attrs, V.item_vectors(spark, d), _attr_vectors(spark, d, item_attrs)


@query
def positive_samples(spark, d):
    return P.positive_samples(*_sampled(spark, d))


@query
def attr_popularity(spark, d):
    item_attrs, _, attr_vectors = _sampled(spark, d)
    return rounded(P.attribute_popularity(item_attrs, attr_vectors), 8, "probability")


@query
def negatives_uniform(spark, d):
    item_attrs, item_vectors, attr_vectors = _sampled(spark, d)
    positives = P.positive_samples(item_attrs, item_vectors, attr_vectors)
    out = P.uniform_negatives(positives, attr_vectors, k=5, seed=42, epoch=1)
    return out.withColumn("slot", F.col("slot").cast("bigint"))


@query
def negatives_popularity(spark, d):
    item_attrs, item_vectors, attr_vectors = _sampled(spark, d)
    positives = P.positive_samples(item_attrs, item_vectors, attr_vectors)
    popularity = materialize(P.attribute_popularity(item_attrs, attr_vectors))
    out = P.popularity_negatives(positives, popularity, k=5, seed=42, epoch=1)
    return out.withColumn("slot", F.col("slot").cast("bigint"))


@query
def train_val_split(spark, d):
    items = V.items(spark, d).select(F.col("upc_nbr").alias("item_id"))
    return P.train_val_split(items, 0.8, seed=42)


@query
def training_triples(spark, d):
    return P.training_triples(*_sampled(spark, d)).select(
        "split", "item_id", "pos_attr", F.posexplode("neg_attrs").alias("slot", "neg_attr")
    ).withColumn("slot", F.col("slot").cast("bigint"))


@query
def item_profiles(spark, d):
    positives = P.positive_samples(*_sampled(spark, d))
    return P.item_profiles(positives).select("item_id", F.concat_ws(",", "attrs").alias("attrs"))


# ---- alignment with fixed weights ----------------------------------------------------------------

def fixed_params(dim: int = 64, hidden: int = 4, out: int = 64) -> dict:
    i, j, o = np.arange(dim)[:, None], np.arange(hidden), np.arange(out)
    return {
        "w1": ((i * 7 + j * 3) % 11 - 5) / 10.0, "b1": (j + 1) / 10.0,
        "gamma": 1 + j / 10.0, "beta": j / 20.0, "mean": j / 10.0, "var": 1 + j / 4.0,
        "w2": ((j[:, None] * 5 + o * 2) % 7 - 3) / 10.0, "b2": (o % 3) / 10.0, "temperature": np.array(0.07),
    }


@query
def align_forward(spark, d):
    return _long(AL.align_attributes(_attr_vectors(spark, d, _map(spark, d)), fixed_params()), "vector")


@query
def align_logits(spark, d):
    item_attrs, item_vectors, attr_vectors = _sampled(spark, d)
    triples = P.training_triples(item_attrs, item_vectors, attr_vectors)
    rows = P.attach_vectors(triples, item_vectors, attr_vectors)
    out = AL.align_logits(rows, fixed_params())
    return rounded(out.withColumn("slot", F.col("slot").cast("bigint")), 5, "logit")


# ---- affinity ----------------------------------------------------------------------------------------

def _attr_side(spark, d):
    return V.labelled_vectors(spark, d).select("attr_id", "vector")


@query
def affinity_scores(spark, d):
    return rounded(R.affinity_scores(V.item_vectors(spark, d), _attr_side(spark, d)), 6, "affinity_score")


def _topk(spark, d):
    return R.affinity_topk(V.item_vectors(spark, d), _attr_side(spark, d), k=50)


@query
def affinity_topk(spark, d):
    return rounded(_topk(spark, d), 6, "affinity_score")


@query
def affinity_topk_blocks(spark, d):
    """The same by joined blocks, as for vectors too many to broadcast."""
    best = R.affinity_topk(V.item_vectors(spark, d), _attr_side(spark, d), k=50, limit_bytes=0)
    return rounded(best, 6, "affinity_score")


@query
def affinity_summary(spark, d):
    return rounded(R.affinity_summary(_topk(spark, d)), 6, "mean_score", "min_score", "max_score", "rows_per_item")


@query
def affinity_sample(spark, d):
    return rounded(R.affinity_sample(_topk(spark, d), 20), 6, "affinity_score")


@query
def household_affinity_topk(spark, d):
    item_attrs = _map(spark, d)
    history, attr_vectors = _history(spark, d, item_attrs), _attr_vectors(spark, d, item_attrs)
    return rounded(R.household_affinity_topk(history, attr_vectors, k=10), 6, "affinity_score")


# ---- encoders with fixed weights ------------------------------------------------------------------------

def _pattern(rows: int, cols: int, a: int, b: int, c: int, m: int) -> np.ndarray:
    i, j = np.arange(rows)[:, None], np.arange(cols)
    return ((i * a + j * b + c) % m - m // 2) / 10.0


@query
def ae_encode_fixed(spark, d):
    """The autoencoder's bottleneck of the items' SPPMI rows."""
    item_attrs = _map(spark, d)
    cells = CO.sppmi(materialize(CO.mirror(CO.item_cooccurrence(item_attrs))), 0.5)
    vocabulary = materialize(G.indexed_vocabulary(materialize(G.attribute_vocabulary(item_attrs))))
    n = vocabulary.count()
    params = {"w1": _pattern(n, 4, 7, 3, 0, 11), "b1": np.arange(1, 5) / 10.0,
              "w2": _pattern(4, 3, 5, 2, 1, 7), "b2": np.arange(3) / 20.0}
    return _long(AE.encode(AE.matrix_rows(cells, vocabulary), params, n), "vector", 5)


@query
def ae_encode_blocks(spark, d):
    """The same by a model in blocks of 64 attributes, as for vocabularies whose layers are too large for one place."""
    item_attrs, block = _map(spark, d), 64
    cells = CO.sppmi(materialize(CO.mirror(CO.item_cooccurrence(item_attrs))), 0.5)
    vocabulary = materialize(G.indexed_vocabulary(materialize(G.attribute_vocabulary(item_attrs))))
    n, pattern = vocabulary.count(), _pattern

    def weights(batches):
        for pdf in batches:
            for blk in pdf["id"]:
                rows = BA.block_rows(n, block, blk)
                w1 = pattern(rows, 4, 7, 3, 7 * blk * block, 11)
                yield pd.DataFrame([(blk, BA.pack([w1, np.zeros((rows, 4)), np.zeros(rows), np.zeros(rows)]), None)], columns=["blk", "m", "moments"])

    inner = {"b1": np.arange(1, 5) / 10.0, "w2": _pattern(4, 3, 5, 2, 1, 7), "b2": np.arange(3) / 20.0}
    entries = materialize(BA.sparse_entries(cells, vocabulary, block))
    trainer = BA.Trainer(entries, spark.range(-(-n // block)).mapInPandas(weights, BA.PLACED), inner, n, AE.AE_DEFAULTS, block)
    return _long(trainer.encode().join(vocabulary, "idx").select("attr_id", "vector"), "vector", 5)


@query
def graph_encode_fixed(spark, d):
    """Two layers of the graph encoder, with running statistics."""
    features = materialize(_features(spark, d))
    vocabulary = materialize(G.indexed_vocabulary(materialize(G.attribute_vocabulary(_map(spark, d)))))
    edges = _graph(spark, d)
    n_in = features.select(F.size("features")).first()[0]
    cfg = GE.GRAPH_DEFAULTS | {"hidden_dim": 3, "dim": 2, "n_layers": 2}
    params, running = {"w0": _pattern(n_in, 3, 5, 3, 0, 7), "b0": np.arange(1, 4) / 10.0}, {}
    for layer, width in ((1, 3), (2, 2)):
        j = np.arange(width)
        params |= {f"ws{layer}": _pattern(3, width, 2, 3, layer, 5), f"bs{layer}": (j + layer) / 20.0,
                   f"wn{layer}": _pattern(3, width, 3, 1, layer, 7), f"bn{layer}": j / 30.0,
                   f"gamma{layer}": 1 + j / 10.0, f"beta{layer}": j / 20.0}
        running |= {f"mean{layer}": j / 10.0, f"var{layer}": 1 + j / 4.0}
    cells, nodes = GE.edge_cells(edges, vocabulary, 64), materialize(GE.node_blocks(features, vocabulary, 64))
    return _long(GE.graph_encode(materialize(cells), nodes, params, running, cfg, n_in, 64), "vector", 5)


# ---- comparison of providers ------------------------------------------------------------------------------

def _common(spark, d):
    return C.common_vectors(V.provider_vectors(spark, d), [*PROVIDERS, "absent"])


def _meta(spark, d):
    """Attribute families are the labels."""
    return V.labelled_vectors(spark, d).select("attr_id", "attr_family")


@query
def provider_similarity(spark, d):
    _, common = _common(spark, d)
    return rounded(C.provider_similarity(common, [*PROVIDERS, "absent"]), 6, "mean_cosine")


@query
def common_attrs(spark, d):
    """Three providers that each lack some labels, so that the intersection is smaller than any of them."""
    gaps = (F.col("provider") == "plain") & (F.col("attr_family") == "0")
    gaps = gaps | ((F.col("provider") == "reversed") & (F.col("attr_family") == "1"))
    return C.common_attributes(V.provider_vectors(spark, d).where(~gaps), len(PROVIDERS))


def _neighbors(spark, d, limit_bytes):
    vectors, out = V.provider_vectors(spark, d), None
    for p in PROVIDERS:
        one = C.nearest_neighbors(vectors.where(F.col("provider") == p).select("attr_id", "vector"), limit_bytes=limit_bytes)
        one = one.select(F.lit(p).alias("provider"), "*")
        out = one if out is None else out.unionByName(one)
    return rounded(out, 6, "score")


@query
def nearest_neighbors(spark, d):
    return _neighbors(spark, d, BROADCAST_BYTES)


@query
def nearest_neighbors_blocks(spark, d):
    """The same by joined blocks, as for vectors too many to broadcast."""
    return _neighbors(spark, d, 0)


@query
def coherence(spark, d):
    present, common = _common(spark, d)
    return rounded(C.coherence_by_provider(common, _meta(spark, d), present), 6, "coherence")


@query
def norm_stats(spark, d):
    return rounded(C.norm_stats(_common(spark, d)[1]), 5, "norm_mean", "norm_std")


@query
def distance_stats(spark, d):
    return rounded(C.distance_stats(_common(spark, d)[1]), 6, "dist_mean", "dist_std")


@query
def distance_stats_sampled(spark, d):
    """A sample smaller than the attributes."""
    return rounded(C.distance_stats(_common(spark, d)[1], attributes=120, others=30), 6, "dist_mean", "dist_std")


@query
def provider_verdicts(spark, d):
    tables = C.compare_embeddings(V.provider_vectors(spark, d), [*PROVIDERS, "absent"])
    return rounded(tables["verdicts"], 5, "norm_mean", "spread")


# ---- trained models; no SQL equivalent -------------------------------------

@query
def cooc_ae_item(spark, d):
    provider = PR.CooccurrenceProvider({"source": "item"})
    provider.fit({"map_item_attribute": _map(spark, d)})
    return provider.vectors()


@query
def cooc_ae_hh(spark, d):
    provider = PR.CooccurrenceProvider({"source": "household", "pmi_shift": 0.0})
    provider.fit({"hh_attr_history": _map_and_history(spark, d)[1]})
    return provider.vectors()


def _graph_inputs(spark, d):
    items = V.items(spark, d)
    item_attrs, history = _map_and_history(spark, d)
    return {
        "attr_meta": materialize(A.build_attr_meta(items)), "map_item_attribute": item_attrs,
        "hh_attr_history": history, "item_nutrition": materialize(N.build_item_nutrition(items, NUTRIENTS)),
    }


@query
def gcl_embed(spark, d):
    provider = PR.GraphProvider({})
    provider.fit(_graph_inputs(spark, d))
    return provider.vectors()


@query
def graph_encode(spark, d):
    """The encoder with its starting weights."""
    provider = PR.GraphProvider({"epochs": 0})
    provider.fit(_graph_inputs(spark, d))
    return provider.vectors()


@query
def sampled_neighborhoods(spark, d):
    """Edges that batches of 16 attributes keep on two hops, three and two incoming ones a node."""
    vocabulary = G.indexed_vocabulary(materialize(G.attribute_vocabulary(_map(spark, d))))
    seeds = vocabulary.select(F.expr("idx div 16").alias("batch"), F.col("attr_id").alias("node"))
    _, arcs = NB.walk(materialize(_graph(spark, d)), seeds, [3, 2], 42, 0, Scratch(spark))
    return rounded(arcs.select("batch", "src", "dst", "w"), 4, "w")


@query
def best_epoch(spark, d):
    """The best epoch of a history that is given: orders a month as losses, with months that have none."""
    months = spark.read.parquet(f"{d}/orders.parquet").groupBy(F.date_format("o_orderdate", "yyyyMM").cast("int").alias("epoch"))
    counts = months.agg((F.count(F.lit(1)) / 100.0).alias("loss"))
    return AL.best_epoch(counts.select("epoch", F.when(F.col("epoch") % 3 != 0, F.col("loss")).alias("val_loss")))


@query
def params_written(spark, d):
    """A model of two arrays, customers by nation and segment and accounts by nation, written and read back."""
    held = spark.read.parquet(f"{d}/customer.parquet")
    counts = held.groupBy("c_nationkey").pivot("c_mktsegment").count().na.fill(0).orderBy("c_nationkey").toPandas()  # a row a nation
    params = {"segments": counts.drop(columns="c_nationkey").to_numpy(float), "nations": counts["c_nationkey"].to_numpy(float)}
    path = scratch_path(spark, "params")
    PA.write_params(spark, params, path)
    back = PA.params_frame(spark, PA.read_params(spark, path))
    return back.select("name", F.concat_ws("x", "shape").alias("shape"), F.posexplode("values").alias("at", "value"))


@query
def align_train(spark, d):
    return AL.train_alignment(*_sampled(spark, d))["history"]


@query
def train_history(spark, d):
    """History and metrics as written by a run, read back."""
    result = AL.train_alignment(*_sampled(spark, d))
    out = scratch_path(spark, "training")
    AL.write_training(result, f"{out}/history", f"{out}/metrics")
    history = spark.read.option("header", True).schema(
        "epoch int, train_loss double, val_loss double, val_acc double"
    ).csv(f"{out}/history")
    metrics = spark.read.schema("best_val_loss double, final_val_acc double").json(f"{out}/metrics")
    return history.withColumn("best_val_loss", metrics.select("best_val_loss").scalar())


def _etl(spark, d):
    root = scratch_path(spark, "etl")
    counts = PL.run_etl(V.items(spark, d), V.transactions(spark, d), V.households(spark, d), root, as_of=AS_OF)
    return root, counts


@query
def full_etl(spark, d):
    return _etl(spark, d)[1]


@query
def etl_written_map(spark, d):
    """The item map as a whole run has written it."""
    return T.read_table(spark, f"{_etl(spark, d)[0]}/map_item_attribute")


@query
def etl_written_history(spark, d):
    return rounded(T.read_table(spark, f"{_etl(spark, d)[0]}/hh_attr_history"), 6, "hist_score")


@query
def run_providers(spark, d):
    """The vectors of all providers in one store."""
    root, _ = _etl(spark, d)
    PR.run_all_providers(spark, root, f"{root}/attr_embeddings")
    return S.latest_vectors(S.read_store(spark, f"{root}/attr_embeddings")).select("provider", "attr_id", "dim")


def _retail(spark, d):
    out = PL.run_pipeline(
        V.items(spark, d), V.transactions(spark, d), V.households(spark, d), V.item_vectors(spark, d),
        scratch_path(spark, "pipeline"), align_config={}, as_of=AS_OF,
    )
    return out["items"].withColumn("side", F.lit("item")).unionByName(
        out["households"].withColumn("side", F.lit("household"))
    )


@query
def retail_pipeline(spark, d):
    """All steps; one row per scored side."""
    return _once("retail_pipeline", spark, d, lambda: _retail(spark, d))


@query
def retail_pipeline_counts(spark, d):
    """What does not depend on the training: items and households scored, and rows of their top 50."""
    return retail_pipeline(spark, d).select("side", "n_items", "n_rows")
