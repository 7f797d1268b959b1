import time
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from larder.operators import ranking
from larder.operators import sampling as P


def vectors(spark, ids, key="attr_id"):
    return spark.createDataFrame([(i, [1.0, 0.0]) for i in ids], f"{key} string, vector array<double>")


@pytest.mark.parametrize("splits", [1, 7, 256])
def test_global_rank_and_running_total(spark, splits):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("v"))
    got = ranking.with_running_total(
        ranking.with_global_rank(df, F.col("k"), "rank", splits), F.col("k"), F.col("v"), "before", splits
    ).collect()
    got.sort(key=lambda r: r["k"])
    assert [r["rank"] for r in got] == list(range(500))
    total = 0
    for r in got:
        assert r["before"] == total
        total += r["v"]


def test_top_k_ranks_without_gaps(spark):
    df = spark.createDataFrame([("g", c, 1.0) for c in "dcba"], "g string, id string, s double")
    got = ranking.top_k(df, "g", "s", "id", 3).orderBy("rank").collect()
    assert [(r["id"], r["rank"]) for r in got] == [("a", 1), ("b", 2), ("c", 3)]


def test_split_is_a_partition_of_the_items(spark):
    split = P.train_val_split(vectors(spark, map(str, range(203)), "item_id"), 0.8, seed=3)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"train": int(203 * 0.8), "val": 203 - int(203 * 0.8)}
    assert split.select("item_id").distinct().count() == 203


HOUSEHOLDS = [("hh1", "brand_a"), ("hh1", "brand_b"), ("hh2", "brand_b"), ("hh2", "brand_c"), ("hh3", "brand_a")]


@pytest.mark.parametrize("strategy", ["random", "popularity", "anything"])
def test_negatives_are_never_positives(spark, strategy):
    positives = spark.createDataFrame(HOUSEHOLDS, "item_id string, attr_id string")
    popularity = spark.createDataFrame([("brand_a", 5), ("brand_b", 1), ("brand_c", 9)], "attr_id string, n_rows bigint")
    got = P.sample_negatives(positives, popularity, k=2, strategy=strategy).collect()
    assert len(got) == 10
    allowed = {"hh1": {"brand_c"}, "hh2": {"brand_a"}, "hh3": {"brand_b", "brand_c"}}
    assert all(r["neg_attr"] in allowed[r["item_id"]] for r in got)


@pytest.mark.parametrize("strategy", ["random", "popularity"])
def test_item_with_whole_vocabulary_is_padded(spark, strategy):
    positives = spark.createDataFrame([("i", "a"), ("i", "b")], "item_id string, attr_id string")
    popularity = spark.createDataFrame([("a", 3), ("b", 1)], "attr_id string, n_rows bigint")
    got = P.sample_negatives(positives, popularity, k=4, strategy=strategy).collect()
    assert len(got) == 8 and {r["neg_attr"] for r in got} <= {"a", "b"}


def test_popularity_draws_follow_the_weights(spark):
    positives = spark.range(3000).selectExpr("cast(id AS string) AS item_id", "'own' AS attr_id")
    popularity = spark.createDataFrame([("a", 6), ("b", 3), ("c", 1), ("own", 50)], "attr_id string, n_rows bigint")
    got = P.popularity_negatives(positives, popularity, k=2).groupBy("neg_attr").count().collect()
    share = {r["neg_attr"]: r["count"] / 6000 for r in got}
    assert share == {"a": pytest.approx(0.6, abs=0.03), "b": pytest.approx(0.3, abs=0.03), "c": pytest.approx(0.1, abs=0.03)}


def test_popularity_draws_need_no_row_a_map_row(spark):
    """Weights that add up to 2 * 10**9: a row a point of them could neither be broadcast nor shuffled here."""
    positives = spark.range(2000).selectExpr("cast(id AS string) AS item_id", "'own' AS attr_id")
    rare = [(f"r{i:04d}", 1 + i % 2) for i in range(5000)]
    weights = spark.createDataFrame([("a", 10**9), *rare, ("b", 10**9 - 1), ("own", 3)], "attr_id string, n_rows bigint")
    began = time.perf_counter()
    got = {r["neg_attr"]: r["count"] for r in P.popularity_negatives(positives, weights, k=3).groupBy("neg_attr").count().collect()}
    assert time.perf_counter() - began < 60
    assert sum(got.values()) == 6000 and set(got) <= {"a", "b", *(a for a, _ in rare)}
    assert got["a"] == pytest.approx(3000, abs=200)


def test_popularity_draws_find_the_attribute_of_their_point(spark):
    """Every point is drawn somewhere; each is looked up in the weights one by one, on both sides of the edges of stretches."""
    weights = [(f"a{i:03d}", w) for i, w in enumerate([4095, 1, 1, 4096, 3, 9000, 0, 2, 1, 4093, 17])]
    positives = spark.range(1500).selectExpr("cast(id AS string) AS item_id", "'a005' AS attr_id")
    got = P.popularity_negatives(positives, spark.createDataFrame(weights, "attr_id string, n_rows bigint"), k=4, seed=5, epoch=2).collect()
    line = [a for a, w in weights if a != "a005" for _ in range(w)]
    assert len(got) == 6000
    for r in got:
        draw = int(md5(f"5|2|{r['item_id']}|a005|{r['slot']}".encode()).hexdigest()[:15], 16) % len(line)
        assert r["neg_attr"] == line[draw]


def test_epochs_draw_anew(spark):
    positives = spark.range(50).selectExpr("cast(id AS string) AS item_id", "'a00' AS attr_id")
    attrs = vectors(spark, [f"a{i:02d}" for i in range(40)])
    first, again, other = (P.uniform_negatives(positives, attrs, epoch=e) for e in (0, 0, 1))
    assert first.exceptAll(again).count() == 0 and first.exceptAll(other).count() > 0


def test_samples_need_both_vectors(spark):
    rows = spark.createDataFrame([("i1", "a"), ("i1", "b"), ("i2", "a")], "upc_nbr string, attr_id string")
    items, attrs = vectors(spark, ["i1"], "item_id"), vectors(spark, ["a", "z"])
    assert [tuple(r) for r in P.positive_samples(rows, items, attrs).collect()] == [("i1", "a")]
    popularity = {r["attr_id"]: (r["n_rows"], r["probability"]) for r in P.attribute_popularity(rows, attrs).collect()}
    assert popularity == {"a": (2, pytest.approx(2 / 3)), "z": (1, pytest.approx(1 / 3))}
    triples = P.training_triples(rows, items, attrs, negatives_per_pos=3)
    row = P.attach_vectors(triples, items, attrs).first()
    assert row["neg_attrs"] == ["z"] * 3 and len(row["neg_vectors"]) == 3


@pytest.mark.parametrize("shard_rows", [1 << 14, 7])
def test_vectors_travel_once_to_a_shard(spark, shard_rows):
    items, attrs = (spark.createDataFrame([(f"{key[0]}{k}", [float(k), 0.5]) for k in range(n)], f"{key} string, vector array<double>")
                    for key, n in (("item_id", 30), ("attr_id", 12)))
    rows = [(f"i{k % 30}", f"a{k % 13}", [f"a{(k + j) % 13}" for j in range(1, 6)]) for k in range(390)]  # a12 has no vector
    triples = spark.createDataFrame(rows, "item_id string, pos_attr string, neg_attrs array<string>").repartition(5)
    _, fetched = P.shard_vectors(triples, attrs, 4)
    assert fetched.count() == fetched.select("shard", "attr_id").distinct().count() <= 4 * 12
    known = {r["attr_id"]: r["vector"] for r in attrs.collect()}
    own = {r["item_id"]: r["vector"] for r in items.collect()}
    got = P.attach_vectors(triples, items, attrs, shard_rows).collect()
    assert sorted((r["item_id"], r["pos_attr"]) for r in got) == sorted((i, p) for i, p, _ in rows if p in known)
    for r in got:
        assert r["pos_vector"] == known[r["pos_attr"]] and r["item_vector"] == own[r["item_id"]]
        assert r["neg_vectors"] == [known[a] for a in r["neg_attrs"] if a in known]
    assert P.attach_vectors(triples.limit(0), items, attrs).count() == 0


def test_draws_over_a_profile_of_ten_thousand(spark):
    """A draw is a binary search: looked up one by one, these 100,000 draws would take some 10**9 comparisons."""
    held = spark.range(20_000).where("id % 2 = 0").selectExpr("'i' AS item_id", "printf('a%05d', id) AS attr_id")
    weights = spark.range(20_000).selectExpr("printf('a%05d', id) AS attr_id", "1 + id % 3 AS n_rows")
    for draw in (lambda: P.uniform_negatives(held, weights), lambda: P.popularity_negatives(held, weights)):
        began = time.perf_counter()
        rows = draw().select("neg_attr").collect()
        assert time.perf_counter() - began < 60
        negatives = {r["neg_attr"] for r in rows}
        assert len(rows) == 50_000 and all(int(a[1:]) % 2 for a in negatives) and len(negatives) > 9_000
