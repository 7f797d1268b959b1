import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import blocks, contrastive
from larder.operators import comparison as C
from larder.operators import scoring as R
from larder.operators import vector_sums as VS
from larder.functions import vectors as X
from larder.sources import vector_store as S


def table(spark, matrix, key):
    return spark.createDataFrame([(f"{key}{i:03d}", [float(x) for x in row]) for i, row in enumerate(matrix)],
                                 f"{key}_id string, vector array<double>")


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(0)
    items, attrs = rng.normal(size=(40, 8)), rng.normal(size=(23, 8))
    return items, attrs, table(spark, items, "item"), table(spark, attrs, "attr")


def unit(m):
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_topk_broadcast_and_block_join_agree_with_numpy(monkeypatch, sides, limit):
    monkeypatch.setattr(blocks, "RIGHT_BLOCK", 7)
    monkeypatch.setattr(blocks, "LEFT_PACK", 11)
    items, attrs, left, right = sides
    want = unit(items) @ unit(attrs).T
    got = R.affinity_topk(left, right, k=5, limit_bytes=limit).collect()
    assert len(got) == 200
    for r in got:
        order = np.argsort(-want[int(r["item_id"][4:])])
        assert int(r["attr_id"][4:]) == order[r["rank"] - 1]
        assert r["affinity_score"] == pytest.approx(want[int(r["item_id"][4:]), order[r["rank"] - 1]])
    assert R.affinity_scores(left, right, limit_bytes=limit).count() == 40 * 23


def test_all_scores_are_made_by_all_cores(spark, sides):
    _, _, left, right = sides
    tasks = R.affinity_scores(left.coalesce(1), right).groupBy(F.spark_partition_id()).count().count()
    assert tasks == spark.sparkContext.defaultParallelism


def test_block_join_and_broadcast_agree_on_ties(monkeypatch, spark):
    """Copies and multiples of nine directions: most places of a ranking are ties, which ids decide."""
    monkeypatch.setattr(blocks, "RIGHT_BLOCK", 16)
    rng = np.random.default_rng(7)
    directions = rng.normal(size=(9, 6))
    right = table(spark, directions[rng.integers(0, 9, 180)] * rng.uniform(0.5, 3, (180, 1)), "attr")
    left = table(spark, rng.normal(size=(50, 6)), "item")
    key = ["item_id", "rank"]
    got = [R.affinity_topk(left, right, k=30, limit_bytes=b).toPandas().sort_values(key).reset_index(drop=True) for b in (1 << 20, 0)]
    assert got[0][["item_id", "attr_id", "rank"]].equals(got[1][["item_id", "attr_id", "rank"]])
    unit_rows = right.withColumn("vector", X.l2_normalize("vector"))
    near = [C.nearest_neighbors(unit_rows, 30, b).toPandas().sort_values(["attr_id", "rank"]).reset_index(drop=True) for b in (1 << 20, 0)]
    assert near[0][["attr_id", "neighbor", "rank"]].equals(near[1][["attr_id", "neighbor", "rank"]])


@pytest.mark.parametrize("k", [1, 7, 40, 60])
def test_best_of_few_right_rows(monkeypatch, k):
    """Sorted whole or cut by a floor first: the same rows; ties go by right id, and the row itself is left out."""
    rng = np.random.default_rng(k)
    rows = unit(rng.normal(size=(12, 3)))[rng.integers(0, 12, 50)]
    ids, sorts, own = np.array([f"v{i:02d}" for i in range(50)], object), [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **b: sorts.append(1) or own(*a, **b))
    got = []
    for whole in (0, 1 << 20):
        monkeypatch.setattr(blocks, "WHOLE", whole)
        got.append(blocks.best_k(k, True)(ids[:4], rows[:4], ids, rows).sort_values(["id", "rank"], ignore_index=True))
    assert got[0].equals(got[1]) and len(sorts) == 1 + (k >= 50) and len(got[0]) == 4 * min(k, 49)


def test_neighbors_drop_self_by_id_even_when_tied(spark):
    twins = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])], "attr_id string, vector array<double>")
    got = {(r["attr_id"], r["rank"]): r["neighbor"] for r in C.nearest_neighbors(twins, 2).collect()}
    assert got == {("a", 1): "b", ("a", 2): "c", ("b", 1): "a", ("b", 2): "c", ("c", 1): "a", ("c", 2): "b"}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_infonce_equals_dense_computation(monkeypatch, spark, limit):
    monkeypatch.setattr(blocks, "RIGHT_BLOCK", 5)
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(9, 4)), rng.normal(size=(9, 4))
    z = np.concatenate([unit(a), unit(b)])
    sim = z @ z.T / 0.5
    np.fill_diagonal(sim, -1e9)
    pos = np.r_[np.arange(9) + 9, np.arange(9)]
    want = np.mean(np.log(np.exp(sim).sum(1)) - sim[np.arange(18), pos])
    got = contrastive.infonce_loss(table(spark, a, "attr"), table(spark, b, "attr"), 0.5, limit).first()
    assert got["loss"] == pytest.approx(want) and got["n_anchors"] == 18


@pytest.mark.parametrize("n, block, team", [(40, 7, 11), (40, 3, 1000), (7, 50, 1), (133, 4, 30)])
def test_infonce_multiplies_each_pair_once(monkeypatch, spark, n, block, team):
    """Blocks and teams of any number: each pair of vectors counts for both, and is multiplied once (a block with itself: twice)."""
    monkeypatch.setattr(blocks, "RIGHT_BLOCK", block)
    monkeypatch.setattr(blocks, "TEAM_ROWS", team)
    monkeypatch.setattr(contrastive, "TILE", (3, 5))
    rng = np.random.default_rng(n)
    z = unit(rng.normal(size=(n, 4)))
    both = table(spark, z, "attr").withColumnRenamed("attr_id", "id")
    e = np.exp((z @ z.T - 1) / 0.3)
    np.fill_diagonal(e, 0)
    got = {r["id"]: r["total"] for r in contrastive._pair_sums(both, n, 0.3).groupBy("id").agg(F.sum("total").alias("total")).collect()}
    assert got == {f"attr{i:03d}": pytest.approx(t) for i, t in enumerate(e.sum(1))}
    state, pairs = contrastive._PairSums(0.3), []
    monkeypatch.setattr(state, "_tiles", lambda left, right, totals, met: pairs.append((met is None) + 1))
    state.add(0, 0, None, np.arange(3).astype(object), z[:3])
    state.add(0, 1, None, np.arange(3).astype(object), z[3:6])
    list(state.meet(np.arange(3).astype(object), z[:3], [{"group": 1, "part": 0}, {"group": 0, "part": 1}]))
    assert pairs == [2, 1]


def test_vector_functions(spark):
    row = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "z array<double>, v array<double>").select(
        X.l2_normalize("z").alias("z"), X.l2_normalize("v").alias("v"), X.vec_cos("z", "v").alias("c"), X.vec_l2("z", "v").alias("d")
    ).first()
    assert (row["z"], row["v"], row["c"], row["d"]) == ([0.0, 0.0], [0.6, 0.8], None, 5.0)


def test_household_profile(spark, sides):
    _, attrs, _, right = sides
    history = spark.createDataFrame([("h", "attr001", 3.0), ("h", "attr004", 1.0)], "household_id string, attr_id string, hist_score double")
    want = 3 * attrs[1] + attrs[4]
    got = R.household_profiles(history, right).first()["vector"]
    assert got == pytest.approx(list(want / np.linalg.norm(want)))
    best = R.household_affinity_topk(history, right, k=23).orderBy("rank").collect()
    assert [r["rank"] for r in best] == list(range(1, 24))
    summary = R.affinity_summary(R.household_affinity_topk(history, right, k=4), "household_id").first()
    assert (summary["n_rows"], summary["n_items"], summary["n_attributes"], summary["rows_per_item"]) == (4, 1, 4, 4.0)


def test_store_round_trip(spark, sides, tmp_path):
    path, vectors = str(tmp_path / "store"), sides[3]
    S.write_vectors(S.store_rows(vectors, "p", "2024-01-01"), path)
    S.write_vectors(S.store_rows(vectors, "q", "1"), path)
    S.write_vectors(S.store_rows(vectors.limit(3), "p", "2024-02-01"), path)
    S.write_vectors(S.store_rows(vectors.limit(5), "q", "1"), path)
    assert S.load_vectors(spark, path, "p", "2024-01-01").count() == 23
    assert S.load_vectors(spark, path, "q", "1").first()["dim"] == 8
    latest = {r["provider"]: r["count"] for r in S.latest_vectors(S.read_store(spark, path)).groupBy("provider").count().collect()}
    assert latest == {"p": 3, "q": 5}
    with pytest.raises(ValueError):
        S.load_vectors(spark, path, "p", "none")


def test_a_write_that_stops_half_way_is_never_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    vectors = spark.createDataFrame([(f"a{i}", [1.0, float(i)]) for i in range(6)], "attr_id string, vector array<double>")
    S.write_vectors(S.store_rows(vectors, "p", "1"), path)
    before = S.read_store(spark, path)
    with monkeypatch.context() as m:
        m.setattr(S.time, "time_ns", lambda: 1 / 0)  # the rows are written, the commit isn't
        with pytest.raises(ZeroDivisionError):
            S.write_vectors(S.store_rows(vectors.limit(2), "p", "2"), path)
    assert S.latest_vectors(S.read_store(spark, path)).select("model_version").distinct().collect()[0][0] == "1"
    with pytest.raises(ValueError):
        S.load_vectors(spark, path, "p", "2")
    S.write_vectors(S.store_rows(vectors.limit(4), "p", "1"), path)
    S.write_vectors(S.store_rows(vectors.limit(3), "p", "3").unionByName(S.store_rows(vectors, "q", "1")), path)
    assert before.count() == 6 and S.read_store(spark, path).count() == 4 + 3 + 6  # a reader keeps the files it began with
    assert S.load_vectors(spark, path, "p", "1").count() == 4
    assert S.latest_vectors(S.read_store(spark, path)).groupBy("provider").count().orderBy("provider").collect() == [("p", 3), ("q", 6)]



def test_frozen_vectors(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "idx bigint, vector array<double>")
    assert {r["item_id"] for r in S.frozen_item_vectors(vectors).collect()} == {"item_0", "item_1"}
    ids = spark.createDataFrame([("x", 1)], "item_id string, idx bigint")
    assert [tuple(r) for r in S.frozen_item_vectors(vectors, ids).collect()] == [("x", [2.0])]
    with pytest.raises(ValueError):
        S.frozen_item_vectors(ids)


def test_comparison_needs_two_providers(spark):
    rows = [(a, p, v) for p in ("p", "q") for a, v in (("a", [0.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 2.0]))]
    vectors = spark.createDataFrame(rows + [("only_p", "p", [1.0, 1.0])], "attr_id string, provider string, vector array<double>")
    assert C.compare_embeddings(vectors, ["p", "missing"]) is None
    meta = spark.createDataFrame([("a", "f"), ("b", "f")], "attr_id string, attr_family string")
    out = C.compare_embeddings(vectors, ["p", "q", "missing"], meta)
    similarity = {(r["provider_a"], r["provider_b"]): r["mean_cosine"] for r in out["similarity"].collect()}
    assert similarity[("p", "q")] == similarity[("q", "p")] == 1.0 and similarity[("p", "missing")] is None
    assert len(similarity) == 9
    assert {r["n_distances"] for r in out["distances"].collect()} == {6}
    # c has no family: it is no anchor, and is not counted as a neighbour.
    assert {(r["n_neighbors"], r["n_same_family"]) for r in out["coherence"].collect()} == {(2, 2)}
    assert {r["norm_verdict"] for r in out["verdicts"].collect()} == {"normalized"}


def test_distance_sample_skips_self(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(12, 3))
    common = table(spark, m, "attr").selectExpr("attr_id", "'p' AS provider", "vector")
    got = C.distance_stats(common, seed=5, attributes=6, others=2).first()
    assert got["n_distances"] == 12


@pytest.mark.parametrize("held", [1 << 13, 3])
def test_weighted_sums_of_vectors(spark, monkeypatch, held):
    monkeypatch.setattr(VS, "HELD_KEYS", held)
    rng = np.random.default_rng(0)
    rows = [(None if k == 9 else f"k{k}", float(w), v.tolist()) for k, w, v in zip(rng.integers(0, 10, 400), rng.random(400), rng.normal(size=(400, 5)), strict=True)]
    df = spark.createDataFrame([*rows, ("k1", None, [1.0] * 5), ("k1", 1.0, None), ("gone", 1.0, None)], "id string, w double, v array<double>").repartition(6)
    got = {r["id"]: (r["weight"], r["sums"]) for r in VS.weighted_sums(df, "id", F.col("w"), F.col("v")).collect()}
    assert got.keys() == {r[0] for r in rows}
    for key, (weight, sums) in got.items():
        mine = [(w, np.array(v)) for k, w, v in rows if k == key]
        assert weight == pytest.approx(sum(w for w, _ in mine)) and sums == pytest.approx(sum(w * v for w, v in mine).tolist())


@pytest.mark.parametrize("dense, limit", [(8, 1 << 20), (0, 1 << 20), (8, 0)])
def test_sums_of_named_vectors(spark, monkeypatch, dense, limit):
    """Broadcast or joined, by products of matrices or row by row: names without a vector are left out, one with two counts twice."""
    monkeypatch.setattr(VS, "DENSE", dense)
    rng = np.random.default_rng(3)
    vectors = [(f"a{k % 11}", rng.normal(size=5).tolist()) for k in range(12)]  # a0 twice
    rows = [(None if k == 9 else f"k{k}", f"a{a}", float(w)) for k, a, w in zip(rng.integers(0, 10, 400), rng.integers(0, 13, 400), rng.random(400), strict=True)]
    df = spark.createDataFrame([*rows, ("k1", "a1", None), ("gone", "a12", 1.0), ("gone", None, 1.0)], "id string, attr_id string, w double").repartition(6)
    named = spark.createDataFrame([*vectors, ("a11", None), (None, [1.0] * 5)], "attr_id string, vector array<double>")
    got = {r["id"]: (r["weight"], r["sums"]) for r in VS.named_sums(df, "id", "attr_id", F.col("w"), named, limit).collect()}
    want: dict = {}
    for key, a, w in rows:
        for _, v in (x for x in vectors if x[0] == a):
            weight, sums = want.get(key, (0.0, np.zeros(5)))
            want[key] = weight + w, sums + w * np.array(v)
    assert got.keys() == want.keys()
    for key, (weight, sums) in want.items():
        assert got[key] == (pytest.approx(weight), pytest.approx(sums.tolist()))
    assert VS.named_sums(df, "id", "attr_id", F.col("w"), named.limit(0), limit).count() == 0


def test_profiles_shuffle_rows_not_vectors(spark):
    """History that is dealt out by household stays where it is, and no shuffle carries a vector."""
    history = spark.range(4000).selectExpr("cast(id % 900 AS string) AS household_id", "concat('attr00', id % 7) AS attr_id", "1.0D + id AS hist_score")
    attrs = spark.createDataFrame([(f"attr00{k}", [float(k + 1)] * 64) for k in range(7)], "attr_id string, vector array<double>")
    profiles = R.household_profiles(history.repartition("household_id"), attrs)
    assert profiles.count() == 900
    plan = profiles._jdf.queryExecution().sparkPlan().toString()
    assert "sums" not in plan.split("MapInArrow", 1)[1].split("\n", 1)[1]
    assert profiles._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1


def test_plan_of_vector_sums_does_not_widen(spark):
    plans = []
    for dim in (64, 512):
        df = spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit(1.0).alias("w"), F.array_repeat(F.rand(1), dim).alias("v"))
        plans.append(VS.weighted_sums(df, "id", F.col("w"), F.col("v")))
        assert len(plans[-1].first()["sums"]) == dim
    assert [len(p.columns) for p in plans] == [3, 3]
