import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from larder.functions.text import with_nutrition_pairs
from larder.operators import attributes as A
from larder.operators import history as H
from larder.operators import nutrition as N
from larder.sources import tables as T

ITEM_SCHEMA = (
    "upc_nbr string, item_dsc string, smic_class_cd int, smic_category_cd string, department_nm string, "
    "shelf_nm string, health_clain_type_dsc string, nutrition_nm string, iri_brands_nm string"
)


def items(spark, *rows):
    """rows: (upc, brand, claims, nutrition)."""
    full = [(u, None, 1, "c", "Deli Counter", "Top Shelf", claims, nut, brand) for u, brand, claims, nut in rows]
    return spark.createDataFrame(full, ITEM_SCHEMA)


@pytest.mark.parametrize("text, expected", [
    ("""[["Calories", 180], ["Fiber", 4]]""", {"calories": 180.0, "fiber": 4.0}),
    ("[['Calories', 180]]", {"calories": 180.0}),
    ("""[("calories", 50)]""", {"calories": 50.0}),
    ("""[["calories", None], ["fiber", 4]]""", {"calories": None, "fiber": 4.0}),
    ("""[["a",1],["b"]]""", {}),
    ("junk", {}),
    (None, {}),
    ("""[["Fiber",1],["fiber ",12]]""", {"fiber": 12.0}),
    ("""[["calories","x"]]""", {"calories": None}),
    ("""[["fat (total)", 3], ["None", 2]]""", {"fat (total)": 3.0, "none": 2.0}),
])
def test_nutrition_text(spark, text, expected):
    row = with_nutrition_pairs(items(spark, ("1", "b", None, text))).first()
    assert {p["name"]: p["value"] for p in row["_pairs"]} == expected


@pytest.mark.parametrize("nutrient, value, level", [
    ("added sugar", 5, "medium"), ("added sugar", 15, "high"), ("added sugar", 0, "low"),
    ("added sugar", 999, None), ("added sugar", -1, None), ("sodium", 1000, "high"), ("sodium", 9999, None),
    ("calories", 180, "medium"), ("added sugar", 22, "high"), ("saturated fat", 3, None),
])
def test_bin_edges(spark, nutrient, value, level):
    got = A.build_nutrition_mapping(items(spark, ("1", "b", None, f'[["{nutrient}", {value}]]'))).collect()
    assert [r["attr_id"] for r in got] == ([f"nutrition_{nutrient.replace(' ', '_')}_{level}"] if level else [])


def test_claims_and_case_collision(spark):
    rows = items(spark, ("1", "Chobani", "Kosher / Vegan//\tVegan ", None), ("2", "CHOBANI", None, None))
    claims = sorted(r["attr_id"] for r in A.build_health_mapping(rows).collect())
    assert claims == ["health_", "health_kosher", "health_vegan"]
    meta = A.build_attr_meta(rows)
    assert meta.where("attr_id = 'brand_chobani'").count() == 2
    assert meta.where("attr_family = 'nutrition'").count() == 21
    assert meta.where("attr_id = 'nutrition_added_sugar_high'").first()["display_name"] == "Added Sugar - High"
    assert {r["attr_id"] for r in meta.where("attr_family IN ('department', 'shelf', 'class')").collect()} == {
        "dept_deli_counter", "shelf_top_shelf", "class_1"
    }


def test_map_is_unique_and_survives_no_nutrition(spark):
    rows = items(spark, ("1", "A", "x/x", None), ("1", "A", "x", None), (("2"), None, None, None))
    got = A.build_map_item_attribute(rows)
    assert got.count() == got.select("upc_nbr", "attr_id").distinct().count()
    assert got.where("evidence_sources = 'nutrition_nm'").count() == 0
    assert got.where("upc_nbr = '2' AND attr_id LIKE 'brand%'").count() == 0
    assert A.build_nutrition_mapping(rows).columns == ["upc_nbr", "attr_id", "p_attr", "evidence_sources"]


def test_wide_nutrition(spark):
    rows = items(
        spark, ("1", "b", None, '[["Calories", 180], ["Saturated Fat", 3], ["Fat Calories", 9]]'), ("2", "b", None, None)
    )
    names = ["calories", "fat calories", "saturated fat"]
    assert sorted(r["name"] for r in N.nutrient_names(rows).collect()) == names
    wide = N.build_item_nutrition(rows, names)
    assert wide.columns == ["upc_id", "calories", "fat calories"]
    assert {r["upc_id"]: r["calories"] for r in wide.collect()} == {"1": 180.0, "2": None}
    pivoted = N.pivot_nutrition(rows, names)
    assert sorted(map(tuple, pivoted.collect())) == sorted(map(tuple, wide.collect()))


def txns(spark, *rows):
    return spark.createDataFrame(rows, "household_id string, upc_nbr string, txn_id string, txn_date date, item_qount double")


@pytest.fixture(scope="module")
def one_attr(spark):
    return spark.createDataFrame([("u1", "a", 1.0), ("u2", "b", 1.0), ("u2", "a", 0.5)], "upc_nbr string, attr_id string, p_attr double")


def test_history_weights(spark, one_attr):
    day = dt.date(2024, 1, 11)
    got = H.build_hh_attr_history(
        txns(spark, ("h", "u1", "t1", day, 2.0), ("h", "u2", "t2", day - dt.timedelta(30), 4.0),
             (None, "u1", "t3", day + dt.timedelta(1), 1.0), ("h", None, "t4", day + dt.timedelta(9), 1.0),
             ("h", "unmapped", "t5", day + dt.timedelta(50), 1.0)), one_attr)
    rows = {r["attr_id"]: r for r in got.collect()}
    # The last purchase of a mapped item sets the reference day, also without a household.
    assert rows["a"]["hist_score"] == pytest.approx(2 * math.exp(-1 / 90) + 0.5 * 4 * math.exp(-31 / 90))
    assert rows["b"]["hist_score"] == pytest.approx(4 * math.exp(-31 / 90))
    assert (rows["a"]["last_seen_days"], rows["b"]["last_seen_days"]) == (1, 31)


def test_history_reference_before_purchase_and_returns(spark, one_attr):
    got = H.build_hh_attr_history(
        txns(spark, ("h", "u1", "t", dt.date(2024, 1, 11), 1.0), ("r", "u1", "t", dt.date(2024, 1, 1), -3.0),
             ("n", "u1", "t", dt.date(2024, 1, 1), float("nan"))),
        one_attr, ref_date="2024-01-01").collect()
    assert [(r["household_id"], r["last_seen_days"]) for r in got] == [("h", -10)]
    assert got[0]["hist_score"] == pytest.approx(math.exp(10 / 90))


def test_days_between_timestamps(spark, one_attr):
    rows = spark.createDataFrame(
        [("h", "u1", "t1", dt.datetime(2024, 1, 10, 23), 1.0), ("g", "u1", "t2", dt.datetime(2024, 1, 12, 1), 1.0)],
        "household_id string, upc_nbr string, txn_id string, txn_date timestamp, item_qount double")
    got = {r["household_id"]: r["last_seen_days"] for r in H.build_hh_attr_history(rows, one_attr).collect()}
    assert got == {"h": 1, "g": 0}


def test_hh_item_baskets(spark):
    rows = txns(spark, ("h", "u", "t9", dt.date(2024, 2, 29), 1.0))
    assert H.build_hh_item(rows).first()["basket_id"] == "t9"
    by_day = H.build_hh_item(rows, basket="household_day").first()
    assert by_day["basket_id"] == "h_2024-02-29" and by_day["ts"] == dt.datetime(2024, 2, 29)
    with pytest.raises(ValueError):
        H.build_hh_item(rows, basket="week")


def test_scans_and_sinks(spark, tmp_path):
    rows = txns(spark, ("h", "u", "t", dt.date(2022, 2, 28), 1.0), ("h", "u", "t", dt.date(2022, 2, 27), 1.0))
    assert T.scan_transactions(rows, as_of="2024-02-29").count() == 1
    assert T.read_optional(spark, str(tmp_path / "absent")) is None
    assert T.write_table(rows, str(tmp_path / "t")) == 2
    assert T.read_optional(spark, str(tmp_path / "t")).count() == 2
    assert T.table_counts({"x": rows}).first()["row_count"] == 2


def test_history_fans_out_at_the_household_without_a_shuffle_by_attribute(spark, shop):
    txns = spark.createDataFrame(
        [("h1", "item1", "1998-01-01", 2.0), ("h1", "item4", "1998-01-01", 1.0), ("h2", "item3", "1998-01-01", 4.0)],
        "household_id string, upc_nbr string, txn_date string, item_qount double",
    ).withColumn("txn_date", F.to_date("txn_date"))
    out = H.build_hh_attr_history(txns, shop["map_item_attribute"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(household_id#" in plan
    assert not re.search(r"hashpartitioning\(household_id#\d+, (attr_id|code)#", plan)
    got = {(r["household_id"], r["attr_id"]): r["hist_score"] for r in out.collect()}
    assert got == {("h1", "brand_a"): 3.0, ("h1", "health_organic"): 2.0, ("h1", "category_dairy"): 2.0, ("h1", "health_vegan"): 1.0,
                   ("h2", "brand_c"): 4.0, ("h2", "category_snacks"): 4.0}


def test_nutrition_of_a_table_in_one_piece_is_read_by_many_tasks(spark):
    rows = spark.range(0, 2000, 1, 1).selectExpr("CAST(id AS string) AS upc_nbr", "concat('((\"calories\", ', id, '),)') AS nutrition_nm")
    read = with_nutrition_pairs(rows)
    tasks = {r["t"]: r["n"] for r in read.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()}
    assert len(tasks) >= 8 and max(tasks.values()) < 500
    assert read.where("size(_pairs) = 1 AND _pairs[0].value = CAST(upc_nbr AS double)").count() == 2000
