import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, shuffle_partitions=4, app="larder-tests")


@pytest.fixture(scope="session")
def shop(spark):
    """Seven attributes, four items, three households."""
    meta = spark.createDataFrame(
        [("brand_a", "brand"), ("brand_b", "brand"), ("brand_c", "brand"), ("health_organic", "health_claim"),
         ("health_vegan", "health_claim"), ("category_dairy", "category"), ("category_snacks", "category")],
        "attr_id string, attr_family string",
    )
    item_attrs = spark.createDataFrame(
        [("item1", "brand_a"), ("item1", "health_organic"), ("item1", "category_dairy"),
         ("item2", "brand_b"), ("item2", "health_organic"), ("item2", "category_dairy"),
         ("item3", "brand_c"), ("item3", "category_snacks"), ("item4", "brand_a"), ("item4", "health_vegan")],
        "upc_nbr string, attr_id string",
    ).selectExpr("*", "1.0D AS p_attr", "'test' AS evidence_sources")
    history = spark.createDataFrame(
        [("hh1", "brand_a", 10.0, 7), ("hh1", "health_organic", 5.0, 14), ("hh2", "brand_b", 8.0, 5),
         ("hh2", "health_organic", 3.0, 30), ("hh3", "brand_c", 12.0, 3)],
        "household_id string, attr_id string, hist_score double, last_seen_days bigint",
    )
    return {"attr_meta": meta, "map_item_attribute": item_attrs, "hh_attr_history": history}
