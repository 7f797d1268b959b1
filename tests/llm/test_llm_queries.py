import glob
import os

import duckdb
import pytest

import corpus_pipeline
from check_oracle import canon
from larder.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_query_equals_sql(spark, db, key):
    got, want = canon(Q.QUERIES[key](spark, SF).toPandas()), canon(db.execute(Q.ORACLE[key]).df())
    assert list(got.columns) == list(want.columns) and got.equals(want)


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = Q.documents(spark, SF)
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_stages_on_messy_rows(spark, messy, nothing, tmp_path):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (messy, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[:2] == ["doc_id", "piece"] and corpus_pipeline.ORACLE_SQL is None
