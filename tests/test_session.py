import os

import pytest

from larder import session as S


class Session:
    """A session of the given master without any checkpoint folder."""

    def __init__(self, master, named=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: named or default)})
        self.sparkContext = type("Context", (), {
            "master": master, "applicationId": f"app-{master}", "getCheckpointDir": staticmethod(lambda: None)})


def test_tables_are_written_below_the_shared_folder_and_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "_written", [])
    monkeypatch.setattr(S, "shared_dir", lambda spark: str(tmp_path))
    table = S.materialize(spark.range(5))
    assert table.count() == 5 and len(os.listdir(tmp_path)) == 1
    S.release_tables()
    assert os.listdir(tmp_path) == []


def test_only_a_local_master_may_go_without(monkeypatch):
    monkeypatch.setattr(S, "_written", [])
    monkeypatch.setattr(S, "_local_dirs", {})
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            S.shared_dir(Session(master))
        assert S.shared_dir(Session(master, "hdfs:///shared")) == "hdfs:///shared"
    local = S.shared_dir(Session("local[4]"))
    assert os.path.isdir(local) and S.shared_dir(Session("local[4]")) == local


def test_using_the_shared_folder_leaves_the_session_as_it_was(spark):
    before = spark.sparkContext.getCheckpointDir()
    S.materialize(spark.range(3))
    assert spark.sparkContext.getCheckpointDir() == before


def test_small_batches_leave_what_is_set(spark):
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", {k: spark.conf.get(k) for k in S.SMALL_BATCHES}
    try:
        S.small_batches(spark)
        assert spark.conf.get(key) == "1000" and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "16m"
        sizes = spark.range(0, 2500, 1, 1).mapInPandas(lambda it: (b.assign(id=len(b)).head(1) for b in it), "id long").collect()
        assert [r["id"] for r in sizes] == [1000, 1000, 500]
        spark.conf.set(key, "77")
        S.small_batches(spark)
        assert spark.conf.get(key) == "77"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
