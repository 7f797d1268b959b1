import random
import time

import pytest
from pyspark.sql import functions as F

from larder.functions import ordering as O
from larder.operators.ranking import with_global_rank, with_running_total


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(f"k{i:04d}", i * i % 17) for i in range(2000)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "key string, n long").repartition(5)


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_ranges_ascend_and_number_their_rows(keyed, ranges):
    rows = sorted(O.in_ranges(keyed, [F.col("key")], ranges).collect(), key=lambda r: r["key"])
    place = [(r["_range"], r["_at"]) for r in rows]
    assert len(rows) == 2000 and place == sorted(place)
    first = {p: i for i, (p, _) in reversed(list(enumerate(place)))}
    assert all(at == i - first[p] for i, (p, at) in enumerate(place))
    assert ranges is None or len(first) == ranges


@pytest.mark.parametrize("ranges,stride", [(None, 1024), (1, 1024), (40, 7)])
def test_running_totals(keyed, monkeypatch, ranges, stride):
    monkeypatch.setattr(O, "RANGES_PER_STRIDE", stride)
    total = 0
    for r in with_running_total(keyed, F.col("key"), F.col("n"), "before", ranges).orderBy("key").collect():
        assert r["before"] == total
        total += r["n"]
    assert [r["at"] for r in with_global_rank(keyed, F.col("key"), "at", ranges).orderBy("key").collect()] == list(range(2000))


def test_keys_with_ties_nulls_and_direction(spark):
    df = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(60)], "a int, b int")
    rows = O.in_ranges(df, [F.col("a").desc_nulls_last(), F.col("b")], 4).collect()
    got = [(r["a"], r["b"]) for r in sorted(rows, key=lambda r: (r["_range"], r["_at"]))]
    assert got == sorted(((r["a"], r["b"]) for r in rows), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))


def test_totals_before_by_group_over_strides(spark, monkeypatch):
    monkeypatch.setattr(O, "RANGES_PER_STRIDE", 4)
    rows = [(g, r, (g + 1) * r) for g in range(3) for r in range(0, 30, g + 1)]
    df = spark.createDataFrame(rows, "g int, _range int, n long")
    for r in O.totals_before(df, "n", "before", ("g",)).collect():
        assert r["before"] == sum(n for g, k, n in rows if g == r["g"] and k < r["_range"])


def test_empty(spark):
    assert with_global_rank(spark.createDataFrame([], "key string"), F.col("key"), "at").collect() == []


def test_time_does_not_grow_with_the_number_of_ranges(spark):
    """Rows are placed by binary search: a hundred times the ranges must not cost a multiple for each row."""
    df = spark.range(400_000).withColumn("key", F.md5(F.col("id").cast("string")))

    def seconds(ranges):
        cut = df.repartitionByRange(ranges, "key")
        began = time.perf_counter()
        cut.select(F.spark_partition_id().alias("p")).groupBy().agg(F.count_distinct("p")).collect()
        return time.perf_counter() - began

    seconds(20)
    few, many = seconds(20), seconds(1000)
    assert many < few + 30  # a linear search took 5 s a thousand ranges and 200,000 rows; a task costs about 10 ms
