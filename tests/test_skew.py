import pytest

from sonoledger.operators.dataset_roots import attach_dataset_root
from sonoledger.operators.skew import spread_join


def frames(spark):
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 20}") for i in range(600)], "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("unused", 4)], "k string, v int")
    return left, right


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, how):
    left, right = frames(spark)
    got = spread_join(left, right, "k", ["i"], how)
    want = left.join(right, "k", how)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_hot_key_reaches_several_partitions(spark):
    left, right = frames(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from pyspark.sql import functions as F

        joined = spread_join(left, right, "k", ["i"]).filter("k = 'hot'")
        parts = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_other_join_types_are_refused(spark):
    left, right = frames(spark)
    with pytest.raises(ValueError):
        spread_join(left, right, "k", ["i"], "outer")


def test_dataset_roots_in_one_hot_folder(spark):
    paths = [f"/data/a/b/{i}.wav" if i % 3 else f"/other/{i}/x.wav" for i in range(300)] + [None, "plain.wav"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    roots = spark.createDataFrame([("/data",), ("/data/a/",), ("/data/a/b/c",), ("/dat",)], "dataset_root string")
    got = {r.p: r.dataset_root for r in attach_dataset_root(rows, roots, "p").collect()}
    assert len(got) == len(paths)
    assert all(v == ("/data/a" if k and k.startswith("/data") else None) for k, v in got.items())
