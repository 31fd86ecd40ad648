import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldbook.operators.ids import continue_ids, dense_ids


def test_dense_ids_match_global_row_number(spark):
    random.seed(7)
    data = [(random.randint(-50, 50) if i % 13 else None, i) for i in range(600)]
    df = spark.createDataFrame(data, "k long, t long")
    for buckets in (1, 3, 8, 40):
        got = dense_ids(df, ["k", "t"], "id", buckets=buckets)
        ref = df.withColumn("rid", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first(), "t")))
        mism = got.join(ref, ["k", "t"]).where(F.col("id") != F.col("rid")).count()
        assert mism == 0
        ids = [r.id for r in got.select("id").collect()]
        assert sorted(ids) == list(range(1, 601))


def test_dense_ids_per_group_and_start(spark):
    data = [(g, k) for g in ("a", "b", None) for k in range(50)]
    df = spark.createDataFrame(data, "g string, k long")
    got = dense_ids(df, ["k"], "id", start=10, partition_by=["g"], buckets=4)
    for g in ("a", "b", None):
        part = got.where(F.col("g").eqNullSafe(F.lit(g))).orderBy("k").collect()
        assert [r.id for r in part] == list(range(10, 60))


def test_continue_ids_from_max_and_empty(spark):
    batch = spark.createDataFrame([(5,), (3,), (9,)], "seq long")
    stored = spark.createDataFrame([(41,), (7,)], "id long")
    got = continue_ids(batch, ["seq"], stored).orderBy("seq").collect()
    assert [(r.seq, r.id) for r in got] == [(3, 42), (5, 43), (9, 44)]
    empty = spark.createDataFrame([], "id long")
    got = continue_ids(batch, ["seq"], empty).orderBy("seq").collect()
    assert [r.id for r in got] == [1, 2, 3]


def test_dense_ids_empty_input(spark):
    df = spark.createDataFrame([], "k long")
    assert dense_ids(df, ["k"], "id").count() == 0


def test_dense_ids_heavy_leading_value_and_string_keys(spark):
    data = [(1 if i < 300 else i, f"s{i:04d}") for i in range(600)]
    df = spark.createDataFrame(data, "k long, t string")
    got = dense_ids(df, ["k", "t"], "id", buckets=6)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy("k", "t")))
    assert got.join(ref, ["k", "t"]).where(F.col("id") != F.col("rid")).count() == 0
    by_string = dense_ids(df, ["t"], "id", buckets=4).orderBy("t").collect()
    assert [r.id for r in by_string] == list(range(1, 601))


def test_dense_ids_on_sampled_ranges(spark, tmp_dir):
    # enough rows per input partition that range bounds come from a sample
    src = spark.range(0, 40000, numPartitions=8).select(((F.col("id") * 7919) % 40000).alias("k"))
    src.write.parquet(f"{tmp_dir}/src")
    df = spark.read.parquet(f"{tmp_dir}/src")
    got = dense_ids(df, ["k"], "id", buckets=8)
    assert got.where(F.col("id") != F.col("k") + 1).count() == 0
