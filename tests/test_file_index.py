"""File skipping: the rows of a full scan, from the files that can hold them."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldbook.operators.file_index import FileIndex
from fieldbook.operators.search import search


def _table(spark, path, lo=0, hi=4000, files=20):
    df = spark.range(lo, hi, numPartitions=files).select(
        "id", F.concat(F.lit("name "), F.sha2(F.floor(F.col("id") / 200).cast("string"), 256)).alias("n"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("batch 50%_"), F.col("id"))).alias("note"),
        F.timestamp_seconds(F.col("id") * 86400).alias("at"))
    df.write.mode("append").parquet(path)


def _same(spark, index, table, keywords, literal=False, most=None, columns=None):
    files = index.files_for(keywords, literal)
    assert most is None or len(files) <= most, (keywords, len(files))
    want = rows(search(spark.read.parquet(table), keywords, columns, literal))
    got = index.search(keywords, columns, literal)
    assert rows(got) == want
    assert len({r["f"] for r in got.select(F.col("_metadata.file_path").alias("f")).distinct().collect()} if files else []) <= len(files)
    return len(want)


def test_the_rows_of_a_scan_from_few_files(spark, tmp_dir):
    _table(spark, tmp_dir + "/plain")
    index = FileIndex(spark, tmp_dir + "/plain", tmp_dir + "/index")
    assert index.refresh() == 20 and index.refresh() == 0
    table = tmp_dir + "/plain"
    one = spark.read.parquet(table).where("id = 1234").first()["n"]
    assert _same(spark, index, table, [one[5:40]], most=1) == 200
    assert _same(spark, index, table, [one[5:25] + "%" + one[40:]], most=1) == 200
    assert _same(spark, index, table, ["50%\\_1234", "1970-02-03"], most=12) > 0
    assert _same(spark, index, table, ["50%_1234"], literal=True, most=6) == 1
    assert _same(spark, index, table, ["no such name at all"], most=0) == 0
    assert _same(spark, index, table, ["7"]) > 0  # too short for a trigram: all files
    assert len(index.files_for(["7"])) == 20 and len(index.files_for(["%_%"])) == 20
    assert _same(spark, index, table, [one[5:40]], columns=["note"], most=1) == 0


def test_new_and_changed_files_are_read_until_they_are_sketched(spark, tmp_dir):
    table = tmp_dir + "/plain"
    _table(spark, table, files=4)
    index = FileIndex(spark, table, tmp_dir + "/index")
    kw = [spark.read.parquet(table).where("id = 1").first()["n"][5:40]]
    assert _same(spark, index, table, kw, most=4) == 200  # nothing sketched yet: all of them
    index.refresh()
    _table(spark, table, 0, 200, files=1)
    assert len(index.files_for(kw)) == 2
    assert _same(spark, index, table, kw) == 400
    assert index.refresh() == 1
    _table(spark, table, 3800, 4000, files=1)
    assert index.refresh() == 1
    assert _same(spark, index, table, kw, most=2) == 400


def test_texts_of_another_zone_are_not_missed(spark, tmp_dir):
    table = tmp_dir + "/plain"
    _table(spark, table, 0, 100, files=2)
    index = FileIndex(spark, table, tmp_dir + "/index")
    index.refresh()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert _same(spark, index, table, ["1970-02-03 05:30:00"]) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_partitioned_and_empty_tables_and_refused_keywords(spark, tmp_dir):
    table = tmp_dir + "/parts"
    spark.range(60).select("id", (F.col("id") % 3).alias("p"), F.concat(F.lit("value"), "id").alias("v")).write.partitionBy(
        "p").parquet(table)
    index = FileIndex(spark, table, tmp_dir + "/index")
    index.refresh()
    assert _same(spark, index, table, ["value17", "ue23"]) == 2
    empty = tmp_dir + "/empty"
    spark.range(10).select("id").where("id < 0").write.parquet(empty)
    index = FileIndex(spark, empty, tmp_dir + "/index2")
    index.refresh()
    assert index.search(["abc"]).count() == 0
    for wrong in ("abc", [], [None]):
        with pytest.raises(ValueError):
            index.search(wrong)
