"""Whole-row difference by fingerprints: the rows of the plain difference, for any values."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldbook.operators.ingest import row_difference, row_difference_wide

SCHEMA = "a string, b double, c array<string>, d timestamp"
CELLS = list(product([None, "", "x"], [None, 0.0, -0.0, float("nan"), 1.5], [None, [], ["x"], [None]], [None]))


@pytest.mark.parametrize("step", [1, 2, 7])
def test_equals_the_plain_difference(spark, step):
    batch, table = spark.createDataFrame(CELLS * 2, SCHEMA), spark.createDataFrame(CELLS[::step] * 2, SCHEMA)
    for left, right in ((batch, table), (table, batch), (batch, table.limit(0)), (batch.limit(0), table)):
        assert str(rows(row_difference_wide(left, right))) == str(rows(row_difference(left, right)))


def test_types_that_differ_columns_that_are_not_shared_and_repeats(spark):
    batch = spark.createDataFrame([(1, "x", 7), (1, "x", 8), (2, "x", 7), (None, "x", 7), (3, None, 7)], "k int, v string, more int")
    table = spark.createDataFrame([(1, "x", "o"), (None, "x", "o"), (1, "x", "o"), (3, "z", "o")], "k long, v string, other string")
    assert rows(row_difference_wide(batch, table)) == rows(row_difference(batch, table)) == [(2, "x", 7), (3, None, 7)]
    with pytest.raises(ValueError, match="cast"):
        row_difference_wide(batch.select("k"), table.select("k"))


def test_only_rows_that_may_be_equal_leave_the_table(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.range(4000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("text"))
        batch = spark.range(3990, 4090).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("text"))
        out = row_difference_wide(batch, table)
        assert rows(out, "id") == [(i,) for i in range(4000, 4090)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
