"""Stored keys dealt once: outcomes as without them, no exchange of the stored side, hot keys, reopening."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldbook.operators import ingest
from fieldbook.operators.key_table import deal_keys, insert_new_dealt, open_keys

SCHEMA = "seq long, a string, b double, t timestamp"


def _batch(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], SCHEMA.replace("t timestamp", "t string")).withColumn(
        "t", F.col("t").cast("timestamp"))


def _data(spark):
    stored = _batch(spark, [("x", 1.0, "2020-01-01 00:00:00"), ("x", 0.0, None), ("n", 2.0, "2020-01-01 00:00:00"),
                            ("x", 1.0, "2020-01-01 00:00:00"), ("", 3.0, "2021-01-01 00:00:00"), (None, 1.0, None)])
    batch = _batch(spark, [("x", 1.0, "2020-01-01 00:00:00"), ("x", -0.0, None), ("n", 2.0, "2020-01-01 00:00:00"),
                           ("y", 1.0, None), ("y", 1.0, None), (None, 1.0, None), ("", 3.0, "2021-01-01 00:00:00"),
                           ("1:x", 1.0, None), ("x", None, "2020-01-01 00:00:00")])
    return stored, batch


@pytest.mark.parametrize("null_safe", [False, True])
def test_outcomes_equal_those_against_the_table(spark, tmp_dir, null_safe):
    stored, batch = _data(spark)
    keys = ["a", "b", "t"]
    table = deal_keys(stored, keys, tmp_dir + "/keys", buckets=3)
    assert table.rows().count() == 5
    want = rows(ingest.classify_new(batch, stored, keys, "seq", null_safe), "seq", "outcome")
    assert rows(table.classify(batch, "seq", null_safe), "seq", "outcome") == want


def test_added_keys_are_found_by_a_reopened_table_and_a_replay_adds_none(spark, tmp_dir):
    stored, batch = _data(spark)
    table = deal_keys(stored, ["a", "b", "t"], tmp_dir + "/keys", buckets=3)
    new, labelled = insert_new_dealt(batch, table, "seq", "2024-01-01 00:00:00", null_safe=True)
    before = rows(labelled, "seq", "outcome")
    table.add(new)
    table.add(new)
    assert rows(labelled, "seq", "outcome") == before
    spark.sql(f"DROP TABLE {table.name}")  # as in another session: the files stay
    again = open_keys(spark, tmp_dir + "/keys")
    assert again.rows().count() == 5 + new.count()
    assert {o for _, o in rows(again.classify(batch, "seq", True), "seq", "outcome")} == {"exists", "duplicate"}


def test_the_stored_side_is_not_exchanged(spark, tmp_dir):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = spark.range(20000).select(F.col("id").alias("k"))
        batch = spark.range(15000, 25000).select(F.col("id").alias("seq"), F.col("id").alias("k"))
        for buckets in (5, 16):  # fewer and more than the session's shuffle partitions
            table = deal_keys(stored, ["k"], f"{tmp_dir}/keys{buckets}", buckets)
            out = table.classify(batch, "seq")
            plan = out._jdf.queryExecution().executedPlan().toString()
            scan = next(i for i, line in enumerate(plan.split("\n")) if table.name in line)
            lines = plan.split("\n")
            depth = lines[scan].index("FileScan")
            for line in reversed(lines[:scan]):  # from the scan up to the join that it enters
                text = line.lstrip(" :+-")
                at = len(line) - len(text)
                if at < depth:
                    depth = at
                    assert "Exchange" not in text, plan
                    if "Join" in text:
                        break
            else:
                raise AssertionError(plan)
            assert out.groupBy("outcome").count().count() == 2
            assert out.where("outcome = 'exists'").count() == 5000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_hot_key_is_one_row(spark, tmp_dir):
    hot = F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id"))
    stored = spark.range(30000).select(hot.alias("k"))
    table = deal_keys(stored, ["k"], tmp_dir + "/keys", 4)
    assert table.rows().count() == 10001
    batch = spark.range(30000).select(F.col("id").alias("seq"), hot.alias("k"))
    assert {r["outcome"]: r["count"] for r in table.classify(batch, "seq").groupBy("outcome").count().collect()} == {
        "exists": 10001, "duplicate": 19999}


def test_empty_tables_and_refused_keys(spark, tmp_dir):
    stored, batch = _data(spark)
    table = deal_keys(stored.limit(0), ["a", "b"], tmp_dir + "/none", 3)
    assert {o for _, o in rows(table.classify(batch, "seq"), "seq", "outcome")} == {"inserted", "duplicate"}
    assert table.classify(batch.limit(0), "seq").count() == 0
    table.add(batch.limit(0))
    with pytest.raises(ValueError, match="cast it first"):
        table.classify(batch.withColumn("b", F.col("b").cast("float")), "seq")
    with pytest.raises(ValueError, match="not empty"):
        deal_keys(stored, ["a"], tmp_dir + "/none")
    with pytest.raises(ValueError, match="plain values"):
        deal_keys(stored.select(F.array("a").alias("k")), ["k"], tmp_dir + "/arrays")
    with pytest.raises(ValueError, match="no finished"):
        open_keys(spark, tmp_dir + "/missing")
