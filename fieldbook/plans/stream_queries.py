"""Streaming ingest bound to the test tables.

Stand-in input: ``events`` written as two JSON-lines drops into a fresh
folder under the shared checkpoint folder (drop 1: click and view events,
drop 2: all events, so it overlaps drop 1).  The stream runs once per drop
(``availableNow``) with one checkpoint; the result is the target table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.plans.tables import load
from fieldbook.session import scratch_path
from fieldbook.streaming.ingest_stream import read_ingested, start_ingest

EVENT_TABLE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("created_date", T.DateType()),
    T.StructField("last_updated_timestamp", T.TimestampNTZType()),
])
EVENT_KEYS = ["event_id", "user_id", "event_type", "value"]


def run_stream_insert(spark: SparkSession, sf: str) -> str:
    """Run the two drops through the stream; returns the table folder."""
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    ev = load(spark, sf, "events", *EVENT_KEYS)
    drops = [ev.where(F.col("event_type").isin("click", "view")), ev]
    for i, drop in enumerate(drops, 1):
        drop.write.mode("overwrite").json(f"{base}/src/drop{i}")
        q = start_ingest(spark, f"{base}/src", f"{base}/table", f"{base}/checkpoint", EVENT_KEYS, EVENT_TABLE,
                         mode="insert", run_ts="2024-01-01 00:00:00")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return f"{base}/table"


def q_stream_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Drop-folder stream with in-batch dedupe, existence check and ids per micro-batch (S1 + G3)."""
    table = run_stream_insert(spark, sf)
    got = read_ingested(spark, table)
    # with these the ids are seen to be 1..n without gap or repeat
    facts = {"first_id": F.min("id"), "last_id": F.max("id"), "n_ids": F.count_distinct("id")}
    return got.select(*[c for c in got.columns if c != "id"],
                      *[got.agg(f.alias(name)).scalar().alias(name) for name, f in facts.items()])


SQL_STREAM_INSERT = """
WITH e AS (SELECT DISTINCT event_id, user_id, event_type, value FROM events)
SELECT e.*, DATE '2024-01-01' AS created_date, TIMESTAMP '2024-01-01 00:00:00' AS last_updated_timestamp,
       1::BIGINT AS first_id, n AS last_id, n AS n_ids FROM e, (SELECT count(*) AS n FROM e)
"""

ORDER_TABLE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType()),
    T.StructField("created_date", T.DateType()),
    T.StructField("last_updated_timestamp", T.TimestampNTZType()),
])
ORDER_KEYS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def q_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Drop-folder stream in upsert mode (S1 + G4/G5), two micro-batches.

    Drop 1: finished orders as insert records.  Drop 2, derived by Spark from
    the table after drop 1: a partial update (new priority) for every urgent
    row by its id, plus all other orders as insert records.  No age guard, since
    both batches carry the same run time.  Output: the final table without
    its generated ids and stamps.
    """
    base = scratch_path(spark, f"stream-upsert-{uuid.uuid4().hex}")
    o = load(spark, sf, "orders", *ORDER_KEYS)

    def run():
        q = start_ingest(spark, f"{base}/src", f"{base}/table", f"{base}/checkpoint", ORDER_KEYS, ORDER_TABLE,
                         mode="upsert", run_ts="2024-01-01 00:00:00", min_age=None)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    as_text = [F.col(c).cast("string").alias(c) for c in ORDER_KEYS]
    o.where(F.col("o_orderstatus") == "F").select(*as_text).write.mode("overwrite").json(f"{base}/src/drop1")
    run()
    after1 = read_ingested(spark, f"{base}/table")
    updates = after1.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("id").cast("string").alias("id"), F.lit("1-URGENT-REVIEWED").alias("o_orderpriority"))
    inserts = o.where(F.col("o_orderstatus") != "F").select(*as_text)
    updates.unionByName(inserts, allowMissingColumns=True).write.mode("overwrite").json(f"{base}/src/drop2")
    run()
    return read_ingested(spark, f"{base}/table").select(*ORDER_KEYS)


SQL_STREAM_UPSERT = """
SELECT o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '1-URGENT-REVIEWED' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
"""

QUERIES = {
    "stream_insert": (q_stream_insert, SQL_STREAM_INSERT),
    "stream_upsert": (q_stream_upsert, SQL_STREAM_UPSERT),
}
