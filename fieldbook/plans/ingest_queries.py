"""Strain-ingest queries bound to the test tables.

Stand-in tables: the stored "strain" table is ``orders`` (id = o_orderkey,
payload columns, audit stamps from o_orderdate); batches are rows derived
from ``lineitem`` / ``orders`` with a ``seq`` giving their position.  Which
rows are stored and which come in is decided by order attributes (status,
year), never by id arithmetic; every row of the source tables flows through.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators import ingest
from fieldbook.operators.id_blocks import IdBlocks, leased_ids
from fieldbook.operators.ids import dense_ids
from fieldbook.operators.key_table import deal_keys, insert_new_dealt
from fieldbook.plans.tables import load, written_input
from fieldbook.session import scratch_path
from fieldbook.sources import io

KEYS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
PAYLOAD = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
RUN_TS = "2024-01-01 00:00:00"
NOW = "1998-01-01 00:00:00"


# Order of line items inside a batch: the whole row, which is unique
# ((l_orderkey, l_linenumber) alone is not).
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_SEQ_SQL = ("li AS (SELECT *, row_number() OVER (ORDER BY " + ", ".join(LINE_ORDER)
                + ") AS seq FROM lineitem)")
INSERT_SEQ_BASE = 10 ** 12


def lines(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Line items with ``seq`` = 1..n, their position in the batch.

    ``dense_ids`` writes the sorted rows once; the numbers are read off that.
    """
    return dense_ids(load(spark, sf, "lineitem"), LINE_ORDER, id_col="seq").select("seq", *cols)


def _stored(spark: SparkSession, sf: str, where: F.Column | None = None, with_key: bool = True) -> DataFrame:
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
             "o_orderpriority", "o_orderdate")
    if where is not None:
        o = o.where(where)
    cols = [F.col("o_orderkey").alias("id")] + ([F.col("o_orderkey")] if with_key else [])
    return o.select(
        *cols, *PAYLOAD,
        F.col("o_orderdate").cast("date").alias("created_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("last_updated_timestamp"),
    )


def _line_batch(spark: SparkSession, sf: str) -> DataFrame:
    """One batch row per line item carrying its order's payload (so an order's
    lines are in-batch duplicates); seq = position by (order, line)."""
    li = lines(spark, sf, "l_orderkey")
    o = load(spark, sf, "orders", *KEYS)
    b = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return b.select("seq", *KEYS)


_LINE_BATCH_SQL = LINE_SEQ_SQL + """,
b AS (SELECT seq, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
      FROM li JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT o_orderkey AS id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
      FROM orders WHERE o_orderstatus = 'F'),
r AS (SELECT b.*, row_number() OVER (PARTITION BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
                                     ORDER BY seq) AS rn,
             EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = b.o_orderkey AND s.o_custkey = b.o_custkey
                     AND s.o_orderstatus = b.o_orderstatus AND s.o_totalprice = b.o_totalprice
                     AND s.o_orderpriority = b.o_orderpriority) AS ex
      FROM b)"""


def q_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    """In-batch dedupe + strict existence on all key columns -> outcome per batch row."""
    stored = _stored(spark, sf, F.col("o_orderstatus") == "F")
    batch = _line_batch(spark, sf)
    _, out = ingest.insert_new(batch, stored, KEYS, "seq", RUN_TS)
    return out.select("seq", "o_orderkey", "outcome")


SQL_INSERT_NEW = "WITH " + _LINE_BATCH_SQL + """
SELECT seq, o_orderkey, CASE WHEN rn > 1 THEN 'duplicate' WHEN ex THEN 'exists' ELSE 'inserted' END AS outcome FROM r
"""


def q_insert_new_dealt(spark: SparkSession, sf: str) -> DataFrame:
    """The line batch against stored keys that were dealt once, then again after its new keys were dealt."""
    stored = _stored(spark, sf, F.col("o_orderstatus") == "F")
    table = deal_keys(stored, KEYS, scratch_path(spark, f"dealt-keys-{uuid.uuid4().hex}"))
    batch = _line_batch(spark, sf)
    new, first = insert_new_dealt(batch, table, "seq", RUN_TS)
    table.add(new)
    again = table.classify(batch, "seq")
    return first.select(F.lit(1).alias("round"), "seq", "o_orderkey", "outcome").unionByName(
        again.select(F.lit(2).alias("round"), "seq", "o_orderkey", "outcome"))


SQL_INSERT_NEW_DEALT = "WITH " + _LINE_BATCH_SQL + """
SELECT 1 AS round, seq, o_orderkey,
       CASE WHEN rn > 1 THEN 'duplicate' WHEN ex THEN 'exists' ELSE 'inserted' END AS outcome FROM r
UNION ALL SELECT 2, seq, o_orderkey, CASE WHEN rn > 1 THEN 'duplicate' ELSE 'exists' END FROM r
"""


def q_insert_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Inserted rows get ids continuing from max(stored id) in batch order, plus stamps."""
    stored = _stored(spark, sf, F.col("o_orderstatus") == "F")
    batch = _line_batch(spark, sf)
    new, _ = ingest.insert_new(batch, stored, KEYS, "seq", RUN_TS, with_ids=True)
    return new.select("seq", "id", "o_orderkey", "created_date", "last_updated_timestamp")


SQL_INSERT_IDS = "WITH " + _LINE_BATCH_SQL + """
SELECT seq, ((SELECT coalesce(max(id), 0) FROM s) + row_number() OVER (ORDER BY seq))::BIGINT AS id, o_orderkey,
       DATE '2024-01-01' AS created_date, TIMESTAMP '2024-01-01 00:00:00' AS last_updated_timestamp
FROM r WHERE rn = 1 AND NOT ex
"""


ID_BLOCK = 1000


def q_insert_ids_leased(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches that get ids from leased blocks above the stored ids, so other writers may insert meanwhile."""
    stored = _stored(spark, sf, F.col("o_orderstatus") == "F")
    blocks = IdBlocks(spark, scratch_path(spark, f"id-blocks-{uuid.uuid4().hex}"), ID_BLOCK)
    o = load(spark, sf, "orders", "o_orderkey", "o_orderstatus")
    new = [leased_ids(o.where(F.col("o_orderstatus") == status), ["o_orderkey"], blocks, stored=stored) for status in "OP"]
    return new[0].unionByName(new[1]).select("o_orderkey", "o_orderstatus", "id")


SQL_INSERT_IDS_LEASED = f"""
WITH b AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS place
           FROM orders WHERE o_orderstatus IN ('O', 'P')),
f AS (SELECT (coalesce(max(o_orderkey), 0) + {ID_BLOCK - 1}) // {ID_BLOCK} AS block FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT (count(*) + {ID_BLOCK - 1}) // {ID_BLOCK} AS blocks FROM b WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_orderstatus,
  ((block + CASE WHEN o_orderstatus = 'P' THEN blocks ELSE 0 END) * {ID_BLOCK} + place + 1)::BIGINT AS id FROM b, f, n
"""


def q_insert_all_or_nothing(spark: SparkSession, sf: str) -> DataFrame:
    """Batches by order year; a batch with any stored row is rejected whole."""
    stored = _stored(spark, sf, (F.col("o_orderstatus") == "F") & (F.year("o_orderdate") < 1998))
    o = load(spark, sf, "orders", *KEYS, "o_orderdate")
    batch = o.select(F.year("o_orderdate").alias("batch_id"), F.col("o_orderkey").alias("seq"), *KEYS)
    new, gated = ingest.insert_all_or_nothing(batch, stored, KEYS, "seq", RUN_TS, batch_col="batch_id")
    ids = new.select("seq", "id")
    return gated.join(ids, "seq", "left").select("o_orderkey", "batch_id", "outcome", "id")


SQL_INSERT_ALL_OR_NOTHING = """
WITH b AS (SELECT year(o_orderdate)::INT AS batch_id, o_orderkey AS seq, o_orderkey, o_custkey, o_orderstatus,
                  o_totalprice, o_orderpriority FROM orders),
s AS (SELECT o_orderkey AS id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
      FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) < 1998),
m AS (SELECT b.*, EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = b.o_orderkey AND s.o_custkey = b.o_custkey
                  AND s.o_orderstatus = b.o_orderstatus AND s.o_totalprice = b.o_totalprice
                  AND s.o_orderpriority = b.o_orderpriority) AS ex FROM b),
v AS (SELECT batch_id, bool_or(ex) AS dirty FROM m GROUP BY batch_id),
g AS (SELECT m.*, CASE WHEN v.dirty THEN 'rejected' ELSE 'inserted' END AS outcome FROM m JOIN v USING (batch_id))
SELECT o_orderkey, batch_id, outcome,
  CASE WHEN outcome = 'inserted' THEN
    ((SELECT coalesce(max(id), 0) FROM s) + row_number() OVER (PARTITION BY outcome ORDER BY batch_id, seq))::BIGINT
  END AS id
FROM g
"""


def _upsert_inputs(spark: SparkSession, sf: str):
    stored = _stored(spark, sf, F.col("o_orderstatus") != "P", with_key=False)
    li = lines(spark, sf, "l_orderkey", "l_extendedprice", "l_linestatus", "l_returnflag")
    updates = li.select(
        "seq",
        F.create_map(
            F.lit("id"), F.col("l_orderkey").cast("string"),
            F.lit("o_totalprice"), F.col("l_extendedprice").cast("string"),
            F.lit("o_orderpriority"), F.col("l_linestatus"),
        ).alias("fields"),
    )
    o = load(spark, sf, "orders", *KEYS)
    inserts = o.where(
        (F.col("o_orderstatus") == "P") | ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    ).select(
        (F.col("o_orderkey") + INSERT_SEQ_BASE).alias("seq"),
        F.create_map(*[x for c in PAYLOAD for x in (F.lit(c), F.col(c).cast("string"))]).alias("fields"),
    )
    return stored, updates.unionByName(inserts)


def q_upsert_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Three-way batch: guarded partial updates by id, skip existing, insert new with ids."""
    stored, batch = _upsert_inputs(spark, sf)
    _, out = ingest.upsert(stored, batch, PAYLOAD, NOW)
    return out


def q_upsert_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The table after the three-way batch: updated fields and stamps, inserted rows appended."""
    stored, batch = _upsert_inputs(spark, sf)
    tbl, _ = ingest.upsert(stored, batch, PAYLOAD, NOW)
    return tbl


_UPSERT_SQL = "WITH " + LINE_SEQ_SQL + """,
s AS (SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
                  o_orderdate::DATE AS created_date, o_orderdate AS last_updated_timestamp
           FROM orders WHERE o_orderstatus <> 'P'),
u AS (SELECT seq, l_orderkey AS id, l_extendedprice AS o_totalprice,
             l_linestatus AS o_orderpriority FROM li),
uw AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM u),
uo AS (SELECT uw.seq, uw.id,
         CASE WHEN rn > 1 THEN 'duplicate' WHEN s.id IS NULL THEN 'unknown_id'
              WHEN NOT (s.last_updated_timestamp < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 13 MINUTE) THEN 'guarded'
              ELSE 'updated' END AS outcome
       FROM uw LEFT JOIN s ON s.id = uw.id),
i AS (SELECT 1000000000000 + o_orderkey AS seq, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
      WHERE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')),
ie AS (SELECT i.*, EXISTS (SELECT 1 FROM s WHERE s.o_custkey = i.o_custkey AND s.o_orderstatus = i.o_orderstatus
                   AND s.o_totalprice = i.o_totalprice AND s.o_orderpriority = i.o_orderpriority) AS ex FROM i),
io AS (SELECT ie.*, CASE WHEN ex THEN NULL
              ELSE ((SELECT coalesce(max(id), 0) FROM s) + row_number() OVER (PARTITION BY ex ORDER BY seq))::BIGINT
              END AS id,
              CASE WHEN ex THEN 'exists' ELSE 'inserted' END AS outcome FROM ie),
w AS (SELECT uo.id, u.o_totalprice, u.o_orderpriority FROM uo JOIN u ON u.seq = uo.seq WHERE uo.outcome = 'updated')
"""

SQL_UPSERT_OUTCOMES = _UPSERT_SQL + """
SELECT seq, id, outcome FROM uo UNION ALL SELECT seq, id, outcome FROM io
"""

SQL_UPSERT_SNAPSHOT = _UPSERT_SQL + """
SELECT s.id, s.o_custkey, s.o_orderstatus, coalesce(w.o_totalprice, s.o_totalprice) AS o_totalprice,
       coalesce(w.o_orderpriority, s.o_orderpriority) AS o_orderpriority, s.created_date,
       CASE WHEN w.id IS NOT NULL THEN TIMESTAMP '1998-01-01 00:00:00' ELSE s.last_updated_timestamp END
         AS last_updated_timestamp
FROM s LEFT JOIN w ON w.id = s.id
UNION ALL
SELECT id, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, DATE '1998-01-01',
       TIMESTAMP '1998-01-01 00:00:00' FROM io WHERE outcome = 'inserted'
"""


def q_json_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Partial updates read from JSON-lines files with key presence (A4 + G5 + Q11).

    Stand-in files: one folder of lines per return flag, an object per line
    item that sets ``o_totalprice`` and ``o_orderpriority`` of its order, the
    priority given as an explicit JSON null for open lines.  An explicit null
    is an ``error`` (row unchanged), as in the reference where the UPDATE
    fails.  The batch position rides along as ``seq``, since which file a
    line lands in is Spark's choice.
    """
    li = lines(spark, sf, "l_orderkey", "l_extendedprice", "l_linestatus", "l_returnflag")
    text = F.to_json(F.struct(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_extendedprice").cast("string").alias("o_totalprice"),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("o_orderpriority"),
        F.col("seq"),
    ), {"ignoreNullFields": "false"})
    base = scratch_path(spark, f"json-updates-{uuid.uuid4().hex}")
    li.select(F.col("l_returnflag").alias("flag"), text.alias("value")).write.partitionBy("flag").text(base)
    batch = io.read_json_maps(spark, base, seq_col="read_seq", multiline=False)
    f = F.col("fields")
    updates = batch.select(f["seq"].cast("long").alias("seq"), f["id"].try_cast("long").alias("id"),
                           F.map_filter("fields", lambda k, v: ~k.isin("id", "seq")).alias("fields"))
    stored = _stored(spark, sf, F.col("o_orderstatus") != "P", with_key=False)
    _, out = ingest.apply_updates(stored, updates, NOW)
    return out.select("seq", "id", "outcome")


SQL_JSON_UPDATES = "WITH " + LINE_SEQ_SQL + """,
b AS (SELECT seq, l_orderkey AS id, l_linestatus = 'O' AS has_null FROM li),
bw AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM b),
s AS (SELECT o_orderkey AS id, o_orderdate AS ts FROM orders WHERE o_orderstatus <> 'P')
SELECT bw.seq, bw.id,
  CASE WHEN rn > 1 THEN 'duplicate' WHEN s.id IS NULL THEN 'unknown_id' WHEN has_null THEN 'error'
       WHEN NOT (s.ts < TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 13 MINUTE) THEN 'guarded'
       ELSE 'updated' END AS outcome
FROM bw LEFT JOIN s ON s.id = bw.id
"""


def q_json_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines, some torn, some with a value that does not fit: rows read and rejects, none lost (A4).

    Stand-in file: one object per order; lines of 5-LOW orders end before
    their closing brace, those of open 4-NOT SPECIFIED ones give text for the key.
    """
    o = load(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    key = F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "O"),
                 F.concat(F.lit('"K'), F.col("o_orderkey"), F.lit('"'))).otherwise(F.col("o_orderkey").cast("string"))
    end = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.lit('"}'))
    text = F.concat(F.lit('{"o_orderkey": '), key, F.lit(', "o_orderstatus": "'), F.col("o_orderstatus"), end)
    base = scratch_path(spark, f"json-rejects-{uuid.uuid4().hex}")
    o.select(text.alias("value")).write.text(base)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    good = io.read_json_batch(spark, base, schema, on_bad="skip").withColumn("record", F.lit(None).cast("string"))
    bad = io.json_rejects(spark, base, schema).select("record")
    return good.unionByName(bad, allowMissingColumns=True)


SQL_JSON_REJECTS = """
WITH l AS (SELECT o_orderkey, o_orderstatus, o_orderpriority = '5-LOW' AS torn,
                  o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' AS unfit FROM orders)
SELECT CASE WHEN NOT (torn OR unfit) THEN o_orderkey END AS o_orderkey,
       CASE WHEN NOT (torn OR unfit) THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN torn OR unfit THEN '{"o_orderkey": ' || CASE WHEN unfit THEN '"K' || o_orderkey || '"'
            ELSE o_orderkey::VARCHAR END || ', "o_orderstatus": "' || o_orderstatus
            || CASE WHEN torn THEN '' ELSE '"}' END END AS record
FROM l
"""


def q_flatten_formulation(spark: SparkSession, sf: str) -> DataFrame:
    """Nested payload (order + array of line structs) flattened to one row per element."""
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    el = F.when(F.col("l_orderkey").isNotNull(),
                F.struct(F.col("l_linenumber").alias("l_linenumber"), F.col("l_quantity").alias("l_quantity")))
    nested = (
        o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
        .groupBy("o_orderkey", "o_custkey", "o_orderstatus")
        .agg(F.collect_list(el).alias("formulation"))
    )
    return ingest.flatten(nested, "formulation")


SQL_FLATTEN_FORMULATION = """
SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber, l_quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
"""


def q_loose_exists(spark: SparkSession, sf: str) -> DataFrame:
    """Column-agnostic membership (D7): line (linenumber, quantity) pairs against nation (key, region)."""
    li = lines(spark, sf, "l_linenumber", "l_quantity")
    batch = li.select(
        F.col("seq").alias("row_id"),
        F.col("l_linenumber").cast("string").alias("n_nationkey"),
        F.col("l_quantity").cast("int").cast("string").alias("n_regionkey"),
    )
    nation = load(spark, sf, "nation", "n_nationkey", "n_regionkey")
    return ingest.loose_exists(batch, nation, "row_id").select("row_id", "present")


SQL_LOOSE_EXISTS = "WITH " + LINE_SEQ_SQL + """,
b AS (SELECT seq AS row_id, l_linenumber::VARCHAR AS a,
                  trunc(l_quantity)::INT::VARCHAR AS c FROM li),
s AS (SELECT DISTINCT n_nationkey::VARCHAR AS nk, n_regionkey::VARCHAR AS rk FROM nation)
SELECT row_id, EXISTS (SELECT 1 FROM s WHERE s.nk IN (b.a, b.c) AND s.rk IN (b.a, b.c)) AS present FROM b
"""


def q_loose_exists_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Column-agnostic membership against a large table of few-valued columns (D7): lines against all orders."""
    li = lines(spark, sf, "l_orderkey", "l_linestatus", "l_linenumber")
    batch = li.select(F.col("seq").alias("row_id"), F.col("l_linenumber").cast("string").alias("k"),
                      F.col("l_linestatus").alias("s"), F.col("l_orderkey").cast("string").alias("p"))
    o = load(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    stored = o.select(F.col("o_orderkey").cast("string").alias("k"), F.col("o_orderstatus").alias("s"),
                      F.substring("o_orderpriority", 1, 1).alias("p"))
    return ingest.loose_exists(batch, stored, "row_id").select("row_id", "present")


SQL_LOOSE_EXISTS_ORDERS = "WITH " + LINE_SEQ_SQL + """,
b AS (SELECT seq AS row_id, l_linenumber::VARCHAR AS k, l_linestatus AS s, l_orderkey::VARCHAR AS p FROM li),
o AS (SELECT o_orderkey::VARCHAR AS k, o_orderstatus AS s, o_orderpriority[1] AS p FROM orders),
hits AS (SELECT row_id FROM b JOIN o ON o.k = b.k AND o.s = b.s AND o.p IN (b.k, b.p)
         UNION SELECT row_id FROM b JOIN o ON o.k = b.p AND o.s = b.s AND o.p IN (b.k, b.p))
SELECT row_id, row_id IN (SELECT row_id FROM hits) AS present FROM b
"""


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("int").cast("string")


def q_loose_exists_few_values(spark: SparkSession, sf: str) -> DataFrame:
    """Column-agnostic membership where every column has few values (D7): all lines against those shipped on 1 March."""
    li = lines(spark, sf, "l_linenumber", "l_quantity", "l_discount", "l_tax")
    quantity = F.col("l_quantity").cast("int").cast("string")
    batch = li.select(F.col("seq").alias("row_id"), F.col("l_linenumber").cast("string").alias("a"),
                      quantity.alias("b"), _cents("l_discount").alias("c"), _cents("l_tax").alias("d"))
    stored = load(spark, sf, "lineitem", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate").where(
        (F.month("l_shipdate") == 3) & (F.dayofmonth("l_shipdate") == 1)).select(
        quantity.alias("a"), _cents("l_tax").alias("b"), F.col("l_linenumber").cast("string").alias("c"),
        _cents("l_discount").alias("d"))
    return ingest.loose_exists(batch, stored, "row_id").select("row_id", "present")


SQL_LOOSE_EXISTS_FEW_VALUES = "WITH " + LINE_SEQ_SQL + """,
v AS (SELECT seq AS row_id, list_sort(list_distinct([l_linenumber::VARCHAR, trunc(l_quantity)::INT::VARCHAR,
             round(l_discount * 100)::INT::VARCHAR, round(l_tax * 100)::INT::VARCHAR])) AS vals FROM li),
s AS (SELECT DISTINCT list_sort(list_distinct([trunc(l_quantity)::INT::VARCHAR, round(l_tax * 100)::INT::VARCHAR,
             l_linenumber::VARCHAR, round(l_discount * 100)::INT::VARCHAR])) AS t
      FROM lineitem WHERE month(l_shipdate) = 3 AND day(l_shipdate) = 1),
d AS (SELECT DISTINCT vals FROM v),
parts AS (SELECT vals, list_sort(list_distinct([x1, x2, x3, x4])) AS t
          FROM (SELECT vals, unnest(vals) AS x1 FROM d) JOIN (SELECT vals, unnest(vals) AS x2 FROM d) USING (vals)
          JOIN (SELECT vals, unnest(vals) AS x3 FROM d) USING (vals) JOIN (SELECT vals, unnest(vals) AS x4 FROM d) USING (vals)),
hits AS (SELECT DISTINCT vals FROM parts JOIN s USING (t))
SELECT row_id, vals IN (SELECT vals FROM hits) AS present FROM v
"""


def q_add_rows_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Add batch rows that are not loosely present, restamp every row (G6: D7 + F3 + B8)."""
    li = lines(spark, sf, "l_linenumber", "l_quantity")
    batch = li.select(
        F.col("seq").alias("row_id"),
        F.col("l_linenumber").cast("string").alias("n_nationkey"),
        F.col("l_quantity").cast("int").cast("string").alias("n_regionkey"),
    )
    nation = load(spark, sf, "nation", "n_nationkey", "n_regionkey").select(
        F.col("n_nationkey").cast("string").alias("n_nationkey"),
        F.col("n_regionkey").cast("string").alias("n_regionkey"))
    return ingest.add_rows_replace(nation, batch, "row_id", RUN_TS)


SQL_ADD_ROWS_REPLACE = "WITH " + LINE_SEQ_SQL + """,
b AS (SELECT seq AS row_id, l_linenumber::VARCHAR AS a, trunc(l_quantity)::INT::VARCHAR AS c FROM li),
s AS (SELECT DISTINCT n_nationkey::VARCHAR AS nk, n_regionkey::VARCHAR AS rk FROM nation)
SELECT n_nationkey::VARCHAR AS n_nationkey, n_regionkey::VARCHAR AS n_regionkey, DATE '2024-01-01' AS created_date,
       TIMESTAMP '2024-01-01 00:00:00' AS last_updated_timestamp FROM nation
UNION ALL
SELECT a, c, DATE '2024-01-01', TIMESTAMP '2024-01-01 00:00:00' FROM b
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.nk IN (b.a, b.c) AND s.rk IN (b.a, b.c))
"""


def q_json_batch_insert(spark: SparkSession, sf: str) -> DataFrame:
    """JSON-lines batch read with its read order (A4), then insert-new against the stored table.

    Stand-in batch: all orders plus a second copy of the urgent ones, written
    as JSON lines into a fresh folder under the checkpoint folder.
    """
    from pyspark.sql import types as T
    import uuid
    from fieldbook.session import scratch_path
    from fieldbook.sources import io

    o = load(spark, sf, "orders", *KEYS)
    base = scratch_path(spark, f"json-batch-{uuid.uuid4().hex}")
    o.write.mode("overwrite").json(f"{base}/part1")
    o.where(F.col("o_orderpriority") == "1-URGENT").write.mode("overwrite").json(f"{base}/part2")
    schema = T.StructType([o.schema[k] for k in KEYS])
    batch = io.read_json_batch(spark, f"{base}/part*", schema, seq_col="seq")
    stored = _stored(spark, sf, F.col("o_orderstatus") == "F")
    _, out = ingest.insert_new(batch, stored, KEYS, "seq", RUN_TS)
    return out.select("o_orderkey", "outcome")


SQL_JSON_BATCH_INSERT = """
WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 0 AS copy FROM orders
           UNION ALL
           SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 1 FROM orders
           WHERE o_orderpriority = '1-URGENT'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey,
  CASE WHEN copy = 1 THEN 'duplicate'
       WHEN EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = b.o_orderkey AND s.o_custkey = b.o_custkey
                    AND s.o_orderstatus = b.o_orderstatus AND s.o_totalprice = b.o_totalprice
                    AND s.o_orderpriority = b.o_orderpriority) THEN 'exists'
       ELSE 'inserted' END AS outcome
FROM b
"""


def q_row_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-row difference (D8): customers not in the table of customers with an urgent order."""
    c = load(spark, sf, "customer")
    o = load(spark, sf, "orders", "o_custkey", "o_orderpriority").where(F.col("o_orderpriority") == "1-URGENT")
    table = c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi")
    return ingest.row_difference(c, table)


SQL_ROW_DIFFERENCE = """
SELECT * FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
"""


def q_row_difference_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-row difference of wide rows by their fingerprints (D8): documents not in the table of English documents."""
    d = load(spark, sf, "documents")
    return ingest.row_difference_wide(d, d.where(F.col("lang") == "en")).select("doc_id", "lang", "source", "n_chars")


SQL_ROW_DIFFERENCE_WIDE = """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents t WHERE t.lang = 'en' AND t.doc_id IS NOT DISTINCT FROM d.doc_id
                  AND t.text IS NOT DISTINCT FROM d.text AND t.lang IS NOT DISTINCT FROM d.lang
                  AND t.source IS NOT DISTINCT FROM d.source AND t.n_chars IS NOT DISTINCT FROM d.n_chars)
"""


def q_stamp_given(spark: SparkSession, sf: str) -> DataFrame:
    """Fields unknown to the table are dropped (B3); stamps that a record carries are kept, the others set."""
    o = load(spark, sf, "orders", *KEYS, "o_orderdate")
    carried = F.col("o_orderstatus") == "F"
    batch = o.select(
        *KEYS, F.length("o_orderpriority").alias("remark"), F.col("o_orderdate").alias("shelf"),
        F.when(carried, F.col("o_orderdate").cast("date")).alias("created_date"),
        F.when(carried & (F.col("o_orderpriority") == "1-URGENT"), F.col("o_orderdate").cast("timestamp_ntz"))
        .alias("last_updated_timestamp"))
    table = _stored(spark, sf)
    return ingest.stamp(ingest.keep_known(batch, table.columns), RUN_TS, keep_given=True)


SQL_STAMP_GIVEN = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE ELSE DATE '2024-01-01' END AS created_date,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_orderdate::TIMESTAMP
       ELSE TIMESTAMP '2024-01-01 00:00:00' END AS last_updated_timestamp
FROM orders
"""


def q_stamp_now(spark: SparkSession, sf: str) -> DataFrame:
    """Rows stamped with the wall clock of Asia/Kolkata; told as facts, since every run has its own time."""
    wall = _dt.datetime.now(ZoneInfo(ingest.DEFAULT_ZONE)).strftime("%Y-%m-%d %H:%M:%S")
    rows = ingest.stamp(load(spark, sf, "orders", "o_orderkey"), None)
    off = F.timestamp_diff("SECOND", F.lit(wall).cast("timestamp_ntz"), F.col("last_updated_timestamp"))
    return rows.select("o_orderkey", (F.col("created_date") == F.col("last_updated_timestamp").cast("date")).alias("one_day"),
                       F.abs(off).between(0, 1200).alias("on_time"))


SQL_STAMP_NOW = "SELECT o_orderkey, true AS one_day, true AS on_time FROM orders"


def q_gate_one_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Two single batches, one with stored rows and one without: any stored row rejects the whole batch."""
    stored = _stored(spark, sf, F.col("o_orderstatus") == "F")
    o = load(spark, sf, "orders", *KEYS)
    batches = {"all": o, "open": o.where(F.col("o_orderstatus") == "O")}
    gated = [ingest.gate_all(rows, stored, KEYS).select("o_orderkey", F.lit(name).alias("batch"), "outcome")
             for name, rows in batches.items()]
    return gated[0].unionByName(gated[1])


SQL_GATE_ONE_BATCH = """
SELECT o_orderkey, 'all' AS batch,
       CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F') THEN 'rejected' ELSE 'inserted' END AS outcome FROM orders
UNION ALL SELECT o_orderkey, 'open', 'inserted' FROM orders WHERE o_orderstatus = 'O'
"""


QUERIES = {
    "stamp_given": (q_stamp_given, SQL_STAMP_GIVEN),
    "stamp_now": (q_stamp_now, SQL_STAMP_NOW),
    "gate_one_batch": (q_gate_one_batch, SQL_GATE_ONE_BATCH),
    "insert_new": (q_insert_new, SQL_INSERT_NEW),
    "insert_ids_leased": (q_insert_ids_leased, SQL_INSERT_IDS_LEASED),
    "row_difference_wide": (q_row_difference_wide, SQL_ROW_DIFFERENCE_WIDE),
    "insert_new_dealt": (q_insert_new_dealt, SQL_INSERT_NEW_DEALT),
    "insert_ids": (q_insert_ids, SQL_INSERT_IDS),
    "insert_all_or_nothing": (q_insert_all_or_nothing, SQL_INSERT_ALL_OR_NOTHING),
    "upsert_outcomes": (q_upsert_outcomes, SQL_UPSERT_OUTCOMES),
    "upsert_snapshot": (q_upsert_snapshot, SQL_UPSERT_SNAPSHOT),
    "flatten_formulation": (q_flatten_formulation, SQL_FLATTEN_FORMULATION),
    "loose_exists": (q_loose_exists, SQL_LOOSE_EXISTS),
    "row_difference": (q_row_difference, SQL_ROW_DIFFERENCE),
    "loose_exists_few_values": (q_loose_exists_few_values, SQL_LOOSE_EXISTS_FEW_VALUES),
    "loose_exists_orders": (q_loose_exists_orders, SQL_LOOSE_EXISTS_ORDERS),
    "add_rows_replace": (q_add_rows_replace, SQL_ADD_ROWS_REPLACE),
    "json_batch_insert": (q_json_batch_insert, SQL_JSON_BATCH_INSERT),
    "json_rejects": (q_json_rejects, SQL_JSON_REJECTS),
    "json_updates": (q_json_updates, SQL_JSON_UPDATES),
}
