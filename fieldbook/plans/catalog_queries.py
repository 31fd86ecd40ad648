"""Catalogue queries bound to the driver's test tables.

Stand-in input: a raw document per order whose comma lists are the order's
part brands (``Product_names``, ", " separated), part types (``crop``), line
statuses (``Diseases``) and return flags (``pest``, ", " separated).  Orders
without lines get NULL lists.  The product-details query reads the star
schema straight from part / supplier / lineitem.

Array results are compared in an order-free text form (sorted, '|' joined)
plus their length, because ARRAY_AGG order is unspecified.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.columns import canonical_array
from fieldbook.operators import catalog
from fieldbook.plans.tables import load, written_input
from fieldbook.session import scratch_path, tasks_for
from fieldbook.sources.io import read_table, write_tables

DOC_KEY = "o_orderkey"
DOC_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
# lines dealt to one task; up to 200 tasks (spark.shuffle.sort.bypassMergeThreshold) a shuffle holds no rows where it is written
_TASK_LINES = 1_200_000
_SPREAD = 4  # tasks over which the lines of one part are dealt


def raw_documents(spark: SparkSession, sf: str, written: bool = False) -> DataFrame:
    """The raw document table; ``written=True`` writes it to the
    checkpoint folder, as the warehouse table the normaliser reads would be."""
    if written:
        return written_input(spark, sf, "raw_documents", lambda: _raw_documents(spark, sf))
    return _raw_documents(spark, sf)


def _raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders", *DOC_COLUMNS)
    l = load(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linestatus", "l_returnflag")
    p = load(spark, sf, "part", "p_partkey", "p_brand", "p_type")
    lp = _lines_with_parts(l, p)

    def lst(c, sep):
        return F.array_join(F.array_sort(F.collect_set(c)), sep)

    lists = lp.groupBy("l_orderkey").agg(
        lst("p_brand", ", ").alias("Product_names"),
        lst("p_type", ",").alias("crop"),
        lst("l_linestatus", ",").alias("Diseases"),
        lst("l_returnflag", ", ").alias("pest"),
    )
    return o.join(lists, o["o_orderkey"] == lists["l_orderkey"], "left").drop("l_orderkey")


def _lines_with_parts(l: DataFrame, p: DataFrame) -> DataFrame:
    """Lines inner-joined to their parts, about ``_TASK_LINES`` lines to a task however large the table is.

    The session's partitions serve while they are enough.  Beyond that the
    lines are dealt by their number, for the join and then by order.  AQE
    splits no partitions whose number is given, so the lines of one part go
    to ``_SPREAD`` tasks, each with its copy of the part.
    """
    spark = l.sparkSession
    tasks = tasks_for(spark, l.count(), _TASK_LINES)
    if tasks == tasks_for(spark, 0, _TASK_LINES):
        return l.join(p, l["l_partkey"] == p["p_partkey"])
    spread = F.lit(_SPREAD).cast("long")
    lines = l.withColumn("_s", F.pmod(F.xxhash64("l_orderkey"), spread)).repartition(tasks, "l_partkey", "_s")
    copies = p.withColumn("_ps", F.explode(F.sequence(F.lit(0).cast("long"), spread - 1)))
    joined = lines.join(copies.hint("merge"), (F.col("l_partkey") == F.col("p_partkey")) & (F.col("_s") == F.col("_ps")))
    return joined.drop("_s", "_ps").repartition(tasks, "l_orderkey")


_RAW_SQL = """
raw AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority,
         x.Product_names, x.crop, x.Diseases, x.pest
  FROM orders o LEFT JOIN (
    SELECT l_orderkey,
      string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS Product_names,
      string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS crop,
      string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS Diseases,
      string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS pest
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY l_orderkey) x ON o.o_orderkey = x.l_orderkey
)"""


def _items_sql(col: str, name: str, cte: str) -> str:
    """Exploded, stripped list items with 0-based position; NULL list -> one NULL row."""
    return f"""
{cte} AS (
  SELECT o_orderkey, (i - 1)::BIGINT AS pos,
         regexp_replace(string_split({col}, ',')[i], '^\\s+|\\s+$', '', 'g') AS {name}
  FROM raw, range(1, len(string_split({col}, ',')) + 1) t(i)
  WHERE {col} IS NOT NULL
  UNION ALL
  SELECT o_orderkey, NULL::BIGINT AS pos, NULL::VARCHAR AS {name} FROM raw WHERE {col} IS NULL
)"""


def _dim_sql(items_cte: str, name: str, id_col: str, cte: str) -> str:
    return f"""
{cte} AS (
  SELECT {name}, row_number() OVER (ORDER BY k NULLS FIRST, p NULLS FIRST)::BIGINT AS {id_col}
  FROM (SELECT {name}, o_orderkey AS k, pos AS p,
               row_number() OVER (PARTITION BY {name} ORDER BY o_orderkey NULLS FIRST, pos NULLS FIRST) AS rn
        FROM {items_cte}) WHERE rn = 1
)"""


def _idlist_sql(items_cte: str, name: str, dim_cte: str, id_col: str, col: str, cte: str) -> str:
    return f"""
{cte} AS (
  SELECT r.o_orderkey,
         CASE WHEN r.{col} IS NULL THEN NULL ELSE coalesce(x.ids, '') END AS {id_col}
  FROM raw r LEFT JOIN (
    SELECT i.o_orderkey, string_agg(d.{id_col}::VARCHAR, ',' ORDER BY i.pos) AS ids
    FROM {items_cte} i JOIN {dim_cte} d ON i.{name} = d.{name}
    WHERE i.{name} IS NOT NULL AND i.{name} <> ''
    GROUP BY i.o_orderkey) x ON r.o_orderkey = x.o_orderkey
)"""


_LISTS = [
    ("Product_names", "Product_Name", "Product_ID", "pi", "dp", "lp"),
    ("crop", "Crop_Name", "Crop_ID", "ci", "dc", "lc"),
    ("Diseases", "Disease_Name", "Disease_ID", "di", "dd", "ld"),
    ("pest", "Pest_Name", "Pest_ID", "ei", "de", "le"),
]


def _normalise_sql() -> str:
    parts = [_RAW_SQL]
    for col, name, idc, it, dm, il in _LISTS:
        parts.append(_items_sql(col, name, it))
        parts.append(_dim_sql(it, name, idc, dm))
        parts.append(_idlist_sql(it, name, dm, idc, col, il))
    parts.append("""
doc AS (
  SELECT r.o_orderkey, r.o_custkey, r.o_orderstatus, r.o_orderpriority,
         lp.Product_ID, lc.Crop_ID, ld.Disease_ID, le.Pest_ID,
         row_number() OVER (ORDER BY r.o_orderkey)::BIGINT AS document_ID
  FROM raw r JOIN lp USING (o_orderkey) JOIN lc USING (o_orderkey)
       JOIN ld USING (o_orderkey) JOIN le USING (o_orderkey)
)""")
    return "WITH " + ",".join(parts)


# ---------------------------------------------------------------- product details
def _star(spark: SparkSession, sf: str):
    """The seven catalogue tables the product-details query reads (stand-ins
    built from part / supplier / lineitem, written once per session)."""
    part = load(spark, sf, "part", "p_partkey", "p_name")
    supp = load(spark, sf, "supplier", "s_suppkey", "s_name")
    li = load(spark, sf, "lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    build = {
        "Product": lambda: part.select(F.col("p_partkey").alias("Product_ID"), F.col("p_name").alias("Product_Name")),
        "productcrop": lambda: li.select(F.col("l_partkey").alias("Product_ID"),
                                         F.col("l_suppkey").alias("Crop_ID")).distinct(),
        "Crop": lambda: supp.select(F.col("s_suppkey").alias("Crop_ID"), F.col("s_name").alias("Crop_Name")),
        "productdisease": lambda: li.select(F.col("l_partkey").alias("Product_ID"),
                                            F.col("l_linenumber").cast("long").alias("Disease_ID")).distinct(),
        "Disease": lambda: li.select(F.col("l_linenumber").cast("long").alias("Disease_ID"),
                                     F.col("l_linenumber").cast("string").alias("Disease_Name")).distinct(),
        "productpest": lambda: li.select(F.col("l_partkey").alias("Product_ID"),
                                         F.ascii("l_returnflag").cast("long").alias("Pest_ID")).distinct(),
        "Pest": lambda: li.select(F.ascii("l_returnflag").cast("long").alias("Pest_ID"),
                                  F.col("l_returnflag").alias("Pest_Name")).distinct(),
    }
    return tuple(written_input(spark, sf, f"star_{name}", fn) for name, fn in build.items())


def _canon_product(df: DataFrame) -> DataFrame:
    return df.select(
        "Product_ID", "Product_Name",
        canonical_array("crops").alias("crops"),
        canonical_array("diseases").alias("diseases"),
        canonical_array("pests").alias("pests"),
        F.size("crops").cast("long").alias("n_crops"),
        F.size("diseases").cast("long").alias("n_diseases"),
        F.size("pests").cast("long").alias("n_pests"),
    )


def q_product_details(spark: SparkSession, sf: str) -> DataFrame:
    """Product details (ARRAY_AGG x3 over the 7-table inner join chain), multiset arrays."""
    return _canon_product(catalog.product_details(*_star(spark, sf)))


def q_product_details_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Product details with set arrays."""
    return _canon_product(catalog.product_details(*_star(spark, sf), distinct=True))


_STAR_SQL = """
WITH Product AS (SELECT p_partkey AS Product_ID, p_name AS Product_Name FROM part),
Crop AS (SELECT s_suppkey AS Crop_ID, s_name AS Crop_Name FROM supplier),
productcrop AS (SELECT DISTINCT l_partkey AS Product_ID, l_suppkey AS Crop_ID FROM lineitem),
Disease AS (SELECT DISTINCT l_linenumber::BIGINT AS Disease_ID, l_linenumber::VARCHAR AS Disease_Name FROM lineitem),
productdisease AS (SELECT DISTINCT l_partkey AS Product_ID, l_linenumber::BIGINT AS Disease_ID FROM lineitem),
Pest AS (SELECT DISTINCT ascii(l_returnflag)::BIGINT AS Pest_ID, l_returnflag AS Pest_Name FROM lineitem),
productpest AS (SELECT DISTINCT l_partkey AS Product_ID, ascii(l_returnflag)::BIGINT AS Pest_ID FROM lineitem)
"""

SQL_PRODUCT_DETAILS = _STAR_SQL + """
SELECT p.Product_ID, p.Product_Name,
  string_agg(c.Crop_Name, '|' ORDER BY c.Crop_Name) AS crops,
  string_agg(d.Disease_Name, '|' ORDER BY d.Disease_Name) AS diseases,
  string_agg(pe.Pest_Name, '|' ORDER BY pe.Pest_Name) AS pests,
  count(*)::BIGINT AS n_crops, count(*)::BIGINT AS n_diseases, count(*)::BIGINT AS n_pests
FROM Product p
JOIN productcrop pc ON p.Product_ID = pc.Product_ID
JOIN Crop c ON c.Crop_ID = pc.Crop_ID
JOIN productdisease pd ON pd.Product_ID = p.Product_ID
JOIN Disease d ON pd.Disease_ID = d.Disease_ID
JOIN productpest ppe ON ppe.Product_ID = p.Product_ID
JOIN Pest pe ON ppe.Pest_ID = pe.Pest_ID
GROUP BY p.Product_Name, p.Product_ID
"""

SQL_PRODUCT_DETAILS_DISTINCT = _STAR_SQL + """
SELECT p.Product_ID, p.Product_Name,
  string_agg(DISTINCT c.Crop_Name, '|' ORDER BY c.Crop_Name) AS crops,
  string_agg(DISTINCT d.Disease_Name, '|' ORDER BY d.Disease_Name) AS diseases,
  string_agg(DISTINCT pe.Pest_Name, '|' ORDER BY pe.Pest_Name) AS pests,
  count(DISTINCT c.Crop_Name)::BIGINT AS n_crops, count(DISTINCT d.Disease_Name)::BIGINT AS n_diseases,
  count(DISTINCT pe.Pest_Name)::BIGINT AS n_pests
FROM Product p
JOIN productcrop pc ON p.Product_ID = pc.Product_ID
JOIN Crop c ON c.Crop_ID = pc.Crop_ID
JOIN productdisease pd ON pd.Product_ID = p.Product_ID
JOIN Disease d ON pd.Disease_ID = d.Disease_ID
JOIN productpest ppe ON ppe.Product_ID = p.Product_ID
JOIN Pest pe ON ppe.Pest_ID = pe.Pest_ID
GROUP BY p.Product_Name, p.Product_ID
"""


# ---------------------------------------------------------------- normaliser
def q_catalog_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Comma list split into one stripped item per row (C4): (o_orderkey, pos, Product_Name)."""
    raw = raw_documents(spark, sf)
    return catalog.explode_list(raw, "Product_names", DOC_KEY, "Product_Name").withColumn(
        "pos", F.col("pos").cast("long"))


SQL_CATALOG_DOCS = "WITH " + _RAW_SQL + "," + _items_sql("Product_names", "Product_Name", "pi") + \
    "\nSELECT o_orderkey, pos, Product_Name FROM pi"


def q_dim_product(spark: SparkSession, sf: str) -> DataFrame:
    """Product dimension: distinct names, ids in first-seen order."""
    raw = raw_documents(spark, sf)
    return catalog.dimension(raw, "Product_names", DOC_KEY, "Product_Name", "Product_ID")


def q_dim_crop(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_documents(spark, sf)
    return catalog.dimension(raw, "crop", DOC_KEY, "Crop_Name", "Crop_ID")


SQL_DIM_PRODUCT = _normalise_sql() + "\nSELECT Product_Name, Product_ID FROM dp"
SQL_DIM_CROP = _normalise_sql() + "\nSELECT Crop_Name, Crop_ID FROM dc"


def q_bridge_product_crop(spark: SparkSession, sf: str) -> DataFrame:
    """Product-crop bridge: distinct id pairs of the cross explode, ids in first-seen order."""
    tables = catalog.normalise(raw_documents(spark, sf, written=True), DOC_KEY)
    return tables["productcrop"]


def q_bridge_product_pest(spark: SparkSession, sf: str) -> DataFrame:
    tables = catalog.normalise(raw_documents(spark, sf, written=True), DOC_KEY)
    return tables["productpest"]


def _bridge_sql(la: str, lb: str, dima: str, dimb: str, na: str, nb: str, ia: str, ib: str, bid: str) -> str:
    return _normalise_sql() + f""",
pairs AS (
  SELECT r.o_orderkey AS k, a.i - 1 AS pa, b.i - 1 AS pb,
    CASE WHEN r.{la} IS NULL THEN NULL ELSE regexp_replace(string_split(r.{la}, ',')[a.i], '^\\s+|\\s+$', '', 'g') END AS na,
    CASE WHEN r.{lb} IS NULL THEN NULL ELSE regexp_replace(string_split(r.{lb}, ',')[b.i], '^\\s+|\\s+$', '', 'g') END AS nb
  FROM raw r,
       range(1, coalesce(len(string_split(r.{la}, ',')), 1) + 1) a(i),
       range(1, coalesce(len(string_split(r.{lb}, ',')), 1) + 1) b(i)
),
linked AS (
  SELECT da.{ia} AS {ia}, db.{ib} AS {ib}, min({{'k': p.k, 'pa': p.pa, 'pb': p.pb}}) AS f
  FROM pairs p JOIN {dima} da ON p.na IS NOT DISTINCT FROM da.{na}
               JOIN {dimb} db ON p.nb IS NOT DISTINCT FROM db.{nb}
  GROUP BY 1, 2
)
SELECT {ia}, {ib}, row_number() OVER (ORDER BY f.k, f.pa, f.pb)::BIGINT AS {bid} FROM linked
"""


SQL_BRIDGE_PRODUCT_CROP = _bridge_sql("Product_names", "crop", "dp", "dc", "Product_Name", "Crop_Name",
                                      "Product_ID", "Crop_ID", "product_crop_ID")
SQL_BRIDGE_PRODUCT_PEST = _bridge_sql("Product_names", "pest", "dp", "de", "Product_Name", "Pest_Name",
                                      "Product_ID", "Pest_ID", "product_pest_ID")


def q_document_id_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Document table: list columns replaced by id lists in list order, plus document_ID."""
    tables = catalog.normalise(raw_documents(spark, sf, written=True), DOC_KEY)
    return tables["Document"]


SQL_DOCUMENT_ID_LISTS = _normalise_sql() + "\nSELECT * FROM doc"


def q_normalise_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All 8 normalised tables written, read back and laid one below the other."""
    return _written_tables(spark, catalog.normalise(raw_documents(spark, sf, written=True), DOC_KEY))


def q_normalise_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The 8 tables after a base run and a delta: pending orders' documents come later, given ids stay."""
    raw = raw_documents(spark, sf, written=True)
    pending = F.col("o_orderstatus") == "P"
    paths = write_tables(catalog.normalise(raw.where(~pending), DOC_KEY),
                         scratch_path(spark, f"normalised-{uuid.uuid4().hex}"))
    base = {name: read_table(spark, path) for name, path in paths.items()}
    added = catalog.normalise_more(raw.where(pending), base, DOC_KEY)
    return _written_tables(spark, catalog.merge_tables(base, added, DOC_KEY))


def _written_tables(spark: SparkSession, tables) -> DataFrame:
    paths = write_tables(tables, scratch_path(spark, f"normalised-{uuid.uuid4().hex}"))
    out = None
    for name, path in paths.items():
        t = read_table(spark, path)
        if name == "Document":
            cols = ["Product_ID", "Crop_ID", "document_ID"]
        else:
            cols = t.columns if len(t.columns) == 3 else [t.columns[0], None, t.columns[1]]
        part = t.select(F.lit(name).alias("tbl"), *[
            (F.col(c) if c else F.lit(None)).cast("string").alias(out_col)
            for c, out_col in zip(cols[:2], ("a", "b"))], F.col(cols[2]).alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


SQL_NORMALISE_TABLES = " UNION ALL ".join(
    [f"SELECT '{name}' AS tbl, {a}::VARCHAR AS a, {b}::VARCHAR AS b, {i} AS id FROM ({sql}) x" for name, a, b, i, sql in [
        ("productcrop", "Product_ID", "Crop_ID", "product_crop_ID", SQL_BRIDGE_PRODUCT_CROP),
        ("productpest", "Product_ID", "Pest_ID", "product_pest_ID", SQL_BRIDGE_PRODUCT_PEST),
        ("productdisease", "Product_ID", "Disease_ID", "product_disease_ID", _bridge_sql(
            "Product_names", "Diseases", "dp", "dd", "Product_Name", "Disease_Name", "Product_ID", "Disease_ID",
            "product_disease_ID")),
        ("Document", "Product_ID", "Crop_ID", "document_ID", SQL_DOCUMENT_ID_LISTS),
        *[(n, f"{n}_Name", "NULL", f"{n}_ID", _normalise_sql() + f"SELECT * FROM {d}")
          for n, d in (("Product", "dp"), ("Crop", "dc"), ("Disease", "dd"), ("Pest", "de"))],
    ]])


# the ids of one run whose rows stand in the order base, delta
SQL_NORMALISE_DELTA = SQL_NORMALISE_TABLES.replace(
    "SELECT o.o_orderkey, o.o_custkey",
    "SELECT o.o_orderkey + CASE o.o_orderstatus WHEN 'P' THEN 1000000000000 ELSE 0 END AS o_orderkey, o.o_custkey")


def q_document_details(spark: SparkSession, sf: str) -> DataFrame:
    """Document details: id lists unnested, names looked up, grouped by product name + doc columns."""
    t = catalog.normalise(raw_documents(spark, sf, written=True), DOC_KEY)
    # the query groups by document columns, not by document_ID: read the
    # document table before its numbering
    out = catalog.document_details(t.document_lists(), t["Product"], t["Crop"], t["Disease"], t["Pest"],
                                   detail_columns=DOC_COLUMNS, doc_key=DOC_KEY)
    return out.select(
        *DOC_COLUMNS, "Product_Name",
        canonical_array("Disease_Names").alias("Disease_Names"),
        canonical_array("Crop_Names").alias("Crop_Names"),
        canonical_array("Pest_Names").alias("Pest_Names"),
        F.size("Disease_Names").cast("long").alias("n_entries"),
    )


SQL_DOCUMENT_DETAILS = _normalise_sql() + """
SELECT d.o_orderkey, d.o_custkey, d.o_orderstatus, d.o_orderpriority, P.Product_Name,
  string_agg(Di.Disease_Name, '|' ORDER BY Di.Disease_Name) AS Disease_Names,
  string_agg(C.Crop_Name, '|' ORDER BY C.Crop_Name) AS Crop_Names,
  string_agg(Pe.Pest_Name, '|' ORDER BY Pe.Pest_Name) AS Pest_Names,
  count(*)::BIGINT AS n_entries
FROM doc d
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Product_ID, ',')) AS e) up ON true
LEFT JOIN dp P ON P.Product_ID = TRY_CAST(up.e AS BIGINT)
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Disease_ID, ',')) AS e) ud ON true
LEFT JOIN dd Di ON Di.Disease_ID = TRY_CAST(ud.e AS BIGINT)
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Crop_ID, ',')) AS e) uc ON true
LEFT JOIN dc C ON C.Crop_ID = TRY_CAST(uc.e AS BIGINT)
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Pest_ID, ',')) AS e) ue ON true
LEFT JOIN de Pe ON Pe.Pest_ID = TRY_CAST(ue.e AS BIGINT)
GROUP BY P.Product_Name, d.o_orderkey, d.o_custkey, d.o_orderstatus, d.o_orderpriority
"""


def _count_text(c: str) -> F.Column:
    """(name, n) structs as 'name:n' joined by '|', NULL names left out; NULL if there is none."""
    named = F.filter(F.col(c), lambda e: e["name"].isNotNull())
    text = F.array_join(F.transform(named, lambda e: F.concat_ws(":", e["name"], e["n"].cast("string"))), "|")
    return F.when(F.size(named) > 0, text).alias(c)


def q_product_details_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Product details as (name, count) pairs, bounded by the dimensions."""
    out = catalog.product_details(*_star(spark, sf), counted=True)
    return out.select("Product_ID", "Product_Name", *[_count_text(c) for c in ("crops", "diseases", "pests")])


def _counts_sql(group: str, names: dict[str, str]) -> str:
    """Rest of a WITH list over the flat rows ``f``: per group 'name:n' texts of each name column."""
    parts = "\nUNION ALL ".join(
        f"SELECT {group}, '{out}' AS kind, {col} AS name, count(*) AS n FROM f GROUP BY {group}, {col}"
        for out, col in names.items())
    texts = ", ".join(f"string_agg(name || ':' || n, '|' ORDER BY name) FILTER (WHERE kind = '{out}') AS {out}" for out in names)
    return f"per AS ({parts})\nSELECT {group}, {texts} FROM per GROUP BY {group}"


SQL_PRODUCT_DETAILS_COUNTED = _STAR_SQL + """, f AS (
SELECT p.Product_ID, p.Product_Name, c.Crop_Name, d.Disease_Name, pe.Pest_Name
FROM Product p
JOIN productcrop pc ON p.Product_ID = pc.Product_ID
JOIN Crop c ON c.Crop_ID = pc.Crop_ID
JOIN productdisease pd ON pd.Product_ID = p.Product_ID
JOIN Disease d ON pd.Disease_ID = d.Disease_ID
JOIN productpest ppe ON ppe.Product_ID = p.Product_ID
JOIN Pest pe ON ppe.Pest_ID = pe.Pest_ID),
""" + _counts_sql("Product_ID, Product_Name", {"crops": "Crop_Name", "diseases": "Disease_Name", "pests": "Pest_Name"})


def q_document_details_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Document details with the strict id cast, as (name, count) pairs bounded by the dimensions."""
    t = catalog.normalise(raw_documents(spark, sf, written=True), DOC_KEY)
    out = catalog.document_details(t.document_lists(), t["Product"], t["Crop"], t["Disease"], t["Pest"],
                                   detail_columns=DOC_COLUMNS, doc_key=DOC_KEY, strict=True, counted=True)
    return out.select(*DOC_COLUMNS, "Product_Name", *[_count_text(c) for c in ("Disease_Names", "Crop_Names", "Pest_Names")])


SQL_DOCUMENT_DETAILS_COUNTED = _normalise_sql() + """, f AS (
SELECT d.o_orderkey, d.o_custkey, d.o_orderstatus, d.o_orderpriority, P.Product_Name, Di.Disease_Name, C.Crop_Name, Pe.Pest_Name
FROM doc d
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Product_ID, ',')) AS e) up ON true
LEFT JOIN dp P ON P.Product_ID = CAST(up.e AS BIGINT)
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Disease_ID, ',')) AS e) ud ON true
LEFT JOIN dd Di ON Di.Disease_ID = CAST(ud.e AS BIGINT)
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Crop_ID, ',')) AS e) uc ON true
LEFT JOIN dc C ON C.Crop_ID = CAST(uc.e AS BIGINT)
LEFT JOIN LATERAL (SELECT unnest(string_split(d.Pest_ID, ',')) AS e) ue ON true
LEFT JOIN de Pe ON Pe.Pest_ID = CAST(ue.e AS BIGINT)),
""" + _counts_sql("o_orderkey, o_custkey, o_orderstatus, o_orderpriority, Product_Name",
                  {"Disease_Names": "Disease_Name", "Crop_Names": "Crop_Name", "Pest_Names": "Pest_Name"})


QUERIES = {
    "product_details": (q_product_details, SQL_PRODUCT_DETAILS),
    "product_details_distinct": (q_product_details_distinct, SQL_PRODUCT_DETAILS_DISTINCT),
    "catalog_docs": (q_catalog_docs, SQL_CATALOG_DOCS),
    "dim_product": (q_dim_product, SQL_DIM_PRODUCT),
    "dim_crop": (q_dim_crop, SQL_DIM_CROP),
    "bridge_product_crop": (q_bridge_product_crop, SQL_BRIDGE_PRODUCT_CROP),
    "bridge_product_pest": (q_bridge_product_pest, SQL_BRIDGE_PRODUCT_PEST),
    "document_id_lists": (q_document_id_lists, SQL_DOCUMENT_ID_LISTS),
    "normalise_delta": (q_normalise_delta, SQL_NORMALISE_DELTA),
    "normalise_tables": (q_normalise_tables, SQL_NORMALISE_TABLES),
    "document_details": (q_document_details, SQL_DOCUMENT_DETAILS),
    "product_details_counted": (q_product_details_counted, SQL_PRODUCT_DETAILS_COUNTED),
    "document_details_counted": (q_document_details_counted, SQL_DOCUMENT_DETAILS_COUNTED),
}
