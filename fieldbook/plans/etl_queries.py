"""Observation ETL, search, conforming load, name cleaning, access lookup, scans.

Stand-in inputs: a sheet "file" per customer (rows = the customer's orders),
the wide product sheet = ``part``, keyword tables derived from part names,
the user-access table derived from ``customer``.
"""

from __future__ import annotations

import gzip
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.columns import fill_null_text, replace_when_contains
from fieldbook.operators import access, load as loadop, observations, search
from fieldbook.operators.catalog import explode_list
from fieldbook.operators.file_index import FileIndex
from fieldbook.plans.catalog_queries import DOC_KEY, _RAW_SQL, raw_documents
from fieldbook.plans.tables import load
from fieldbook.session import scratch_path
from fieldbook.sources.io import read_limit, read_table, write_bytes_file

RUN_TS = "2024-01-01 00:00:00"


# ---------------------------------------------------------------- observations
def _product_sheet(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("productid"), F.col("p_name").alias("product"), F.col("p_brand").alias("pest"),
        F.col("p_size").alias("feeding"), F.col("p_retailprice").alias("weight"),
    )


def q_observations_long(spark: SparkSession, sf: str) -> DataFrame:
    """Wide sheet -> long observations with units by column name."""
    return observations.unpivot_observations(_product_sheet(spark, sf)).drop("observation_text")


SQL_OBSERVATIONS_LONG = """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS pest_name, 'feeding' AS observation_name,
       p_size::DOUBLE AS observation_value, 'percentage' AS observation_unit FROM part
UNION ALL
SELECT p_partkey, p_name, p_brand, 'weight', p_retailprice, 'grams' FROM part
"""


def _order_files(spark: SparkSession, sf: str):
    """Sheet1 and data sheet of one file per customer.

    Sheet1: one row per order (AUTOMOBILE customers' files have no product id).
    data: a note per order; notes of finished orders carry the order date,
    5-LOW ones a 'review by 31.<month>.<year>' date that may not exist.
    """
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
             "o_orderdate", "o_orderpriority")
    c = load(spark, sf, "customer", "c_custkey", "c_mktsegment")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    fp = F.concat(F.lit("file-"), F.col("o_custkey").cast("string"))
    sheet = oc.select(
        fp.alias("file_path"),
        F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("o_orderkey")).alias("productid"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("feeding"),
        F.col("o_custkey").cast("string").alias("weight"),
    )
    note = (
        F.when(F.col("o_orderstatus") != "F", F.lit("pending"))
        .when(F.col("o_orderpriority") == "5-LOW",
              F.concat(F.lit("review by 31."), F.date_format("o_orderdate", "MM.yyyy")))
        .otherwise(F.concat(F.lit("placed "), F.date_format("o_orderdate", "dd.MM.yyyy"),
                            F.lit(" status "), F.col("o_orderstatus")))
    )
    data = oc.select(fp.alias("file_path"), note.alias("note"), F.col("o_orderpriority").alias("priority"))
    return sheet, data


_FILES_SQL = r"""
WITH oc AS (SELECT o.*, c.c_mktsegment, 'file-' || o.o_custkey::VARCHAR AS file_path
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
sheet AS (SELECT file_path, CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN o_orderkey END AS productid,
                 o_orderpriority AS product, o_totalprice AS feeding, o_custkey::VARCHAR AS weight FROM oc),
data AS (SELECT file_path,
           CASE WHEN o_orderstatus <> 'F' THEN 'pending'
                WHEN o_orderpriority = '5-LOW' THEN 'review by 31.' || strftime(o_orderdate, '%m.%Y')
                ELSE 'placed ' || strftime(o_orderdate, '%d.%m.%Y') || ' status ' || o_orderstatus END AS note,
           o_orderpriority AS priority FROM oc),
tok AS (SELECT file_path, unnest(regexp_extract_all(note, '\b(\d{2})\.(\d{2})\.(\d{4})\b')) AS t FROM data
        UNION ALL
        SELECT file_path, unnest(regexp_extract_all(priority, '\b(\d{2})\.(\d{2})\.(\d{4})\b')) FROM data),
fd AS (SELECT file_path, min(try_strptime(t, '%d.%m.%Y')::DATE) AS date_created,
              max(try_strptime(t, '%d.%m.%Y')::DATE) AS date_expired, count(t)::BIGINT AS n_dates,
              sum(CASE WHEN try_strptime(t, '%d.%m.%Y') IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_bad_dates
       FROM tok GROUP BY file_path),
files AS (SELECT file_path, bool_or(productid IS NOT NULL) AS has_id, 2 * count(*) AS n_rows
          FROM sheet GROUP BY file_path),
pf AS (SELECT f.*, fd.date_created, fd.date_expired, fd.n_dates, fd.n_bad_dates,
         CASE WHEN NOT f.has_id THEN 'Missing ''productid'' column'
              WHEN coalesce(fd.n_bad_dates, 0) > 0 THEN 'Invalid date'
              WHEN coalesce(fd.n_dates, 0) = 0 THEN 'No dates found' END AS error_message
       FROM files f LEFT JOIN fd USING (file_path))
"""


def q_file_date_range(spark: SparkSession, sf: str) -> DataFrame:
    """Per file: min/max dd.mm.yyyy date found in any text cell (date regex, E5)."""
    _, data = _order_files(spark, sf)
    return observations.file_dates(data)


SQL_FILE_DATE_RANGE = _FILES_SQL + """
SELECT file_path, date_created, date_expired, n_dates, n_bad_dates FROM fd
"""


def q_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Run log: one row per file with rows loaded or the reason it was skipped."""
    sheet, data = _order_files(spark, sf)
    _, log = observations.load_files(sheet, data, RUN_TS)
    return log


SQL_RUN_LOG = _FILES_SQL + """
SELECT TIMESTAMP '2024-01-01 00:00:00' AS timestamp, file_path,
       (CASE WHEN error_message IS NULL THEN n_rows ELSE 0 END)::BIGINT AS rows_loaded, error_message FROM pf
"""


def q_observations_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Rows appended by the ETL: long observations of accepted files with their date range."""
    sheet, data = _order_files(spark, sf)
    rows, _ = observations.load_files(sheet, data, RUN_TS)
    return rows


SQL_OBSERVATIONS_LOADED = _FILES_SQL + """,
long AS (SELECT file_path, productid AS product_id, product AS product_name, NULL::VARCHAR AS pest_name,
                'feeding' AS observation_name, feeding AS observation_value, 'percentage' AS observation_unit FROM sheet
         UNION ALL
         SELECT file_path, productid, product, NULL, 'weight', TRY_CAST(weight AS DOUBLE), 'grams' FROM sheet)
SELECT l.product_id, l.product_name, l.pest_name, l.observation_name, l.observation_value, l.observation_unit,
       pf.date_created, pf.date_expired, l.file_path
FROM long l JOIN pf USING (file_path) WHERE pf.error_message IS NULL
"""


def q_run_log_files(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of sheet files to the observation table and run log: one log row per file.

    Stand-in files: a sheet and a data sheet per nation, a row per order of
    its customers.  Sheets of region 0 lack ``productid``, those of region 1
    have text ids, of region 2 no ``weight`` column, of region 3 torn lines
    (pending orders); for each region there is an empty sheet as well.
    """
    base = scratch_path(spark, f"sheets-{uuid.uuid4().hex}")
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority")
    c = load(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = load(spark, sf, "nation", "n_nationkey", "n_regionkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"])
    key, region = F.col("o_orderkey").cast("string"), F.col("n_regionkey")
    line = F.to_json(F.struct(
        F.when(region == 1, F.concat(F.lit("P-"), key)).when(region != 0, key).alias("productid"),
        F.col("o_orderpriority").alias("product"), F.col("o_totalprice").alias("feeding"),
        F.when(region != 2, F.col("o_custkey")).alias("weight")))
    torn = (region == 3) & (F.col("o_orderstatus") == "P")
    line = F.when(torn, F.substring(line, 1, 20)).otherwise(line)
    sheet = F.concat(F.lit("nation-"), F.col("n_nationkey"))
    empty = load(spark, sf, "region", "r_regionkey").select(
        F.concat(F.lit("empty-"), F.col("r_regionkey")).alias("sheet"), F.lit("").alias("value"))
    oc.select(sheet.alias("sheet"), line.alias("value")).unionByName(empty).write.partitionBy("sheet").text(
        f"{base}/sheets")
    note = F.to_json(F.struct(F.concat(F.lit("placed "), F.date_format("o_orderdate", "dd.MM.yyyy")).alias("note")))
    oc.select(sheet.alias("sheet"), note.alias("value")).write.partitionBy("sheet").text(f"{base}/data")
    observations.load_folder(spark, f"{base}/sheets", f"{base}/data", RUN_TS, f"{base}/table", f"{base}/log",
                             sheet_name="sheet=([^/]+)/")
    loaded = read_table(spark, f"{base}/table").groupBy(
        "observation_name", "observation_unit", "date_created", "date_expired").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("product_id").alias("n_ids"))
    return read_table(spark, f"{base}/log").unionByName(loaded, allowMissingColumns=True)


SQL_RUN_LOG_FILES = """
WITH oc AS (SELECT o.*, n_nationkey, n_regionkey FROM orders o JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT n_nationkey, n_regionkey, count(*) AS n, bool_or(n_regionkey = 3 AND o_orderstatus = 'P') AS torn,
             min(o_orderdate)::DATE AS date_created, max(o_orderdate)::DATE AS date_expired FROM oc GROUP BY ALL),
j AS (SELECT *, CASE WHEN torn THEN 'Unreadable file' WHEN n_regionkey = 0 THEN 'Missing ''productid'' column'
                     WHEN n_regionkey = 1 THEN 'Non-integer product id' END AS error_message FROM f),
obs AS (SELECT m.observation_name, m.observation_unit, date_created, date_expired, o_orderkey
        FROM oc JOIN j USING (n_nationkey, n_regionkey),
             (VALUES ('feeding', 'percentage'), ('weight', 'grams')) m(observation_name, observation_unit)
        WHERE error_message IS NULL AND (m.observation_name = 'feeding' OR n_regionkey <> 2))
SELECT TIMESTAMP '2024-01-01 00:00:00' AS timestamp, 'nation-' || n_nationkey AS file_path,
       (CASE WHEN error_message IS NOT NULL THEN 0 WHEN n_regionkey = 2 THEN n ELSE 2 * n END)::BIGINT AS rows_loaded,
       error_message, NULL::VARCHAR AS observation_name, NULL::VARCHAR AS observation_unit, NULL::DATE AS date_created,
       NULL::DATE AS date_expired, NULL::BIGINT AS n_rows, NULL::BIGINT AS n_ids FROM j
UNION ALL SELECT TIMESTAMP '2024-01-01 00:00:00', 'empty-' || r_regionkey, 0, 'Missing ''productid'' column',
       NULL, NULL, NULL, NULL, NULL, NULL FROM region
UNION ALL SELECT NULL, NULL, NULL, NULL, observation_name, observation_unit, date_created, date_expired, count(*),
       count(DISTINCT o_orderkey) FROM obs GROUP BY observation_name, observation_unit, date_created, date_expired
"""


def q_run_log_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV sheets, each file with its own header, beside files that cannot be read.

    Stand-in files: a sheet per nation, a row per order of its customers.
    Sheets of region 0 lack ``productid``, those of region 1 have their
    columns in another order, of region 2 no ``weight``.  Each region has a
    packed sheet that is cut off and one that the manifest names but is gone.
    """
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = load(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = load(spark, sf, "nation", "n_nationkey", "n_regionkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"]).select(
        F.concat(F.lit("nation-"), F.col("n_nationkey")).alias("sheet"), "n_regionkey",
        F.col("o_orderkey").alias("productid"), F.concat(F.lit('the "'), "o_orderpriority", F.lit('", kind')).alias("product"),
        F.col("o_totalprice").alias("feeding"), F.col("o_custkey").alias("weight"),
        F.concat(F.lit("placed "), F.date_format("o_orderdate", "dd.MM.yyyy")).alias("note"))
    shapes = {0: ["product", "feeding", "weight"], 1: ["weight", "product", "productid", "feeding"],
              2: ["productid", "product", "feeding"], 3: ["productid", "product", "feeding", "weight"]}
    for region, columns in shapes.items():
        mine = oc.where(F.least("n_regionkey", F.lit(3)) == region).select("sheet", *columns)
        mine.write.partitionBy("sheet").option("header", True).option("escape", '"').csv(f"{base}/sheets/{region}")
    oc.select("sheet", "note").write.partitionBy("sheet").option("header", True).csv(f"{base}/data")
    expected = []
    for r in load(spark, sf, "region", "r_regionkey").collect():  # five rows
        lines = "productid,product,feeding\n" + "".join(f"{i},x,{i * 7919 % 1009}\n" for i in range(5000))
        packed = gzip.compress(lines.encode())
        write_bytes_file(spark, f"{base}/sheets/cut/sheet=cut-{r.r_regionkey}/part.csv.gz", packed[:len(packed) // 2])
        expected.append(f"{base}/sheets/gone/sheet=gone-{r.r_regionkey}/part.csv")
    observations.load_folder(spark, f"{base}/sheets", f"{base}/data", RUN_TS, f"{base}/table", f"{base}/log",
                             sheet_name="sheet=([^/]+)/", fmt="csv", expected=expected)
    loaded = read_table(spark, f"{base}/table").groupBy("observation_name", "date_created", "date_expired").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("product_name").alias("product_name"),
        F.min("observation_value").alias("least"), F.max("observation_value").alias("most"))
    return read_table(spark, f"{base}/log").unionByName(loaded, allowMissingColumns=True)


SQL_RUN_LOG_CSV = """
WITH oc AS (SELECT o.*, n_nationkey, n_regionkey FROM orders o JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey),
f AS (SELECT n_nationkey, n_regionkey, count(*) AS n, min(o_orderdate)::DATE AS date_created,
             max(o_orderdate)::DATE AS date_expired FROM oc GROUP BY ALL),
obs AS (SELECT m.observation_name, date_created, date_expired, 'the "' || o_orderpriority || '", kind' AS product_name,
               CASE m.observation_name WHEN 'feeding' THEN o_totalprice ELSE o_custkey::DOUBLE END AS v
        FROM oc JOIN f USING (n_nationkey, n_regionkey), (VALUES ('feeding'), ('weight')) m(observation_name)
        WHERE n_regionkey <> 0 AND (m.observation_name = 'feeding' OR n_regionkey <> 2))
SELECT TIMESTAMP '2024-01-01 00:00:00' AS timestamp, 'nation-' || n_nationkey AS file_path,
       (CASE n_regionkey WHEN 0 THEN 0 WHEN 2 THEN n ELSE 2 * n END)::BIGINT AS rows_loaded,
       CASE WHEN n_regionkey = 0 THEN 'Missing ''productid'' column' END AS error_message,
       NULL::VARCHAR AS observation_name, NULL::DATE AS date_created, NULL::DATE AS date_expired, NULL::BIGINT AS n_rows,
       NULL::VARCHAR AS product_name, NULL::DOUBLE AS least, NULL::DOUBLE AS most FROM f
UNION ALL SELECT TIMESTAMP '2024-01-01 00:00:00', k || r_regionkey, 0, 'Unreadable file', NULL, NULL, NULL, NULL, NULL,
       NULL, NULL FROM region, (VALUES ('cut-'), ('gone-')) b(k)
UNION ALL SELECT NULL, NULL, NULL, NULL, observation_name, date_created, date_expired, count(*), min(product_name), min(v),
       max(v) FROM obs GROUP BY observation_name, date_created, date_expired
"""


def q_truncate_load(spark: SparkSession, sf: str) -> DataFrame:
    """Truncate-and-load twice: the table holds the second load only, in the master schema."""
    path = scratch_path(spark, f"master-{uuid.uuid4().hex}")
    loadop.truncate_load(load(spark, sf, "supplier").withColumnRenamed("s_suppkey", "c_custkey"), path,
                         CUSTOMER_MASTER)
    loadop.truncate_load(load(spark, sf, "customer"), path, CUSTOMER_MASTER)
    return read_table(spark, path)


# ---------------------------------------------------------------- search
def q_search_one(spark: SparkSession, sf: str) -> DataFrame:
    """One keyword, LIKE '%kw%' over every column cast to string."""
    return search.search_one(load(spark, sf, "part"), "ring")


SQL_SEARCH_ONE = """
SELECT * FROM part WHERE p_partkey::VARCHAR LIKE '%ring%' OR p_name LIKE '%ring%' OR p_brand LIKE '%ring%'
  OR p_type LIKE '%ring%' OR p_size::VARCHAR LIKE '%ring%' OR p_retailprice::VARCHAR LIKE '%ring%'
"""

_KWS = ["17", "BUILDING", "Brand#1_"]


def q_search_many(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword list, OR of keywords over all columns; '_' acts as a LIKE wildcard."""
    return search.search(load(spark, sf, "customer"), _KWS)


_SEGMENT_KWS = ["UILDIN", "mer#000000_17"]


def q_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords over customers kept in files by segment, read through sketches of the files' trigrams."""
    base = scratch_path(spark, f"indexed-{uuid.uuid4().hex}")
    load(spark, sf, "customer").repartitionByRange("c_mktsegment", "c_custkey").write.parquet(base + "/rows")
    index = FileIndex(spark, base + "/rows", base + "/index")
    index.refresh()
    return index.search(_SEGMENT_KWS)


def _like_all(cols: list[str], kws: list[str]) -> str:
    return " OR ".join(f"{c}::VARCHAR LIKE '%{k}%'" for k in kws for c in cols)


SQL_SEARCH_MANY = "SELECT * FROM customer WHERE " + _like_all(
    ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], _KWS)


SQL_SEARCH_INDEXED = "SELECT * FROM customer WHERE " + _like_all(
    ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], _SEGMENT_KWS)


_DOC_KWS = ["license", "Apache", "@"]


def q_search_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword list over every column of the documents table, whole texts."""
    return search.search(load(spark, sf, "documents"), _DOC_KWS).select("doc_id", "lang", "source", "n_chars")


SQL_SEARCH_DOCUMENTS = "SELECT doc_id, lang, source, n_chars FROM documents WHERE " + _like_all(
    ["doc_id", "text", "lang", "source", "n_chars"], _DOC_KWS)


def _name_words(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part", "p_name", "p_brand")
    words = p.select(F.explode(F.split("p_name", " ")).alias("keyword"))
    tails = p.select(F.substring_index("p_brand", "#", -1).alias("keyword"))
    return words.unionByName(tails).distinct()


def q_search_table(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword table joined to rows through trigram tokens + exact contains."""
    rows = load(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type")
    return search.search_table(rows, _name_words(spark, sf), "p_partkey")


SQL_SEARCH_TABLE = """
WITH kw AS (SELECT DISTINCT keyword FROM (
              SELECT unnest(string_split(p_name, ' ')) AS keyword FROM part
              UNION ALL SELECT split_part(p_brand, '#', -1) FROM part) WHERE keyword IS NOT NULL),
r AS (SELECT p_partkey, concat_ws(chr(1), p_name, p_brand, p_type) AS t FROM part)
SELECT DISTINCT r.p_partkey, kw.keyword FROM r JOIN kw ON contains(r.t, kw.keyword)
"""


def q_search_table_like(spark: SparkSession, sf: str) -> DataFrame:
    """A keyword table of LIKE patterns: wildcards, escapes and patterns without a literal."""
    part = load(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type")
    name, brand = F.col("p_name"), F.col("p_brand")
    first, last = F.split_part(name, F.lit(" "), F.lit(1)), F.split_part(name, F.lit(" "), F.lit(-1))
    keywords = part.select(F.explode(F.array(
        F.concat(F.substring(first, 1, 3), F.lit("%"), last),
        F.concat(F.substring(last, 1, 1), F.lit("_"), F.expr("substring(split_part(p_name, ' ', -1), 3)")),
        F.concat(F.lit("%"), F.substring(brand, -3, 2), F.lit("_")),
        F.concat(F.lit("\\%"), first), F.concat(F.lit("_%"), F.substring(first, 1, 2)),
        F.repeat(F.lit("_"), F.length(name) - 2))).alias("keyword"))
    return search.search_table(part, keywords, "p_partkey", literal=False)


SQL_SEARCH_TABLE_LIKE = r"""
WITH w AS (SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', -1) AS z FROM part),
kw AS (SELECT DISTINCT unnest([
    substr(a, 1, 3) || '%' || z, substr(z, 1, 1) || '_' || substr(z, 3), '%' || substr(p_brand, -3, 2) || '_',
    '\%' || a, '_%' || substr(a, 1, 2), repeat('_', length(p_name) - 2)]) AS keyword FROM w)
SELECT DISTINCT p_partkey, keyword FROM part JOIN kw ON keyword <> '' AND (p_name LIKE '%' || keyword || '%' ESCAPE '\'
    OR p_brand LIKE '%' || keyword || '%' ESCAPE '\' OR p_type LIKE '%' || keyword || '%' ESCAPE '\')
"""


# ---------------------------------------------------------------- load
CUSTOMER_MASTER = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_phone", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()),
])


def q_conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Conform to a master schema: schema order, extra columns dropped, missing ones NULL (B2)."""
    return loadop.conform(load(spark, sf, "customer"), CUSTOMER_MASTER)


SQL_CONFORM_SCHEMA = "SELECT c_custkey, c_name, NULL::VARCHAR AS c_phone, c_acctbal FROM customer"


def q_conform_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole frame to text, then to the master schema (B5 + B2)."""
    return loadop.conform(loadop.to_text(load(spark, sf, "customer")), CUSTOMER_MASTER, as_text=True)


# ---------------------------------------------------------------- name cleaning
# The replacement list of the reference's name rewrite; the needle
# used on the test tables is a brand that also prefixes longer brands.
REWRITE_TO = "product 1, product 2, product 3, product 4"
TEST_NEEDLE = "Brand#2"


def q_clean_names(spark: SparkSession, sf: str) -> DataFrame:
    """List rewrite when it contains a name (B18), split, drop empties (B16), NULL -> 'null' (B17).

    Each list gets two empty items at its end.
    """
    raw = raw_documents(spark, sf).withColumn(
        "Product_names", F.concat(replace_when_contains("Product_names", TEST_NEEDLE, REWRITE_TO), F.lit(", ,")))
    items = explode_list(raw, "Product_names", DOC_KEY, "Product_Name")
    items = items.where((F.col("Product_Name") != "") | F.col("Product_Name").isNull())
    return items.select(DOC_KEY, F.col("pos").cast("long").alias("pos"),
                        fill_null_text("Product_Name").alias("Product_Name"))


SQL_CLEAN_NAMES = "WITH " + _RAW_SQL + r""",
r2 AS (SELECT o_orderkey, CASE WHEN contains(Product_names, 'Brand#2')
              THEN 'product 1, product 2, product 3, product 4' ELSE Product_names END || ', ,' AS pn FROM raw),
it AS (SELECT o_orderkey, (i - 1)::BIGINT AS pos,
              regexp_replace(string_split(pn, ',')[i], '^\s+|\s+$', '', 'g') AS n
       FROM r2, range(1, len(string_split(pn, ',')) + 1) t(i) WHERE pn IS NOT NULL
       UNION ALL SELECT o_orderkey, NULL::BIGINT, NULL::VARCHAR FROM r2 WHERE pn IS NULL)
SELECT o_orderkey, pos, coalesce(n, 'null') AS Product_Name FROM it WHERE n <> '' OR n IS NULL
"""


# ---------------------------------------------------------------- access
def _user_access(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.select(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("CWID"),
        F.col("c_name").alias("user_name"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.org")).alias("email"),
        F.col("c_mktsegment").alias("access_group"),
        F.struct("c_acctbal", "c_custkey").alias("_order"),
    )


def q_access_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Id -> user record, last duplicate wins, unknown ids 'not valid' (D9)."""
    s = load(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    ids = s.select("s_suppkey", F.concat_ws(
        "-", F.when(F.col("s_acctbal") >= 0, F.lit("BUILDING")).otherwise(F.lit("RETAIL")),
        F.col("s_nationkey").cast("string")).alias("CWID"))
    return access.lookup(ids, _user_access(spark, sf), order_col="_order")


SQL_ACCESS_LOOKUP = """
WITH ua AS (SELECT c_mktsegment || '-' || c_nationkey::VARCHAR AS CWID, c_name AS user_name,
                   lower(replace(c_name, '#', '.')) || '@example.org' AS email, c_mktsegment AS access_group,
                   row_number() OVER (PARTITION BY c_mktsegment || '-' || c_nationkey::VARCHAR
                                      ORDER BY c_acctbal DESC, c_custkey DESC) AS rn FROM customer),
ids AS (SELECT s_suppkey, (CASE WHEN s_acctbal >= 0 THEN 'BUILDING' ELSE 'RETAIL' END) || '-' || s_nationkey::VARCHAR
               AS CWID FROM supplier)
SELECT ids.s_suppkey, ids.CWID, ua.user_name, ua.email, ua.access_group,
       CASE WHEN ua.CWID IS NULL THEN 'not valid' ELSE 'valid' END AS status
FROM ids LEFT JOIN ua ON ua.CWID = ids.CWID AND ua.rn = 1
"""


# ---------------------------------------------------------------- scans
def q_scan_limit(spark: SparkSession, sf: str) -> DataFrame:
    """Scan with a limit (head(n)); any n rows, so only the count is compared."""
    return read_limit(load(spark, sf, "orders"), 100).agg(F.count(F.lit(1)).alias("n_rows"))


SQL_SCAN_LIMIT = "SELECT count(*) AS n_rows FROM (SELECT * FROM orders LIMIT 100)"


QUERIES = {
    "observations_long": (q_observations_long, SQL_OBSERVATIONS_LONG),
    "file_date_range": (q_file_date_range, SQL_FILE_DATE_RANGE),
    "run_log": (q_run_log, SQL_RUN_LOG),
    "run_log_files": (q_run_log_files, SQL_RUN_LOG_FILES),
    "run_log_csv": (q_run_log_csv, SQL_RUN_LOG_CSV),
    "truncate_load": (q_truncate_load, SQL_CONFORM_SCHEMA),
    "observations_loaded": (q_observations_loaded, SQL_OBSERVATIONS_LOADED),
    "search_one": (q_search_one, SQL_SEARCH_ONE),
    "search_indexed": (q_search_indexed, SQL_SEARCH_INDEXED),
    "search_many": (q_search_many, SQL_SEARCH_MANY),
    "search_table": (q_search_table, SQL_SEARCH_TABLE),
    "search_table_like": (q_search_table_like, SQL_SEARCH_TABLE_LIKE),
    "search_documents": (q_search_documents, SQL_SEARCH_DOCUMENTS),
    "conform_schema": (q_conform_schema, SQL_CONFORM_SCHEMA),
    "conform_text": (q_conform_text, SQL_CONFORM_SCHEMA),
    "clean_names": (q_clean_names, SQL_CLEAN_NAMES),
    "access_lookup": (q_access_lookup, SQL_ACCESS_LOOKUP),
    "scan_limit": (q_scan_limit, SQL_SCAN_LIMIT),
}
