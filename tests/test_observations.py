import gzip
import os
import random
from pyspark.sql import functions as F

from fieldbook.functions.dates import date_tokens, parse_dmy
from fieldbook.operators import observations as obs
from fieldbook.sources import io
from conftest import rows


def test_unpivot_units_nulls_and_renames(spark):
    wide = spark.createDataFrame([(1, "p1", "aphid", 10.0, None, 3.0, "x")],
                                 "productid long, product string, pest string, feeding double, weight double, "
                                 "rootgms double, other string")
    long = obs.unpivot_observations(wide)
    got = rows(long, "product_id", "pest_name", "observation_name", "observation_value", "observation_unit")
    assert got == [(1, "aphid", "feeding", 10.0, "percentage"), (1, "aphid", "other", None, "unknown"),
                   (1, "aphid", "rootgms", 3.0, "gms"), (1, "aphid", "weight", None, "grams")]


def test_no_pest_column_gives_null_pest(spark):
    wide = spark.createDataFrame([(1, "p1", 5.0)], "productid long, product string, feeding double")
    long = obs.unpivot_observations(wide)
    assert [r.pest_name for r in long.collect()] == [None]


def test_date_tokens_and_invalid_dates(spark):
    df = spark.createDataFrame([("on 01.02.2023 and 31.02.2023, not 1.2.2023 or 111.02.2023",)], "t string")
    r = df.select(date_tokens("t").alias("a")).collect()[0]
    assert r.a == ["01.02.2023", "31.02.2023"]
    d = spark.createDataFrame([("31.02.2023",), ("29.02.2024",)], "t string").select(parse_dmy("t").alias("d"))
    assert [str(x.d) if x.d else None for x in d.collect()] == [None, "2024-02-29"]


def test_load_files_per_file_outcomes(spark):
    sheet = spark.createDataFrame([
        ("ok", 1, "p", 1.0, "2"),
        ("ok", 2, "q", None, "3"),
        ("noid", None, "p", 1.0, "1"),
        ("nodate", 3, "p", 1.0, "1"),
        ("baddate", 4, "p", 1.0, "1"),
        ("text", 5, "p", 1.0, "heavy"),
    ], "file_path string, productid long, product string, feeding double, weight string")
    data = spark.createDataFrame([
        ("ok", "from 05.01.2024", "to 20.03.2024"),
        ("ok", "mid 10.02.2024", None),
        ("noid", "01.01.2024", None),
        ("nodate", "no date here", "none"),
        ("baddate", "31.02.2023", "01.01.2023"),
        ("text", "01.01.2024", None),
    ], "file_path string, a string, b string")
    rows_out, log = obs.load_files(sheet, data, "2024-04-01 00:00:00")
    lg = {r.file_path: (r.rows_loaded, r.error_message) for r in log.collect()}
    assert lg == {"ok": (4, None), "noid": (0, obs.MSG_NO_ID), "nodate": (0, obs.MSG_NO_DATES),
                  "baddate": (0, obs.MSG_BAD_DATE), "text": (0, obs.MSG_BAD_VALUE)}
    got = rows(rows_out, "product_id", "observation_name", "observation_value", "date_created", "date_expired")
    assert len(got) == 4
    assert {(str(g[3]), str(g[4])) for g in got} == {("2024-01-05", "2024-03-20")}
    assert (2, "feeding", None, got[1][3], got[1][4]) in got  # NULL measure kept


def _write(folder, name, records):
    import json
    import os
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def test_folder_of_sheets_has_a_log_row_per_file_and_own_columns(spark, tmp_dir):
    from fieldbook.sources import io
    sheets = {
        "f1.json": [{"productid": 1, "product": "p", "feeding": 2.0}],
        "f2.json": [{"product": "q", "weight": 3.0}],                       # no productid column
        "f3.json": [{"productid": 3, "product": "r", "weight": 1}, '{"productid": 4, "prod'],
        "f4.json": [],                                                       # empty file
        "f5.json": [{"productid": "P-12", "product": "s", "weight": 1}],
        "f6.json": [{"productid": 6.0, "product": "t", "weight": 1}, {"productid": 7, "product": "t", "other": "2"}],
        "f7.json": [{"productid": 8, "feeding": 1}],
        "f 8.json": [{"productid": 9, "product": "u", "feeding": "much"}],
    }
    for name, recs in sheets.items():
        _write(f"{tmp_dir}/sheets", name, recs)
        _write(f"{tmp_dir}/data", name, [{"note": "on 02.03.2024"}])
    for _ in range(2):
        obs.load_folder(spark, f"{tmp_dir}/sheets", f"{tmp_dir}/data", "2024-04-01 00:00:00",
                        f"{tmp_dir}/table", f"{tmp_dir}/log")
    log = io.read_table(spark, f"{tmp_dir}/log").collect()
    assert len(log) == 2 * len(sheets)                                       # appended by the second run
    by_name = {r.file_path.replace("%20", " "): (r.rows_loaded, r.error_message) for r in log}
    assert by_name == {
        "f1.json": (1, None), "f2.json": (0, obs.MSG_NO_ID), "f3.json": (0, obs.MSG_UNREADABLE),
        "f4.json": (0, obs.MSG_NO_ID), "f5.json": (0, obs.MSG_BAD_ID), "f6.json": (4, None),
        "f7.json": (0, obs.MSG_NO_PRODUCT), "f 8.json": (0, obs.MSG_BAD_VALUE)}
    got = rows(io.read_table(spark, f"{tmp_dir}/table").distinct(), "product_id", "observation_name",
               "observation_value", "observation_unit")
    assert got == [(1, "feeding", 2.0, "percentage"), (6, "other", None, "unknown"), (6, "weight", 1.0, "grams"),
                   (7, "other", 2.0, "unknown"), (7, "weight", None, "grams")]


def test_text_product_id_rejects_the_file(spark):
    sheet = spark.createDataFrame([("a", "P-12", 1.0), ("b", "12", 1.0)],
                                  "file_path string, productid string, feeding double")
    data = spark.createDataFrame([("a", "01.01.2024"), ("b", "01.01.2024")], "file_path string, note string")
    rows_out, log = obs.load_files(sheet, data, "2024-04-01 00:00:00")
    assert {r.file_path: (r.rows_loaded, r.error_message) for r in log.collect()} == {
        "a": (0, obs.MSG_BAD_ID), "b": (1, None)}
    assert [r.product_id for r in rows_out.collect()] == [12]


def _sheet_folder(tmp_dir):
    rng = random.Random(1)
    lines = "".join('{"productid":%d,"feeding":"%s"}\n' % (i, "".join(rng.choices("abcdefghij", k=30))) for i in range(4000))
    packed = gzip.compress(lines.encode())
    bent = bytearray(packed)
    bent[len(bent) // 2] ^= 255
    files = {"good.json": lines.encode(), "ok.json.gz": packed, "cut.json.gz": packed[:len(packed) // 2],
             "bent.json.gz": bytes(bent), "junk.json.gz": b"no gzip", "empty.json": b"",
             "a name.json": b'\xef\xbb\xbf{"productid":1}\r\n{"productid":2}', "torn.json": b'{"productid":1}\n{"prod'}
    for name, data in files.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(data)


def test_unreadable_files_are_accounted_and_end_nothing(spark, tmp_dir):
    _sheet_folder(tmp_dir)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # good.json is read in several splits
    try:
        got, files = io.read_sheets(spark, tmp_dir, expected=[tmp_dir + "/gone.json", tmp_dir + "/good.json"])
        bad = {os.path.basename(r.file_path).replace("%20", " "): r.n_bad for r in files.collect()}
        n = {os.path.basename(r.file_path).replace("%20", " "): r["count"] for r in got.groupBy("file_path").count().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert bad == {"good.json": 0, "ok.json.gz": 0, "cut.json.gz": 1, "bent.json.gz": 1, "junk.json.gz": 1,
                   "empty.json": 0, "a name.json": 0, "torn.json": 1, "gone.json": 1}
    assert n == {"good.json": 4000, "ok.json.gz": 4000, "a name.json": 2, "torn.json": 1}


def test_a_file_that_vanishes_while_reading_is_incomplete(spark, tmp_dir):
    _sheet_folder(tmp_dir)
    _, files = io.read_sheets(spark, tmp_dir)
    os.remove(os.path.join(tmp_dir, "good.json"))  # listed, then gone
    assert {r.n_bad for r in files.collect() if r.file_path.endswith("/good.json")} == {1}


def test_csv_files_keep_their_own_headers(spark, tmp_dir):
    files = {"a.csv": 'productid,feeding,weight\n1,"2,5 ""x""",3\n,,\n4\n', "b.csv": "weight,productid,weight\r\n9,7,8\r\n",
             "more.csv": "x,y\n1,2,3\n", "torn.csv": 'x,y\n"1,2\n', "head.csv": "x,y\n", "none.csv": "",
             "blank.csv": "\n  \nx,y\n\n5,6\n"}
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(text)
    with open(os.path.join(tmp_dir, "z.csv.gz"), "wb") as f:
        f.write(gzip.compress(b"y,x\n1,2\n"))
    rows_, files_ = io.read_sheets(spark, tmp_dir, fmt="csv")
    got = [(os.path.basename(r.file_path), tuple(sorted(r.fields.items()))) for r in rows_.collect()]
    empty = (("feeding", None), ("productid", None), ("weight", None))
    want = [
        ("a.csv", (("feeding", '2,5 "x"'), ("productid", "1"), ("weight", "3"))), ("a.csv", empty),
        ("a.csv", (("feeding", None), ("productid", "4"), ("weight", None))), ("b.csv", (("productid", "7"), ("weight", "9"))),
        ("blank.csv", (("x", "5"), ("y", "6"))), ("z.csv.gz", (("x", "2"), ("y", "1")))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {os.path.basename(r.file_path): r.n_bad for r in files_.collect()} == {
        "a.csv": 0, "b.csv": 0, "more.csv": 1, "torn.csv": 1, "head.csv": 0, "none.csv": 0, "blank.csv": 0, "z.csv.gz": 0}


def test_header_reaches_every_split(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "long.csv"), "w") as f:
        f.write("b,a\n" + "".join(f"{i},{-i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        got, files = io.read_sheets(spark, tmp_dir, fmt="csv")
        assert got.rdd.getNumPartitions() > 3
        sums = got.selectExpr("sum(fields['a']) AS a", "sum(fields['b']) AS b", "count(*) AS n").first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (sums.a, sums.b, sums.n) == (-199990000, 199990000, 20000)
    assert files.first().n_bad == 0


def test_array_files_may_span_lines(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "batch.json"), "w") as f:
        f.write('[\n {"a": "1"},\n {"a": "2"}\n]\n')
    got = io.read_json_maps(spark, tmp_dir)
    assert [(r.seq, r.fields) for r in got.orderBy("seq").collect()] == [(1, {"a": "1"}), (2, {"a": "2"})]


def test_csv_records_are_parsed_once_and_lines_stay_with_few_files(spark, tmp_dir):
    """Rows of a folder are read from written records; a header after blank lines is found; lines are not moved to meet it."""
    from fieldbook.sources import io
    for name, text in {"a.csv": "\n \nproductid,feeding\n1,2\n", "b.csv": "feeding,productid\n5,6\n7\n1,2,3\n", "c.csv": "productid\n"}.items():
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    got, files = io.read_sheets(spark, tmp_dir, fmt="csv")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "Join" not in plan
    assert sorted(((r.file_path[-5:], r.fields["productid"], r.fields.get("feeding")) for r in got.collect()), key=str) == [
        ("a.csv", "1", "2"), ("b.csv", "6", "5"), ("b.csv", None, "7")]
    assert sorted((r.file_path[-5:], r.n_bad) for r in files.collect()) == [("a.csv", 0), ("b.csv", 1), ("c.csv", 0)]
