import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators import access, load, search
from fieldbook.sources import io
from conftest import rows


def test_search_list_rules(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, "a_c", 3.5), (3, None, None)], "id long, s string, x double")
    with pytest.raises(ValueError):
        search.search(df, "abc")
    with pytest.raises(ValueError):
        search.search(df, [])
    assert sorted(r.id for r in search.search(df, ["a_c"]).collect()) == [1, 2]          # '_' wildcard
    assert sorted(r.id for r in search.search(df, ["a_c"], literal=True).collect()) == [2]
    assert sorted(r.id for r in search.search(df, ["3.5", "zz"]).collect()) == [2]      # numbers as text
    assert search.search_one(df, "nothing").count() == 0


def test_search_table_equals_brute_force(spark):
    df = spark.createDataFrame([(1, "red widget", "x"), (2, "blue bolt", "ab"), (3, None, "zz9")],
                               "id long, a string, b string")
    kws = spark.createDataFrame([("widget",), ("bol",), ("ab",), ("z",), ("9",), ("none",), (None,)], "keyword string")
    got = rows(search.search_table(df, kws, "id"), "id", "keyword")
    brute = []
    for r in df.collect():
        text = "\u0001".join(v for v in (r.a, r.b) if v is not None)
        for k in ("widget", "bol", "ab", "z", "9", "none"):
            if k in text:
                brute.append((r.id, k))
    assert got == sorted(brute, key=lambda t: (str(t[0]), t[1]))


SCHEMA = T.StructType([T.StructField("col1", T.StringType()), T.StructField("col2", T.LongType())])


def test_conform_and_truncate_load(spark, tmp_dir):
    df = spark.createDataFrame([("7", "a", "z")], "col2 string, col1 string, extra string")
    c = load.conform(df, SCHEMA)
    assert c.columns == ["col1", "col2"] and c.collect()[0].col2 == 7
    missing = load.conform(spark.createDataFrame([("a",)], "col1 string"), SCHEMA)
    assert missing.collect()[0].col2 is None
    path = f"{tmp_dir}/master"
    load.truncate_load(df, path, SCHEMA)
    load.truncate_load(spark.createDataFrame([("b", "8")], "col1 string, col2 string"), path, SCHEMA)
    assert rows(io.read_table(spark, path)) == [("b", 8)]


def test_snapshot_read_while_writing_next(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    io.write_snapshot(spark.createDataFrame([(1,)], "x long"), path)
    cur = io.read_table(spark, path)
    io.write_snapshot(cur.withColumn("x", F.col("x") + 1), path)
    assert rows(io.read_table(spark, path)) == [(2,)]


def test_access_lookup_last_wins_and_unknown(spark):
    ua = spark.createDataFrame([("c1", "ann", "a@x", "g1", 1), ("c1", "ann2", "b@x", "g2", 2),
                                ("c2", "bob", "c@x", "g1", 1)],
                               "CWID string, user_name string, email string, access_group string, o long")
    ids = spark.createDataFrame([("c1",), ("c9",)], "CWID string")
    got = {r.CWID: (r.user_name, r.status) for r in access.lookup(ids, ua, order_col="o").collect()}
    assert got == {"c1": ("ann2", "valid"), "c9": (None, "not valid")}


def test_json_array_batch_keeps_order_and_key_presence(spark, tmp_dir):
    with open(f"{tmp_dir}/b.json", "w") as f:
        f.write('[{"id": "1", "strain_name": null}, {"id": "2"}, {"bcs_code": "x"}]')
    maps = io.read_json_maps(spark, tmp_dir)
    got = sorted((r.seq, r.fields) for r in maps.collect())
    assert got[0] == (1, {"id": "1", "strain_name": None})
    assert got[1] == (2, {"id": "2"})
    arr = io.read_json_array(spark, tmp_dir, T.StructType([T.StructField("bcs_code", T.StringType())]))
    assert [r.bcs_code for r in arr.orderBy("seq").collect()] == [None, None, "x"]


def test_json_lines_batch_order_follows_files(spark, tmp_dir):
    for name, vals in (("b.json", ["3", "4"]), ("a.json", ["1", "2"])):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join('{"bcs_code": "%s"}' % v for v in vals) + "\n")
    df = io.read_json_batch(spark, tmp_dir, T.StructType([T.StructField("bcs_code", T.StringType())]), seq_col="seq")
    assert [(r.seq, r.bcs_code) for r in df.orderBy("seq").collect()] == [(1, "1"), (2, "2"), (3, "3"), (4, "4")]


def test_read_folder_adds_file_path(spark, tmp_dir):
    for name in ("f1.csv", "f2.csv"):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("productid,feeding\n1,2.5\n")
    df = io.read_folder(spark, tmp_dir, "csv")
    assert sorted(r.file_path.rsplit("/", 1)[-1] for r in df.collect()) == ["f1.csv", "f2.csv"]


def test_json_array_files_numbered_across_files(spark, tmp_dir):
    for name, vals in (("b.json", ["3", "4"]), ("a.json", ["1", "2"])):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("[" + ",".join('{"bcs_code": "%s"}' % v for v in vals) + "]")
    arr = io.read_json_array(spark, tmp_dir, T.StructType([T.StructField("bcs_code", T.StringType())]))
    assert [(r.seq, r.bcs_code) for r in arr.orderBy("seq").collect()] == [(1, "1"), (2, "2"), (3, "3"), (4, "4")]


def test_table_helpers(spark, tmp_dir):
    from fieldbook.operators.ingest import now_in_zone
    from fieldbook.schemas import RUN_LOG
    path = f"{tmp_dir}/log"
    io.ensure_table(spark, path, RUN_LOG)
    io.ensure_table(spark, path, RUN_LOG)          # second call keeps the table
    t = io.read_table(spark, path)
    assert io.table_columns(t) == RUN_LOG.fieldNames() and t.count() == 0
    out = io.write_tables({"A": spark.range(3), "B": spark.range(2)}, f"{tmp_dir}/tables")
    assert io.read_table(spark, f"{tmp_dir}/tables/A").count() == 3 and sorted(out) == ["A", "B"]
    ts = spark.range(1).select(now_in_zone("Asia/Kolkata").alias("t")).collect()[0].t
    assert ts is not None


def test_now_in_zone_is_the_zone_wall_clock(spark):
    import datetime as dt
    from fieldbook.operators.ingest import now_in_zone
    got = spark.range(1).select(now_in_zone("Asia/Kolkata").alias("t")).collect()[0].t
    utc_now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((got - utc_now) - dt.timedelta(hours=5, minutes=30)) < dt.timedelta(minutes=2)


def test_read_folder_fails_on_an_undecodable_file_unless_told_to_skip(spark, tmp_dir):
    import glob
    import os
    import shutil
    spark.createDataFrame([(1, 2.0)], "productid long, feeding double").coalesce(1).write.parquet(f"{tmp_dir}/good")
    folder = f"{tmp_dir}/sheets"
    os.makedirs(folder)
    shutil.copy(glob.glob(f"{tmp_dir}/good/*.parquet")[0], f"{folder}/a.parquet")
    with open(f"{folder}/b.parquet", "wb") as f:
        f.write(b"not a parquet file")
    schema = T.StructType([T.StructField("productid", T.LongType()), T.StructField("feeding", T.DoubleType())])
    with pytest.raises(Exception):
        io.read_folder(spark, folder, "parquet", schema=schema).collect()
    df = io.read_folder(spark, folder, "parquet", schema=schema, skip_bad_files=True)
    assert [r.productid for r in df.collect()] == [1]


def test_torn_and_unfit_json_lines_are_rejects(spark, tmp_dir):
    lines = ['{"k": "a", "n": 1}', '{"k": "b", "n"', "", "[1]", '{"k": "c", "n": "x"}', '{"k": "d"} {"k": "e"}',
             '{"k": "f", "n": null}']
    with open(f"{tmp_dir}/b.json", "w") as f:
        f.write("\n".join(lines))
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    with pytest.raises(Exception, match="malformed JSON"):
        io.read_json_batch(spark, tmp_dir, schema).collect()
    good = io.read_json_batch(spark, tmp_dir, schema, seq_col="seq", on_bad="skip")
    assert [(r.seq, r.k, r.n) for r in good.orderBy("seq").collect()] == [(1, "a", 1), (2, "f", None)]
    bad = io.json_rejects(spark, tmp_dir, schema)
    assert sorted(r.record for r in bad.collect()) == sorted([lines[1], lines[3], lines[4], lines[5]])
    maps = io.read_json_maps(spark, tmp_dir, multiline=False, on_bad="skip")
    assert [r.fields for r in maps.orderBy("seq").collect()] == [
        {"k": "a", "n": "1"}, {"k": "c", "n": "x"}, {"k": "f", "n": None}]


def test_truncated_array_file_is_one_reject(spark, tmp_dir):
    for name, text in (("a.json", '[{"k": "1"}, {"k": "2"}]'), ("b.json", '[{"k": "3"}, {"k": '),
                       ("c.json", '{"k": "4"}'), ("d.json", '[{"k": "5"}, 6]')):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("k", T.StringType())])
    with pytest.raises(Exception, match="malformed JSON"):
        io.read_json_array(spark, tmp_dir, schema).collect()
    good = io.read_json_array(spark, tmp_dir, schema, on_bad="skip")
    assert [(r.seq, r.k) for r in good.orderBy("seq").collect()] == [(1, "1"), (2, "2"), (3, "4"), (4, "5")]
    bad = io.json_rejects(spark, tmp_dir, schema, multiline=True)
    assert sorted(r.record for r in bad.collect()) == ["6", '[{"k": "3"}, {"k": ']


def test_uncommitted_version_is_never_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(5).write.parquet(f"{path}/v=1")                   # a write stopped before its commit
    with pytest.raises(ValueError):
        io.read_table(spark, path)
    io.write_snapshot(spark.range(3), path)
    spark.range(7).write.parquet(f"{path}/v=2")
    assert io.read_table(spark, path).count() == 3
    io.write_snapshot(spark.range(4), path)                       # takes the place of the stopped one
    assert io.read_table(spark, path).count() == 4


def test_access_last_record_with_null_order(spark):
    ua = spark.createDataFrame([("c1", "ann", None), ("c1", "bea", None), ("c2", "cy", None), ("c2", "dan", 1)],
                               "CWID string, user_name string, o long")
    ids = spark.createDataFrame([("c1",), ("c2",)], "CWID string")
    got = {r.CWID: (r.user_name, r.status) for r in access.lookup(ids, ua, "o").collect()}
    assert got == {"c1": ("bea", "valid"), "c2": ("dan", "valid")}


def test_search_table_on_short_empty_and_wide_characters(spark):
    df = spark.createDataFrame([(1, "a\U0001F600b"), (2, ""), (3, "xy"), (4, "abcabc" * 5000)], "id long, t string")
    kws = spark.createDataFrame([("\U0001F600b",), ("xy",), ("y",), ("cab",), ("bcabca",), ("zzz",)], "keyword string")
    got = rows(search.search_table(df, kws, "id"), "id", "keyword")
    assert got == [(1, "\U0001F600b"), (3, "xy"), (3, "y"), (4, "bcabca"), (4, "cab")]


def _like(cell, pattern):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.search(out, cell, re.S) is not None


def test_search_table_with_wildcards_equals_brute_force(spark):
    rng = random.Random(6)
    cells = [(i, *("".join(rng.choice("ab%_\\é ") for _ in range(rng.randint(0, 9))) if rng.random() < .9 else None
                   for _ in range(2))) for i in range(150)]
    bodies = {"".join(rng.choice(["a", "b", "ab", "%", "_", r"\%", r"\_", "\\\\", "é"]) for _ in range(rng.randint(1, 6)))
              for _ in range(150)} | {"%", "_", "__%_", "a%b", "ab_ba"}
    df = spark.createDataFrame(cells, "id long, x string, y string")
    kws = spark.createDataFrame([(b,) for b in bodies] + [(None,), ("",), ("%",)], "keyword string")
    got = rows(search.search_table(df, kws, "id", literal=False), "id", "keyword")
    want = sorted({(i, b) for i, x, y in cells for b in bodies if any(c is not None and _like(c, b) for c in (x, y))},
                  key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got == want
    plan = search.search_table(df, kws, "id", literal=False)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert search.search_table(df, kws.limit(0), "id").count() == 0


@pytest.mark.parametrize("literal", [True, False])
def test_search_table_broadcasts_no_rows(spark, monkeypatch, literal):
    """Rows and their grams look small in files; only keywords may be broadcast, and those while they are short."""
    monkeypatch.setattr(search, "_SENT_CHARS", 0, raising=False)
    df = spark.range(300).select("id", F.concat(F.lit("name "), F.col("id")).alias("c"))
    kws = spark.createDataFrame([("ame 7",), ("12",), ("9",), ("zz",)], "keyword string")
    if not literal:
        kws = kws.unionByName(spark.createDataFrame([("_____",), ("me%1_5",)], "keyword string"))
    out = search.search_table(df, kws, "id", literal=literal)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and "BroadcastHashJoin [id#" not in plan
    got = {(r["id"], r["keyword"]) for r in out.collect()}
    words = [f"name {i}" for i in range(300)]
    want = {(i, k) for i, w in enumerate(words) for k in ("ame 7", "12", "9") if k in w}
    if not literal:
        want |= {(i, "_____") for i, w in enumerate(words) if len(w) >= 5}
        want |= {(i, "me%1_5") for i, w in enumerate(words) if re.search("me.*1.5", w)}
    assert got == want and out.count() == len(want)


def test_search_table_deals_rows_by_their_text(spark, monkeypatch):
    """One short file of rows becomes as many tasks as their characters ask for."""
    monkeypatch.setattr(search, "_TASK_CHARS", 1000, raising=False)
    df = spark.range(0, 500, 1, 1).select("id", F.repeat(F.lit("ab "), 20).alias("c"))
    out = search.search_table(df, spark.createDataFrame([("ab a",)], "keyword string"), "id")
    assert "hashpartitioning(id" in (plan := out._jdf.queryExecution().toString()) and ", 30), REPARTITION_BY_NUM" in plan
    assert out.count() == 500
