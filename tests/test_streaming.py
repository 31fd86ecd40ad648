import json
import os

from pyspark.sql import types as T

from fieldbook.sources import io
from fieldbook.streaming.ingest_stream import read_ingested, start_ingest

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("created_date", T.DateType()),
    T.StructField("last_updated_timestamp", T.TimestampNTZType()),
])
KEYS = ["name", "kind"]


def drop(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def run(spark, base, ckpt, mode="insert", **kw):
    q = start_ingest(spark, f"{base}/src", f"{base}/table", ckpt, KEYS, SCHEMA, mode=mode,
                     run_ts="2024-01-01 00:00:00", **kw)
    q.awaitTermination()
    assert q.exception() is None


def test_insert_stream_dedupes_and_replays(spark, tmp_dir):
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}, {"name": "b", "kind": "x"},
                                      {"name": "a", "kind": "x"}])
    run(spark, base, f"{base}/ck1")
    drop(f"{base}/src/d2", "b.json", [{"name": "b", "kind": "x"}, {"name": "c", "kind": "y"}])
    run(spark, base, f"{base}/ck1")
    t = read_ingested(spark, f"{base}/table")
    got = sorted((r.name, r.kind, r.id) for r in t.collect())
    assert got == [("a", "x", 1), ("b", "x", 2), ("c", "y", 3)]
    # a fresh checkpoint reads every file again: stored rows are rejected, nothing is added
    run(spark, base, f"{base}/ck2")
    assert read_ingested(spark, f"{base}/table").count() == 3


def test_upsert_stream_updates_and_inserts(spark, tmp_dir):
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}, {"name": "b", "kind": "x"}])
    run(spark, base, f"{base}/ck", mode="upsert", min_age=None)
    drop(f"{base}/src/d2", "b.json", [{"id": "1", "kind": "z"}, {"name": "c", "kind": "y"},
                                      {"name": "b", "kind": "x"}])
    run(spark, base, f"{base}/ck", mode="upsert", min_age=None)
    t = read_ingested(spark, f"{base}/table")
    got = sorted((r.id, r.name, r.kind) for r in t.collect())
    assert got == [(1, "a", "z"), (2, "b", "x"), (3, "c", "y")]
    # one committed version per micro-batch (+ the empty start)
    assert io.current_version(spark, f"{base}/table/data").endswith("v=3")


def test_insert_stream_goes_on_from_a_loaded_table_and_rejects_torn_lines(spark, tmp_dir):
    base = tmp_dir
    spark.createDataFrame([(5, "a", "x")], "id long, name string, kind string").selectExpr(
        "*", "DATE'2024-01-01' AS created_date", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_updated_timestamp",
    ).write.parquet(f"{base}/table/data/batch=init")
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}, '{"name": "to', {"name": "b", "kind": None}])
    run(spark, base, f"{base}/ck1")
    got = sorted((r.name, r.kind, r.id) for r in read_ingested(spark, f"{base}/table").collect())
    assert got == [("a", "x", 5), ("b", None, 6)]
    assert [r.record for r in spark.read.parquet(f"{base}/table/rejects").collect()] == ['{"name": "to']


def test_insert_stream_after_a_crash_between_ids_and_rows(spark, tmp_dir):
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}, {"name": "b", "kind": "x"}])
    run(spark, base, f"{base}/ck1")
    # a batch of another query recorded its highest id, and its rows never came
    spark.createDataFrame([(9,)], "id long").write.parquet(f"{base}/table/ids/batch=qlost-b0")
    drop(f"{base}/src/d2", "b.json", [{"name": "c", "kind": "y"}])
    run(spark, base, f"{base}/ck2")
    got = sorted((r.name, r.id) for r in read_ingested(spark, f"{base}/table").collect())
    assert got == [("a", 1), ("b", 2), ("c", 10)]


def test_upsert_stream_reports_explicit_null_and_unknown_field(spark, tmp_dir):
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}, {"name": "b", "kind": "x"}])
    run(spark, base, f"{base}/ck", mode="upsert", min_age=None)
    drop(f"{base}/src/d2", "b.json", [{"id": "1", "kind": None}, {"id": "2", "colour": "red"},
                                      {"id": 1, "kind": "late"}])
    run(spark, base, f"{base}/ck", mode="upsert", min_age=None)
    got = sorted((r.id, r.kind) for r in read_ingested(spark, f"{base}/table").collect())
    assert got == [(1, "x"), (2, "x")]
    out = spark.read.parquet(f"{base}/table/outcomes").where("batch LIKE '%-b1'")
    assert sorted((r.id, r.outcome) for r in out.collect()) == [(1, "duplicate"), (1, "error"), (2, "error")]


def test_stamps_are_fixed_per_batch_and_session_settings_stay(spark, tmp_dir):
    from fieldbook.session import ensure_defaults
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    ensure_defaults(spark)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}])
    q = start_ingest(spark, f"{base}/src", f"{base}/table", f"{base}/ck", KEYS, SCHEMA)
    q.awaitTermination()
    stamp = read_ingested(spark, f"{base}/table").collect()[0].last_updated_timestamp
    files = [f for f in os.listdir(f"{base}/table/stamps") if not f.startswith(".")]
    with open(f"{base}/table/stamps/{files[0]}") as f:
        assert f.read() == str(stamp)


def outcomes(spark, base, batch):
    out = spark.read.parquet(f"{base}/table/outcomes").where(f"batch LIKE '%-b{batch}'")
    return sorted((r.seq, r.name, r.outcome) for r in out.collect())


def test_a_micro_batch_does_not_read_the_stored_table(spark, tmp_dir):
    base = tmp_dir
    spark.createDataFrame([(5, "a", "x"), (6, "b", "x")], "id long, name string, kind string").selectExpr(
        "*", "DATE'2024-01-01' AS created_date", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_updated_timestamp",
    ).write.parquet(f"{base}/table/data/batch=init")
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}, {"name": "c", "kind": "x"}])
    run(spark, base, f"{base}/ck")
    assert outcomes(spark, base, 0) == [(1, "a", "exists"), (2, "c", "inserted")]
    # the stored rows cannot be read any more; a restart goes on from the state store
    for folder, _dirs, files in os.walk(f"{base}/table/data"):
        for f in files:
            if f.endswith(".parquet"):
                with open(os.path.join(folder, f), "wb") as out:
                    out.write(b"no parquet")
                if os.path.exists(crc := os.path.join(folder, f".{f}.crc")):
                    os.remove(crc)
    drop(f"{base}/src/d2", "b.json", [{"name": "b", "kind": "x"}, {"name": "c", "kind": "x"}, {"name": "d", "kind": "x"},
                                      {"name": "d", "kind": "x"}, {"name": "e", "kind": None}, {"name": "e", "kind": None}])
    run(spark, base, f"{base}/ck")
    assert outcomes(spark, base, 1) == [(1, "b", "exists"), (2, "c", "exists"), (3, "d", "inserted"), (4, "d", "duplicate"),
                                        (5, "e", "inserted"), (6, "e", "duplicate")]
    tag = [f for f in os.listdir(f"{base}/table/data") if f.endswith("-b1")][0]
    got = spark.read.schema(SCHEMA).parquet(f"{base}/table/data/{tag}")
    assert sorted((r.id, r.name) for r in got.collect()) == [(8, "d"), (9, "e")]


def test_a_replayed_micro_batch_gives_its_rows_again(spark, tmp_dir):
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}])
    run(spark, base, f"{base}/ck")
    drop(f"{base}/src/d2", "b.json", [{"name": "a", "kind": "x"}, {"name": "b", "kind": "x"}])
    run(spark, base, f"{base}/ck")
    # the ingest query lost its last commit, after its rows and the state's were written
    for f in ("1", ".1.crc"):
        os.remove(f"{base}/ck/commits/{f}")
    run(spark, base, f"{base}/ck")
    assert sorted((r.id, r.name) for r in read_ingested(spark, f"{base}/table").collect()) == [(1, "a"), (2, "b")]
    # the state lost its last commit as well
    for folder in (f"{base}/ck/commits", f"{base}/ck-keys/checkpoint/commits"):
        last = max(int(f) for f in os.listdir(folder) if f.isdigit())
        for f in (f"{last}", f".{last}.crc"):
            os.remove(f"{folder}/{f}")
    drop(f"{base}/src/d3", "c.json", [{"name": "b", "kind": "x"}, {"name": "c", "kind": "x"}])
    run(spark, base, f"{base}/ck")
    assert sorted((r.id, r.name) for r in read_ingested(spark, f"{base}/table").collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_rows_loaded_between_two_starts_are_seen(spark, tmp_dir):
    base = tmp_dir
    drop(f"{base}/src/d1", "a.json", [{"name": "a", "kind": "x"}])
    run(spark, base, f"{base}/ck")
    spark.createDataFrame([(7, "b", "x")], "id long, name string, kind string").selectExpr(
        "*", "DATE'2024-01-01' AS created_date", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_updated_timestamp",
    ).write.parquet(f"{base}/table/data/batch=loaded")
    drop(f"{base}/src/d2", "b.json", [{"name": "b", "kind": "x"}, {"name": "c", "kind": "x"}])
    run(spark, base, f"{base}/ck")
    got = sorted((r.id, r.name) for r in read_ingested(spark, f"{base}/table").collect())
    assert got == [(1, "a"), (7, "b"), (8, "c")]


def test_a_micro_batch_parses_its_lines_once(spark, tmp_dir, monkeypatch):
    """Lines are numbered unparsed, then written typed; labelled rows are written before both results are read."""
    from fieldbook.operators import ingest
    from fieldbook.streaming import ingest_stream

    numbered, labelled = [], []
    order, insert_new = ingest_stream.with_batch_order, ingest.insert_new
    monkeypatch.setattr(ingest_stream, "with_batch_order", lambda b, **kw: numbered.append(b.columns) or order(b, **kw))

    def spied(*args, **kw):
        new, outcomes = insert_new(*args, **kw)
        labelled.append([args[0]._jdf.queryExecution().optimizedPlan().toString(),
                         outcomes._jdf.queryExecution().optimizedPlan().toString()])
        return new, outcomes

    monkeypatch.setattr(ingest, "insert_new", spied)
    drop(f"{tmp_dir}/src", "a.json", [{"name": "a", "kind": "x"}, '{"name": "b"', {"name": "a", "kind": "x"}, {"name": "c", "kind": None}])
    run(spark, tmp_dir, f"{tmp_dir}/ckpt")
    assert numbered and all("fields" not in columns for columns in numbered)
    assert all("from_json" not in rows and "Join" not in out for rows, out in labelled)
    assert sorted((r.id, r.name, r.kind) for r in read_ingested(spark, f"{tmp_dir}/table").collect()) == [
        (1, "a", "x"), (2, "c", None)]
    bad = spark.read.parquet(f"{tmp_dir}/table/rejects").collect()
    assert [(r.seq, r.record, r.file_path[-6:]) for r in bad] == [(2, '{"name": "b"', "a.json")]
