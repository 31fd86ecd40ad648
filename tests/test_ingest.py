import itertools
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators import ingest
from fieldbook.schemas import STRAIN_BATCH, STRAIN_KEYS, STRAIN_NESTED, STRAIN_TABLE
from conftest import rows

KEYS = STRAIN_KEYS


def strain(tag, **over):
    d = {k: f"{k[:4]}-{tag}" for k in KEYS}
    d.update(over)
    return d


def batch_df(spark, dicts):
    schema = T.StructType([T.StructField("seq", T.LongType())] + STRAIN_BATCH.fields)
    return spark.createDataFrame([(i + 1, *[d.get(k) for k in KEYS]) for i, d in enumerate(dicts)], schema)


def stored_df(spark, dicts, start_id=1):
    data = [(start_id + i, *[d.get(k) for k in KEYS], None, None) for i, d in enumerate(dicts)]
    return spark.createDataFrame(data, STRAIN_TABLE)


def outcomes(df):
    return [r.outcome for r in df.orderBy("seq").collect()]


def test_insert_new_outcomes(spark):
    stored = stored_df(spark, [strain("s1"), strain("nul", synonyms=None)])
    batch = batch_df(spark, [strain("n1"), strain("s1"), strain("n1"), strain("nul", synonyms=None),
                             strain("n2")])
    new, out = ingest.insert_new(batch, stored, KEYS, "seq", "2024-05-01 10:00:00", with_ids=True)
    # new row; stored row; duplicate in batch; NULL key never matches (re-inserted)
    assert outcomes(out) == ["inserted", "exists", "duplicate", "inserted", "inserted"]
    got = {r.seq: (r.id, r.created_date.isoformat(), str(r.last_updated_timestamp)) for r in new.collect()}
    assert got == {1: (3, "2024-05-01", "2024-05-01 10:00:00"), 4: (4, "2024-05-01", "2024-05-01 10:00:00"),
                   5: (5, "2024-05-01", "2024-05-01 10:00:00")}


def test_null_safe_option_matches_null_keys(spark):
    stored = stored_df(spark, [strain("nul", synonyms=None)])
    batch = batch_df(spark, [strain("nul", synonyms=None)])
    out = ingest.classify_new(batch, stored, KEYS, "seq", null_safe=True)
    assert outcomes(out) == ["exists"]


def test_second_run_inserts_nothing(spark):
    stored = stored_df(spark, [strain("s1")])
    batch = batch_df(spark, [strain("a"), strain("b"), strain("a")])
    new, _ = ingest.insert_new(batch, stored, KEYS, "seq", "2024-01-01 00:00:00", with_ids=True)
    stored2 = stored.unionByName(new.select(*stored.columns))
    _, out2 = ingest.insert_new(batch, stored2, KEYS, "seq", "2024-01-01 00:00:00")
    assert "inserted" not in outcomes(out2)
    ids = sorted(r.id for r in stored2.collect())
    assert ids == [1, 2, 3]


def test_keys_matched_by_name_not_position(spark):
    stored = stored_df(spark, [strain("s1")])
    d = strain("s1")
    schema = T.StructType([T.StructField("seq", T.LongType())]
                          + [T.StructField(k, T.StringType()) for k in reversed(KEYS)])
    batch = spark.createDataFrame([(1, *[d[k] for k in reversed(KEYS)])], schema)
    assert outcomes(ingest.classify_new(batch, stored, KEYS, "seq")) == ["exists"]


def test_unknown_field_dropped(spark):
    batch = batch_df(spark, [strain("a")]).withColumn("extra", F.lit("x"))
    kept = ingest.keep_known(batch, STRAIN_TABLE.fieldNames() + ["seq"])
    assert "extra" not in kept.columns and "bcs_code" in kept.columns


def test_empty_stored_table_ids_start_at_one(spark):
    stored = spark.createDataFrame([], STRAIN_TABLE)
    batch = batch_df(spark, [strain("a"), strain("b")])
    new, out = ingest.insert_new(batch, stored, KEYS, "seq", "2024-01-01 00:00:00", with_ids=True)
    assert sorted(r.id for r in new.collect()) == [1, 2]


def test_all_or_nothing_gate(spark):
    stored = stored_df(spark, [strain("s1")], start_id=10)
    b = batch_df(spark, [strain("a"), strain("s1"), strain("b"), strain("c")])
    b = b.withColumn("batch_id", F.when(F.col("seq") <= 2, 1).otherwise(2))
    new, gated = ingest.insert_all_or_nothing(b, stored, KEYS, "seq", "2024-01-01 00:00:00", batch_col="batch_id")
    assert outcomes(gated) == ["rejected", "rejected", "inserted", "inserted"]
    assert sorted((r.seq, r.id) for r in new.collect()) == [(3, 11), (4, 12)]


def _upd_stored(spark):
    data = [(1, *[f"v{i}" for i in range(len(KEYS))], None, None)]
    df = spark.createDataFrame(data, STRAIN_TABLE)
    return df.withColumn("created_date", F.lit("2024-01-01").cast("date")).withColumn(
        "last_updated_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).unionByName(
        spark.createDataFrame([(2, *[f"w{i}" for i in range(len(KEYS))], None, None)], STRAIN_TABLE)
        .withColumn("created_date", F.lit("2024-01-01").cast("date"))
        .withColumn("last_updated_timestamp", F.lit("2024-06-01 11:55:00").cast("timestamp_ntz")))


def _updates(spark, items):
    return spark.createDataFrame(items, "seq long, id long, fields map<string,string>")


def test_partial_update_cases(spark):
    stored = _upd_stored(spark)
    ups = _updates(spark, [
        (1, 1, {"strain_name": "new-name"}),             # known id, old enough -> updated
        (2, 1, {"strain_name": "second"}),              # second update of id 1 -> duplicate
        (3, 2, {"strain_name": "x"}),                   # updated 5 minutes ago -> guarded
        (4, 99, {"strain_name": "x"}),                  # unknown id
    ])
    tbl, out = ingest.apply_updates(stored, ups, "2024-06-01 12:00:00")
    assert outcomes(out) == ["updated", "duplicate", "guarded", "unknown_id"]
    t = {r.id: r for r in tbl.collect()}
    assert t[1].strain_name == "new-name" and t[1].bcs_code == "v0"
    assert str(t[1].last_updated_timestamp) == "2024-06-01 12:00:00"
    assert t[2].strain_name == "w2" and str(t[2].last_updated_timestamp) == "2024-06-01 11:55:00"


def test_explicit_null_and_unknown_field_are_errors(spark):
    stored = _upd_stored(spark)
    ups = _updates(spark, [(1, 1, {"strain_name": None}), (2, 2, {"nope": "x"})])
    tbl, out = ingest.apply_updates(stored, ups, "2030-01-01 00:00:00")
    assert outcomes(out) == ["error", "error"]
    assert {r.id: r.strain_name for r in tbl.collect()} == {1: "v2", 2: "w2"}


def test_last_duplicate_option(spark):
    stored = _upd_stored(spark)
    ups = _updates(spark, [(1, 1, {"strain_name": "a"}), (2, 1, {"strain_name": "b"})])
    tbl, out = ingest.apply_updates(stored, ups, "2030-01-01 00:00:00", duplicate="last")
    assert outcomes(out) == ["duplicate", "updated"]
    assert {r.id: r.strain_name for r in tbl.collect()}[1] == "b"


def test_upsert_three_way(spark):
    stored = _upd_stored(spark)
    existing = {k: f"v{i}" for i, k in enumerate(KEYS)}
    batch = spark.createDataFrame([
        (1, {"id": "1", "synonyms": "syn"}),
        (2, existing),
        (3, {k: f"n{i}" for i, k in enumerate(KEYS)}),
    ], "seq long, fields map<string,string>")
    tbl, out = ingest.upsert(stored, batch, KEYS, "2030-01-01 00:00:00")
    assert outcomes(out) == ["updated", "exists", "inserted"]
    assert [r.id for r in out.orderBy("seq").collect()] == [1, None, 3]
    t = {r.id: r for r in tbl.collect()}
    assert sorted(t) == [1, 2, 3] and t[1].synonyms == "syn" and t[3].bcs_code == "n0"


def test_loose_exists_accepts_swapped_columns(spark):
    stored = spark.createDataFrame([("x", "y", "z")], "a string, b string, c string")
    batch = spark.createDataFrame([(1, "y", "x", "z"), (2, "x", "y", "q"), (3, "z", "y", "x"), (4, None, "y", "x")],
                                  "rid long, a string, b string, c string")
    got = {r.rid: r.present for r in ingest.loose_exists(batch, stored, "rid").collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}
    stored_n = spark.createDataFrame([("x", None)], "a string, b string")
    batch_n = spark.createDataFrame([(1, None, "x"), (2, "x", "x")], "rid long, a string, b string")
    got = {r.rid: r.present for r in ingest.loose_exists(batch_n, stored_n, "rid").collect()}
    assert got == {1: True, 2: False}


def test_row_difference_keeps_duplicates_and_null_equal(spark):
    t = spark.createDataFrame([(1, None), (2, "b")], "x long, y string")
    b = spark.createDataFrame([(1, None), (3, "c"), (3, "c"), (2, "b")], "x long, y string")
    assert rows(ingest.row_difference(b, t)) == [(3, "c"), (3, "c")]


def test_flatten_nested_payload(spark):
    form = lambda i: {f: f"{f[:3]}{i}" for f in ["amt_of_active_ingredients", "formulation_type", "physical_state",
                                                 "formulated_or_wholebroth", "product_type"]}
    parent = {k: "p" for k in STRAIN_NESTED.fieldNames() if k != "formulation"}
    recs = [
        {**parent, "sp_code": None, "formulation": [form(1), form(2)]},
        {**parent, "formulation": [form(3), form(4)]},
        {**parent, "sp_code": "1", "formulation": [form(1), form(2)]},
        {**parent, "formulation": [form(3), form(4)]},
        {**parent, "formulation": []},
    ]
    df = spark.createDataFrame([tuple(r.get(f) for f in STRAIN_NESTED.fieldNames()) for r in recs], STRAIN_NESTED)
    flat = ingest.flatten(df)
    assert flat.count() == 8
    assert set(KEYS) <= set(flat.columns)
    assert flat.select(*KEYS).distinct().count() == 6


def test_stamp_keeps_given_values(spark):
    df = spark.createDataFrame([("2020-02-02",), (None,)], "created_date string")
    out = ingest.stamp(df, "2024-03-04 05:06:07", keep_given=True).collect()
    assert [r.created_date.isoformat() for r in out] == ["2020-02-02", "2024-03-04"]


def test_single_batch_gate_without_batch_column(spark):
    stored = stored_df(spark, [strain("s1")])
    clean = batch_df(spark, [strain("a"), strain("b")])
    dirty = batch_df(spark, [strain("a"), strain("s1")])
    assert outcomes(ingest.gate_all(clean, stored, KEYS)) == ["inserted", "inserted"]
    assert outcomes(ingest.gate_all(dirty, stored, KEYS)) == ["rejected", "rejected"]


def test_add_rows_replace_restamps_all(spark):
    table = spark.createDataFrame([("x", "y", None, None)],
                                  "a string, b string, created_date date, last_updated_timestamp timestamp_ntz")
    batch = spark.createDataFrame([(1, "y", "x", "junk"), (2, "q", "r", "junk")], "rid long, a string, b string, extra string")
    out = ingest.add_rows_replace(table, batch, "rid", "2024-02-02 00:00:00")
    got = sorted((r.a, r.b, str(r.created_date)) for r in out.collect())
    assert got == [("q", "r", "2024-02-02"), ("x", "y", "2024-02-02")]


def test_loose_exists_with_constant_column_picks_selective_keys(spark):
    stored = spark.createDataFrame([(str(i), "1", f"n{i}") for i in range(50)], "a string, sp string, c string")
    batch = spark.createDataFrame([(1, "7", "1", "n7"), (2, "n7", "7", "1"), (3, "7", "1", "n8")],
                                  "rid long, a string, sp string, c string")
    got = {r.rid: r.present for r in ingest.loose_exists(batch, stored, "rid").collect()}
    assert got == {1: True, 2: True, 3: False}


def test_nested_json_batch_missing_field_is_null(spark, tmp_dir):
    import json as _json
    recs = [
        {"bcs_code": "b1", "sp_code": None, "formulation": [{"formulation_type": "wp", "product_type": "t"}]},
        {"bcs_code": "b2", "formulation": []},
    ]
    with open(f"{tmp_dir}/n.json", "w") as f:
        f.write(_json.dumps(recs))
    from fieldbook.sources import io
    nested = io.read_json_array(spark, tmp_dir, STRAIN_NESTED)
    flat = ingest.flatten(nested.drop("seq"))
    got = flat.collect()
    assert len(got) == 1 and got[0].bcs_code == "b1" and got[0].physical_state is None


def test_default_now_is_current_wall_clock(spark):
    stored = _upd_stored(spark)  # stamps from 2024: old enough for the 13-minute guard
    ups = _updates(spark, [(1, 1, {"strain_name": "n"})])
    _, out = ingest.apply_updates(stored, ups, None)
    assert outcomes(out) == ["updated"]


def test_update_ignores_a_given_stamp_and_sets_a_given_date(spark):
    stored = spark.createDataFrame([(1, "a")], "id long, name string").selectExpr(
        "*", "DATE'2024-01-01' AS created_date", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_updated_timestamp")
    upd = spark.createDataFrame([(1, 1, {"name": "b", "created_date": "2023-05-06",
                                         "last_updated_timestamp": "1999-01-01 00:00:00"})],
                                "seq long, id long, fields map<string,string>")
    tbl, out = ingest.apply_updates(stored, upd, "2024-02-01 00:00:00")
    r = tbl.collect()[0]
    assert (r.name, str(r.created_date), str(r.last_updated_timestamp)) == ("b", "2023-05-06", "2024-02-01 00:00:00")
    assert [x.outcome for x in out.collect()] == ["updated"]


def test_insert_of_a_value_that_does_not_cast_is_an_error(spark):
    stored = spark.createDataFrame([(1, "a", 5)], "id long, name string, qty long").selectExpr(
        "*", "DATE'2024-01-01' AS created_date", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS last_updated_timestamp")
    batch = spark.createDataFrame([(1, {"name": "b", "qty": "abc"}), (2, {"name": "c", "qty": None}),
                                   (3, {"name": "d", "qty": "7"})], "seq long, fields map<string,string>")
    tbl, out = ingest.upsert(stored, batch, ["name", "qty"], "2024-02-01 00:00:00")
    assert sorted((r.seq, r.id, r.outcome) for r in out.collect()) == [
        (1, None, "error"), (2, 2, "inserted"), (3, 3, "inserted")]
    assert sorted((r.id, r.name, r.qty) for r in tbl.collect() if r.id > 1) == [(2, "c", None), (3, "d", 7)]


def test_loose_exists_of_repeated_and_missing_values_equals_brute_force(spark):
    import itertools
    vals = ["1", "2", None]
    stored_rows = [("1", "1", "2"), (None, "2", "2"), ("1", None, None), ("2", "2", "2")]
    stored = spark.createDataFrame(stored_rows, "a string, b string, c string")
    batch_rows = [(i, *t) for i, t in enumerate(itertools.product(vals, repeat=3))]
    batch = spark.createDataFrame(batch_rows, "rid long, a string, b string, c string")
    got = {r.rid: r.present for r in ingest.loose_exists(batch, stored, "rid").collect()}
    assert got == {r[0]: any(set(s) <= set(r[1:]) for s in stored_rows) for r in batch_rows}


def test_insert_new_with_one_key_in_a_third_of_the_rows(spark):
    batch = spark.range(9000).selectExpr("id AS seq", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k")
    stored = spark.range(100).selectExpr("id", "CAST(id AS STRING) AS k")
    out = ingest.classify_new(batch, stored, ["k"], "seq").groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in out} == {"duplicate": 2999, "exists": 66, "inserted": 5935}


def test_containment_where_all_columns_have_few_values(spark):
    """700 rows against 20,000 of four columns with 50 values: keys must grow to stay selective."""
    rng = random.Random(5)
    values = [str(i) for i in range(50)]
    stored = [tuple(rng.choice(values) for _ in range(4)) for _ in range(20000)]
    batch = [(i, *(rng.choice(values) for _ in range(4))) for i in range(600)]
    batch += [(600 + i, *rng.sample(stored[i], 4)) for i in range(100)] + [(700, None, "1", "2", "3")]
    stored += [(None, "1", None, "3")]
    known = {frozenset(s) for s in stored}

    def contained(row):
        vals = list(dict.fromkeys(row))
        return any(frozenset(c) in known for n in range(1, 5) for c in itertools.combinations(vals, n))

    s = spark.createDataFrame(stored, "a string, b string, c string, d string")
    b = spark.createDataFrame(batch, "rid long, a string, b string, c string, d string")
    for few in (1, 16):
        got = {r.rid: r.present for r in ingest.loose_exists(b, s, "rid", few=few).collect()}
        assert got == {r[0]: contained(r[1:]) for r in batch}
        assert sum(got.values()) >= 100


def test_containment_of_empty_tables(spark):
    b = spark.createDataFrame([(1, "x", "_s")], "rid long, a string, _s string")
    assert [r.present for r in ingest.loose_exists(b, b.limit(0), "rid").collect()] == [False]
    assert ingest.loose_exists(b.limit(0), b, "rid").count() == 0
    assert [r.present for r in ingest.loose_exists(b, b, "rid").collect()] == [True]


def test_contained_sets_of_many_rows_are_dealt_and_frequent_values_broadcast(spark, monkeypatch):
    """With small tasks every step is dealt, probes of frequent values alone meet few keys; as brute force, also with one bucket."""
    import random
    rng = random.Random(7)
    pick = lambda: (str(rng.randrange(60)) if rng.random() < 0.6 else rng.choice("xyz") if rng.random() < 0.9 else None)
    batch = [(i, pick(), pick(), pick()) for i in range(300)]
    stored = [(pick(), pick(), pick()) for _ in range(200)] + [("x", "x", "y"), ("59", "58", "57")]
    b = spark.createDataFrame(batch, "rid long, a string, b string, c string")
    s = spark.createDataFrame(stored, "a string, b string, c string")
    want = {r[0]: any(set(t) <= set(r[1:]) for t in stored) for r in batch}
    assert set(want.values()) == {True, False}
    dealt = []
    monkeypatch.setattr(ingest, "_TASK_SETS", 20)
    deal = ingest._deal
    monkeypatch.setattr(ingest, "_deal", lambda df, key, size: dealt.append(
        deal(df, key, size).rdd.getNumPartitions() if size > 200 else 0) or deal(df, key, size))
    for buckets, few, sent in ((1 << 16, 16, 100_000), (1, 1, 0)):
        monkeypatch.setattr(ingest, "_BUCKETS", buckets)
        monkeypatch.setattr(ingest, "_SENT_KEYS", sent)
        out = ingest.loose_exists(b, s, "rid", few=few)
        assert {r.rid: r.present for r in out.collect()} == want and out.columns == ["rid", "a", "b", "c", "present"]
    assert max(dealt) >= 10  # of the session's 8
