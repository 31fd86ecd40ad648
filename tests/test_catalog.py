from pyspark.sql import functions as F

from fieldbook.functions.columns import canonical_array, replace_when_contains
from fieldbook.operators import catalog
from conftest import rows

RAW = [
    (1, "a,b", "x", "d1", "p1", "t1"),
    (2, "a, b", "x, y", None, "p1,p2", "t2"),
    (3, "", "y", "d2", None, "t3"),
    (4, None, None, "d1", "p2", "t4"),
    (5, "b,a,a", "z", "d1, d2", "p1", "t5"),
]
SCHEMA = "k long, Product_names string, crop string, Diseases string, pest string, Title string"


def raw(spark):
    return spark.createDataFrame(RAW, SCHEMA)


def test_split_strips_and_keeps_null_and_empty(spark):
    items = catalog.explode_list(raw(spark), "Product_names", "k", "n")
    got = rows(items, "k", "pos", "n")
    assert (2, 1, "b") in got            # 'a, b' stripped
    assert (3, 0, "") in got             # '' is one '' item
    assert (4, None, None) in got        # NULL list is one NULL row
    assert len(got) == 2 + 2 + 1 + 1 + 3


def test_dimensions_first_seen_ids(spark):
    t = catalog.normalise(raw(spark), "k")
    assert rows(t["Product"], "Product_Name", "Product_ID") == sorted(
        [("a", 1), ("b", 2), ("", 3), (None, 4)], key=lambda x: ((x[0] is None), str(x[0])))
    crop = {r.Crop_Name: r.Crop_ID for r in t["Crop"].collect()}
    assert crop == {"x": 1, "y": 2, None: 3, "z": 4}


def test_dimension_options_drop_null_and_empty(spark):
    d = catalog.dimension(raw(spark), "Product_names", "k", "n", "id", keep_null=False, drop_empty=True)
    assert rows(d, "n", "id") == [("a", 1), ("b", 2)]


def test_bridge_first_seen_and_null_links(spark):
    t = catalog.normalise(raw(spark), "k")
    got = [(r.Product_ID, r.Crop_ID, r.product_crop_ID) for r in t["productcrop"].orderBy("product_crop_ID").collect()]
    assert got == [(1, 1, 1), (2, 1, 2), (1, 2, 3), (2, 2, 4), (3, 2, 5), (4, 3, 6), (2, 4, 7), (1, 4, 8)]


def test_id_lists_order_empty_and_null(spark):
    t = catalog.normalise(raw(spark), "k")
    doc = {r.k: (r.Product_ID, r.Crop_ID, r.Disease_ID, r.Pest_ID, r.document_ID) for r in t["Document"].collect()}
    assert doc[1][0] == "1,2"
    assert doc[2][0] == "1,2"
    assert doc[3][0] == ""          # only empties -> ''
    assert doc[4][0] is None        # NULL list -> NULL
    assert doc[5][0] == "2,1,1"     # list order, repeats kept
    assert doc[2][1] == "1,2"
    assert sorted(v[4] for v in doc.values()) == [1, 2, 3, 4, 5]
    assert "Title" in t["Document"].columns and "Product_names" not in t["Document"].columns


def _chain_sql(spark, t, distinct):
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    agg = "collect_set" if distinct else "collect_list"
    return spark.sql(f"""
        SELECT p.Product_ID, p.Product_Name, {agg}(c.Crop_Name) AS crops, {agg}(d.Disease_Name) AS diseases,
               {agg}(pe.Pest_Name) AS pests, count(*) AS n
        FROM Product p JOIN productcrop pc ON p.Product_ID = pc.Product_ID JOIN Crop c ON c.Crop_ID = pc.Crop_ID
        JOIN productdisease pd ON pd.Product_ID = p.Product_ID JOIN Disease d ON pd.Disease_ID = d.Disease_ID
        JOIN productpest ppe ON ppe.Product_ID = p.Product_ID JOIN Pest pe ON ppe.Pest_ID = pe.Pest_ID
        GROUP BY p.Product_Name, p.Product_ID""")


def _canon(df):
    return rows(df.select("Product_ID", *[canonical_array(c).alias(c) for c in ("crops", "diseases", "pests")]))


def test_product_details_equals_join_chain(spark):
    t = catalog.normalise(raw(spark), "k")
    args = (t["Product"], t["productcrop"], t["Crop"], t["productdisease"], t["Disease"], t["productpest"], t["Pest"])
    for distinct in (False, True):
        got = catalog.product_details(*args, distinct=distinct)
        ref = _chain_sql(spark, t, distinct)
        assert _canon(got) == _canon(ref)
    # array length = nc * nd * np when NULL names are kept (NULL list members)
    raw_form = catalog.product_details(*args, keep_nulls=True)
    lens = {r.Product_ID: (len(r.crops), len(r.diseases), len(r.pests)) for r in raw_form.collect()}
    ref = {r.Product_ID: r.n for r in _chain_sql(spark, t, False).collect()}
    assert all(v == (ref[k],) * 3 for k, v in lens.items())


def test_product_missing_a_bridge_drops_out(spark):
    t = catalog.normalise(raw(spark), "k")
    pest_less = t["productpest"].where(F.col("Product_ID") != 1)
    got = catalog.product_details(t["Product"], t["productcrop"], t["Crop"], t["productdisease"], t["Disease"],
                                  pest_less, t["Pest"])
    assert 1 not in [r.Product_ID for r in got.collect()]


def test_document_details_equals_unnest_joins(spark):
    t = catalog.normalise(raw(spark), "k")
    got = catalog.document_details(t["Document"], t["Product"], t["Crop"], t["Disease"], t["Pest"], ["k", "Title"])
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    ref = spark.sql("""
        WITH x AS (
          SELECT d.k, d.Title, pid, did, cid, eid FROM Document d
          LATERAL VIEW OUTER explode(split(d.Product_ID, ',')) up AS pid
          LATERAL VIEW OUTER explode(split(d.Disease_ID, ',')) ud AS did
          LATERAL VIEW OUTER explode(split(d.Crop_ID, ',')) uc AS cid
          LATERAL VIEW OUTER explode(split(d.Pest_ID, ',')) ue AS eid)
        SELECT d.k, d.Title, P.Product_Name,
               transform(collect_list(struct(Di.Disease_Name AS v)), e -> e.v) AS Disease_Names,
               transform(collect_list(struct(C.Crop_Name AS v)), e -> e.v) AS Crop_Names,
               transform(collect_list(struct(Pe.Pest_Name AS v)), e -> e.v) AS Pest_Names
        FROM x d
        LEFT JOIN Product P ON P.Product_ID = try_cast(pid AS BIGINT)
        LEFT JOIN Disease Di ON Di.Disease_ID = try_cast(did AS BIGINT)
        LEFT JOIN Crop C ON C.Crop_ID = try_cast(cid AS BIGINT)
        LEFT JOIN Pest Pe ON Pe.Pest_ID = try_cast(eid AS BIGINT)
        GROUP BY P.Product_Name, d.k, d.Title""")

    def canon(df):
        cols = ("Disease_Names", "Crop_Names", "Pest_Names")
        return rows(df.select("k", "Product_Name", *[canonical_array(c).alias(c) for c in cols],
                              *[F.size(c).alias("n_" + c) for c in cols]))
    assert canon(got) == canon(ref)


def test_rewrite_when_contains_hits_longer_names(spark):
    df = spark.createDataFrame([("Product 6",), ("Product 60",), ("Product 5",), (None,)], "n string")
    out = [r.m for r in df.select(replace_when_contains("n", "Product 6", "p1, p2").alias("m")).collect()]
    assert out == ["p1, p2", "p1, p2", "Product 5", None]


def test_dimension_keeps_existing_ids(spark):
    existing = spark.createDataFrame([("b", 7), ("q", 3)], "n string, id long")
    d = catalog.dimension(raw(spark), "Product_names", "k", "n", "id", existing=existing)
    assert rows(d, "n", "id") == sorted([("b", 7), ("q", 3), ("a", 8), ("", 9), (None, 10)],
                                        key=lambda x: ((x[0] is None), str(x[0])))


def test_standalone_bridge_matches_normalise(spark):
    r = raw(spark)
    t = catalog.normalise(r, "k")
    b = catalog.bridge(r, "Product_names", "crop", t["Product"], t["Crop"], "k", "Product_Name", "Product_ID",
                       "Crop_Name", "Crop_ID", "product_crop_ID")
    assert rows(b, "Product_ID", "Crop_ID", "product_crop_ID") == rows(
        t["productcrop"], "Product_ID", "Crop_ID", "product_crop_ID")


def test_id_list_from_raw(spark):
    r = raw(spark)
    d = catalog.dimension(r, "Product_names", "k", "Product_Name", "Product_ID")
    got = {x.k: x.Product_ID for x in catalog.id_list(r, "Product_names", d, "k", "Product_Name", "Product_ID").collect()}
    assert got == {1: "1,2", 2: "1,2", 3: "", 4: None, 5: "2,1,1"}


DELTA_DDL = "key long, title string, Product_names string, crop string, Diseases string, pest string"
BASE = [(1, "a", "p1, p2", "c1", None, "e1"), (2, "b", "p2", "c1,c2", "d1", ""), (3, "c", None, "c2", "d1", "e1")]
MORE = [(4, "d", "p3,p1", "c3", "d2,d1", "e1"), (5, "e", "p2", "c1", "", None), (6, "f", None, None, None, "e9"),
        (7, "g", "p3", "c3,c1", "d2", "e1,e1")]


def _tables(t):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in t.items()}


def test_delta_gives_what_one_run_gives(spark):
    whole = catalog.normalise(spark.createDataFrame(BASE + MORE, DELTA_DDL), "key")
    state = dict(catalog.normalise(spark.createDataFrame(BASE, DELTA_DDL), "key"))
    for rows_ in (MORE[:2], MORE[2:], []):
        added = catalog.normalise_more(spark.createDataFrame(rows_, DELTA_DDL), state, "key")
        state = catalog.merge_tables(state, added, "key")
    assert _tables(state) == _tables(whole)


def test_delta_adds_only_new_rows_and_keeps_the_number_of_a_changed_document(spark):
    state = dict(catalog.normalise(spark.createDataFrame(BASE, DELTA_DDL), "key"))
    added = catalog.normalise_more(spark.createDataFrame([(2, "B", "p9", "c1", "d1", "e1"), (9, "n", "p1", "c1", None, "e1")],
                                                         DELTA_DDL), state, "key")
    names = _tables(added)
    assert [r[0] for r in names["Product"]] == ["p9"] and names["Crop"] == [] and names["Pest"] == []
    assert len(names["productcrop"]) == 1  # p9-c1; p1-c1 is stored
    before = {r.key: r.document_ID for r in state["Document"].collect()}
    after = {r.key: (r.document_ID, r.title) for r in catalog.merge_tables(state, added, "key")["Document"].collect()}
    assert after == {1: (before[1], "a"), 2: (before[2], "B"), 3: (before[3], "c"), 9: (4, "n")}


def test_delta_onto_empty_tables(spark):
    empty = dict(catalog.normalise(spark.createDataFrame([], DELTA_DDL), "key"))
    added = catalog.normalise_more(spark.createDataFrame(BASE, DELTA_DDL), empty, "key")
    assert _tables(added) == _tables(catalog.normalise(spark.createDataFrame(BASE, DELTA_DDL), "key"))


def test_document_details_strict_and_counted(spark):
    import pytest
    from fieldbook.operators import catalog
    dims = [spark.createDataFrame([(1, "a"), (2, "b")], f"{n}_ID long, {n}_Name string")
            for n in ("Product", "Crop", "Disease", "Pest")]
    ddl = "document_ID long, Title string, Product_ID string, Crop_ID string, Disease_ID string, Pest_ID string"
    good = spark.createDataFrame([(1, "t", "1", "1,2,1", "2", None), (2, "t", "1", "9", "2", "1")], ddl)
    got = catalog.document_details(good, *dims, detail_columns=["Title"], strict=True, counted=True).collect()
    assert [(r.Product_Name, [tuple(x) for x in r.Crop_Names], [tuple(x) for x in r.Disease_Names],
             [tuple(x) for x in r.Pest_Names]) for r in got] == [
        ("a", [(None, 1), ("a", 2), ("b", 1)], [("b", 4)], [(None, 3), ("a", 1)])]
    bad = spark.createDataFrame([(1, "t", "1", "1,x", "2", "1")], ddl)
    assert catalog.document_details(bad, *dims, detail_columns=["Title"]).count() == 1
    with pytest.raises(Exception, match="not an id: x"):
        catalog.document_details(bad, *dims, detail_columns=["Title"], strict=True).collect()
