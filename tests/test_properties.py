"""Property tests (hypothesis) on small random fixtures, checked against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldbook.functions.columns import canonical_array
from fieldbook.operators import catalog, ingest
from fieldbook.operators.ids import dense_ids

SETTINGS = dict(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

names = st.sampled_from(["a", "b", "c", " d", "e ", ""])
lists = st.one_of(st.none(), st.lists(names, min_size=1, max_size=4).map(",".join))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 1000)), min_size=0, max_size=60, unique=True))
def test_dense_ids_is_a_rank(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {(r.a, r.b): r.id for r in dense_ids(df, ["a", "b"], "id", buckets=3).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(pairs))}


@settings(**SETTINGS)
@given(st.lists(st.tuples(lists, lists, lists, lists), min_size=1, max_size=12))
def test_normalise_then_product_details_matches_join_chain(spark, docs):
    raw = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)],
                                "k long, Product_names string, crop string, Diseases string, pest string")
    t = catalog.normalise(raw, "k")
    # dimensions: distinct stripped names in first-seen order
    seen = []
    for d in docs:
        items = [None] if d[0] is None else [x.strip() for x in d[0].split(",")]
        for x in items:
            if x not in seen:
                seen.append(x)
    assert {r.Product_Name: r.Product_ID for r in t["Product"].collect()} == {n: i + 1 for i, n in enumerate(seen)}
    # product details: multiset arrays equal the 7-table join chain
    got = catalog.product_details(t["Product"], t["productcrop"], t["Crop"], t["productdisease"], t["Disease"],
                                  t["productpest"], t["Pest"], keep_nulls=True)
    for name, df in t.items():
        df.createOrReplaceTempView("p_" + name)
    ref = spark.sql("""
        SELECT p.Product_ID, transform(collect_list(struct(c.Crop_Name AS v)), e -> e.v) AS crops,
               transform(collect_list(struct(d.Disease_Name AS v)), e -> e.v) AS diseases,
               transform(collect_list(struct(pe.Pest_Name AS v)), e -> e.v) AS pests
        FROM p_Product p JOIN p_productcrop pc ON p.Product_ID = pc.Product_ID JOIN p_Crop c ON c.Crop_ID = pc.Crop_ID
        JOIN p_productdisease pd ON pd.Product_ID = p.Product_ID JOIN p_Disease d ON pd.Disease_ID = d.Disease_ID
        JOIN p_productpest pp ON pp.Product_ID = p.Product_ID JOIN p_Pest pe ON pp.Pest_ID = pe.Pest_ID
        GROUP BY p.Product_ID""")

    def canon(df):
        return sorted((r[0], r[1], r[2], r[3], r[4]) for r in df.select(
            "Product_ID", *[canonical_array(c) for c in ("crops", "diseases", "pests")],
            F.size("crops")).collect())
    assert canon(got) == canon(ref)


@settings(**SETTINGS)
@given(st.lists(st.sampled_from(["x", "y", "z", None]), min_size=1, max_size=15),
       st.lists(st.sampled_from(["x", "y", "w"]), max_size=3, unique=True))
def test_insert_new_matches_sequential_reference(spark, batch_keys, stored_keys):
    batch = spark.createDataFrame([(i, k) for i, k in enumerate(batch_keys)], "seq long, k string")
    stored = spark.createDataFrame([(i + 1, k) for i, k in enumerate(stored_keys)], "id long, k string")
    _, out = ingest.insert_new(batch, stored, ["k"], "seq", "2024-01-01 00:00:00")
    got = [r.outcome for r in out.orderBy("seq").collect()]
    seen, expect = set(), []
    for k in batch_keys:  # one row at a time: duplicate, then stored (NULL never matches), else new
        if k in seen:
            expect.append("duplicate")
        elif k is not None and k in stored_keys:
            expect.append("exists")
        else:
            expect.append("inserted")
        seen.add(k)
    assert got == expect
