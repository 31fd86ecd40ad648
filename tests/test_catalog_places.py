"""First-seen places are found by hash aggregation; documents stay in their task while they are looked up."""
from pyspark.sql import functions as F

from conftest import rows
from fieldbook.operators import catalog
from fieldbook.plans import catalog_queries


def _raw(spark, kind):
    data = [(9, "b, a,", "x"), (-9223372036854775808, None, "y"), (3, "a,b ,a", None), (9223372036854775807, "c", "x,y"),
            (-4, "b", ""), (None, "d", "y")]
    return spark.createDataFrame(data, "k long, p string, q string").withColumn("k", F.col("k").cast(kind))


def test_first_places_as_struct_minimum(spark):
    raw = _raw(spark, "long").withColumn("pb", F.when(F.col("k") > 5, F.lit(2147483646)).otherwise(F.length("q")))
    items = raw.select("k", "pb", F.posexplode_outer(F.split("p", ",")).alias("pos", "name"))
    want = items.groupBy("name").agg(F.min(F.struct("k", "pos", "pb")).alias("f")).select("name", "f.*")
    got = catalog._first_place(items, ["name"], "k", "pos", "pb")
    assert rows(got) == rows(want) and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    text = items.withColumn("k", F.col("k").cast("string"))
    want = text.groupBy("name").agg(F.min(F.struct("k", "pos")).alias("f")).select("name", "f.*")
    assert rows(catalog._first_place(text, ["name"], "k", "pos")) == rows(want)


def test_document_details_gathered_by_document(spark):
    """Grouped by the document key, details need no window and no self-join; nulls and listed-twice rows as the flat join."""
    doc = spark.createDataFrame([(1, "u", "1,2,1", "1,9", "1", None), (1, "u", "1,2,1", "1,9", "1", None),
                                 (2, "v", None, "2", "x,2", "1")],
                                "k long, w string, Product_ID string, Crop_ID string, Disease_ID string, Pest_ID string")
    dim = {n: spark.createDataFrame([(1, n + "1"), (2, n + "2")], f"{n}_ID long, {n}_Name string")
           for n in ("Product", "Crop", "Disease", "Pest")}
    out = catalog.document_details(doc, dim["Product"], dim["Crop"], dim["Disease"], dim["Pest"], ["k", "w"], doc_key="k")
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.Product_Name, r.k): [sorted(map(str, a)) for a in (r.Disease_Names, r.Crop_Names, r.Pest_Names)]
           for r in out.collect()}
    # document 1 stands twice, so its items count twice in each list and its row twice
    assert set(got) == {("Product1", 1), ("Product2", 1), (None, 2)}
    assert got[(None, 2)] == [["Disease2", "None"], ["Crop2"] * 2, ["Pest1"] * 2]
    assert {len(a) for a in got[("Product1", 1)]} == {2 * got[("Product2", 1)][0].__len__()}


def test_first_places_fit_one_long_where_the_rows_leave_room(spark):
    """No decimal where row keys and lists are short; the same places as the decimal gives, for pairs and all bridges."""
    raw = _raw(spark, "long").withColumn("k", F.when(F.col("k").between(-99, 99), F.col("k")))
    span = catalog._span(raw, "k", ["p", "q"])
    pairs = raw.select("k", F.posexplode_outer(F.split("p", ",")).alias("pa", "na"), "q").select(
        "k", "pa", "na", F.posexplode_outer(F.split("q", ",")).alias("pb", "nb"))
    got = catalog._first_place(pairs, ["na", "nb"], "k", "pa", "pb", span=span)
    want = catalog._first_place(pairs, ["na", "nb"], "k", "pa", "pb")
    assert rows(got) == rows(want) and got.dtypes == want.dtypes
    assert "decimal" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" in want._jdf.queryExecution().optimizedPlan().toString()
    wide = catalog._span(_raw(spark, "long"), "k", ["p", "q"])  # keys over the whole range do not fit
    assert "decimal" in catalog._first_place(pairs, ["na", "nb"], "k", "pa", "pb", span=wide)._jdf.queryExecution(
        ).optimizedPlan().toString()
    assert catalog._span(raw.limit(0), "k", ["p"]) == (0, 0, 0)


def test_id_lists_gather_one_array_and_items_are_stripped_without_a_pattern(spark):
    items = spark.createDataFrame([("p", 1, 0, "a"), ("p", 1, 1, ""), ("p", 1, 2, "b"), ("q", 1, None, None), ("p", 2, 0, ""),
                                   ("q", 2, 0, "z"), ("q", 2, 1, "c")], "list string, k long, pos int, name string")
    dims = spark.createDataFrame([("p", "a", 12), ("p", "b", 5), ("p", "", 1), ("q", "c", 5), ("q", None, 6)],
                                 "list string, name string, _id long")
    out = catalog.all_id_lists(items, dims, "k", {"p": "P", "q": "Q"})
    assert rows(out) == [(1, "12,5", None), (2, "", "5")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 1
    cut = spark.createDataFrame([(" \t\x0ba b\n,\r\x0c,c",)], "t string").select(catalog.list_items("t").alias("t"))
    assert cut.first().t == ["a b", "", "c"]
    assert "regexp" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_built_in_tasks_of_bounded_lines(spark, monkeypatch):
    """more lines than the session's partitions should hold are dealt by their number; rows as the plain join gives."""
    sf = "/root/testdata/sf0.001"
    want = rows(catalog_queries._raw_documents(spark, sf))
    lines = spark.createDataFrame([(k % 50 if k % 9 else None, 1 if k % 4 else k % 7 or None) for k in range(1000)],
                                  "l_orderkey long, l_partkey long")
    parts = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "n"), (9, "z")], "p_partkey long, p_brand string")
    plain = rows(lines.join(parts, lines["l_partkey"] == parts["p_partkey"]))
    monkeypatch.setattr(catalog_queries, "_TASK_LINES", 100, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with tables too large for it
    try:
        raw = catalog_queries._raw_documents(spark, sf)
        held = raw.groupBy(F.spark_partition_id()).agg(F.count("Product_names").alias("n"))
        assert 1 < held.agg(F.max("n")).first()[0] <= 100
        assert rows(raw) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(catalog_queries._lines_with_parts(lines, parts)) == plain


def test_documents_are_numbered_in_ranges_of_bounded_rows(spark, monkeypatch):
    """as many ranges as keep each within its rows, for a base run and a delta; the numbers follow the row keys."""
    raw = spark.range(1000).select((F.lit(990) - F.col("id")).alias("k"), *[
        F.concat(F.lit("n"), F.col("id") % 7).alias(c) for c in ("Product_names", "crop", "Diseases", "pest")])
    asked, numbering = [], catalog.dense_ids

    def spied(df, order, **kw):
        if kw["id_col"] == "document_ID":
            asked.append(kw.get("buckets"))
        return numbering(df, order, **kw)

    monkeypatch.setattr(catalog, "dense_ids", spied)
    monkeypatch.setattr(catalog, "_RANGE_DOCUMENTS", 50, raising=False)
    later = F.col("k") > 800
    base = catalog.normalise(raw.where(~later), "k")
    assert rows(base["Document"], "k", "document_ID") == rows(spark.range(810).select(
        (F.col("id") - 9).alias("k"), (F.col("id") + 1).alias("document_ID")))
    added = catalog.normalise_more(raw.where(later), base, "k")
    assert rows(added["Document"], "k", "document_ID") == rows(spark.range(810, 1000).select(
        (F.col("id") - 9).alias("k"), (F.col("id") + 1).alias("document_ID")))
    assert asked == [17, None]  # 810 documents, and 190 that the session's 8 partitions hold
    assert catalog._ranges(raw, 3) == 3
