"""Bounds, clashes and odd input of the operators: what a large or broken table would bring."""

import time

import numpy as np
import pyarrow as pa
import pytest

from fieldbook.llm import ann, html_wrapper, jaccard_join, quality, token_counts, vocab


def recall(x, queries=60, k=10):
    edges, entries = ann.build_graph(ann.scaled(x), 32, 48, 1.2)
    found, _ = ann.beam_search(x, edges, entries, x[:queries], 240)
    hits = 0
    for j in range(queries):
        d = ann.distances(x, x[j])
        d[j] = np.inf
        got = sorted((i for i in found[j] if i >= 0 and i != j), key=lambda i: d[i])[:k]
        hits += len(set(got) & set(np.argsort(d, kind="stable")[:k]))
    return hits / (queries * k)


@pytest.mark.parametrize("name", ["gauss64", "gauss128", "gauss256", "shifted", "clusters", "many clusters"])
def test_recall_of_a_full_shard(name):
    rng, n = np.random.default_rng(1), 8192
    x = {"gauss64": lambda: rng.normal(size=(n, 64)), "gauss128": lambda: rng.normal(size=(n, 128)),
         "gauss256": lambda: rng.normal(size=(n, 256)), "shifted": lambda: 1000 + 0.01 * rng.normal(size=(n, 64)),
         "clusters": lambda: rng.normal(size=(40, 128))[rng.integers(0, 40, n)] * 3 + 0.3 * rng.normal(size=(n, 128)),
         "many clusters": lambda: rng.normal(size=(400, 64))[rng.integers(0, 400, n)] * 3 + 0.1 * rng.normal(size=(n, 64)),
         }[name]()
    assert recall(x) >= 0.9


@pytest.mark.parametrize("dim,n", [(2, 400), (4, 400), (4, 3000), (16, 400)])
def test_recall_of_few_dimensions_and_rows(dim, n):
    x = np.random.default_rng(3).normal(size=(n, dim))
    assert recall(x) >= 0.97
    edges, _ = ann.build_graph(ann.scaled(x), 32, 48, 1.2)
    assert all(len(set(e[e >= 0])) == (e >= 0).sum() for e in edges)


@pytest.mark.parametrize("size", [1e200, 1e20, 1.0, 1e-200])
def test_neighbours_of_huge_and_tiny_vectors(spark, size):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) * size for c in rng.normal(size=4)]) for i in range(400)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), search_beam=100).collect()
    x = np.array([v for _, v in rows]) / size
    for q in (0, 100, 200, 300):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert len(mine) == 10 and len({r.vec_id for r in mine} & set(np.argsort(d)[:10])) >= 9
        assert np.allclose([r.score / size for r in mine], [d[r.vec_id] for r in mine])


@pytest.mark.parametrize("part", ['<a b="', "<p title='", '<a b="<a b=\'', "<a<a", "</script ", "<!", '<script a="', '</x "', "<a ="])
def test_broken_html_takes_linear_time(part):
    def seconds(n):
        text = part * (n // len(part))
        t = time.perf_counter()
        html_wrapper.parse(text)
        html_wrapper.page_labels(text)
        return time.perf_counter() - t

    assert seconds(1_000_000) < 40 * max(seconds(100_000), 0.02)


@pytest.mark.parametrize("html,texts", [
    ('<p>a<b c="d>e</p>', ['a<b c="d>e']), ("<p title='a>b'>x</p>", ["x"]), ('<p a="1>2" b=\'3>4\'>y</p>', ["y"]),
    ("<p>1 < 2 <3</p>", ["1 < 2 <3"]), ('<p a="x" b="y>z</p><p>"w">v</p>', ['<p a="x" b="y>z', '"w">v']), ("<!-- a > b --><p>c</p>", ["c"])])
def test_tags_end_outside_quotes(html, texts):
    def all_texts(nodes):
        return [t for n in nodes for t in ([n[1]] if n[0] == "#" else all_texts(n[1]))]
    assert all_texts(html_wrapper.parse(html)) == texts


def test_marks_of_the_body_make_no_furniture():
    for label in ("body.post-ad", "html.ads.sidebar", "body.comments.main"):
        assert html_wrapper._plain(label) == label.partition(".")[0]


def test_copies_send_one_posting_a_task(spark):
    text = " ".join("w%d" % i for i in range(60))
    docs = spark.createDataFrame([(i, text) for i in range(20000)], "id long, t string").coalesce(2)
    levels = spark.sparkContext.broadcast(np.zeros((2, 1 << 8), np.uint8))
    rows = docs.selectExpr("id", "id AS h", "t").mapInArrow(
        jaccard_join._prefixer(5, 80, 100, 8, levels),
        "id long, h long, sig binary, n long, gkey long, typ double, prefix array<long>")
    got = rows.selectExpr("count(*) AS n", "count_if(size(prefix) > 0) AS sent", "count(DISTINCT gkey) AS g").first()
    assert got.n == 20000 and got.g == 1 and got.sent <= 2


def test_blocks_are_cut_by_bytes():
    texts = ["x" * 3_000_000, None, "y" * 2_000_000, "z" * 9_000_000, "", "w"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    parts = list(jaccard_join._blocks(batch, 1))
    assert [p.column(0).to_pylist() for p, _ in parts] == [[0, 1, 2], [3], [4, 5]]
    assert [t for _, held in parts for t in held] == [t if t is None else t.encode() for t in texts]
    assert list(jaccard_join._blocks(batch.slice(0, 0), 1)) == []


def test_near_copies_with_clashing_columns(spark):
    text = " ".join("w%d" % i for i in range(40))
    rows = [(1, text, "a", 1, 2, True, "x.y"), (2, text, "b", 3, 4, False, "z"), (3, "other words here", "c", 5, 6, None, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, _near_h long, _near_id long, "
                                     "_near_many boolean, `a.b` string")
    got = jaccard_join.drop_near_copies(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [rows[0], rows[2]]


def test_quality_with_clashing_columns(spark):
    rows = [(i, "good text %d" % i if i % 2 else "bad words", i, "x", 0.5, "t") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id long, label string, quality double, t string")
    labels = spark.createDataFrame([(i, i % 2, "b") for i in range(60)], "doc_id long, quality int, text string")
    weights = quality.train(df, labels)
    kept = quality.keep_good(df, weights, least=0.5)
    assert kept.columns == df.columns and {r.doc_id % 2 for r in kept.collect()} == {1}


def test_token_counts_of_bytes_that_are_no_utf8(spark):
    df = spark.createDataFrame([(1, bytearray(b"abc \xff\xfe def")), (2, bytearray(b"\x80" * 50)), (3, None)], "doc_id long, b binary")
    df = df.selectExpr("doc_id", "decode(b, 'ISO-8859-1') AS plain", "cast(b AS string) AS text")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df).collect()}
    v = vocab.load_vocab()
    assert got[2] == 50 + (1 if b" " in v.ids else 1) and got[3] == 0 and got[1] >= 4


def test_warc_copies_of_one_payload_are_numbered_apart(spark):
    """A digest on a third of all pages: its revisits are spread over tasks, not sent to one by their digest."""
    from pyspark.sql import functions as F

    from fieldbook.llm import warc

    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the originals are too many
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # partitions as they are dealt
    try:
        pages = spark.range(3000).select(
            F.col("id").alias("page_id"), F.lit("http://a/").alias("url"),
            F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("html"))
        records = warc.resolve_revisits(pages).select(
            "record_id", "page_id", "record_type", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    revisits = [r for r in records if r.record_type == "revisit"]
    assert len({r.record_id for r in records}) == 3000 and len(revisits) == 999 and {r.page_id for r in revisits} == set(range(0, 2997, 3))
    counts = [sum(r.part == p for r in revisits) for p in {r.part for r in revisits}]
    assert len(counts) > 4 and max(counts) < 300
