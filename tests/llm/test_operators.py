"""Each operator on small inputs with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import (ann, components, exact_dedup, html_wrapper, jaccard_join, mixing, quality,
                           sentencepiece_codec, sharding, token_counts, vocab, warc)

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, size long, shard string, sig string, row string"


def frame(spark, rows, ddl=DOCS):
    """Rows of (doc_id, text, source); the other columns clash with the operators' own names."""
    if ddl == DOCS:
        rows = [(i, t, "en", s, 7, "x", "y", None) for i, t, s in rows]
    return spark.createDataFrame(rows, ddl)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = ["w%d" % i for i in range(400)]

    def prose(n):
        return " ".join(words[int(i)] for i in rng.integers(0, 400, n))

    base = [prose(int(n)) for n in rng.integers(3, 120, 60)]
    rows = [(i, t, "src%d" % (i % 4)) for i, t in enumerate(base)]
    for i in range(60, 90):  # near copies
        w = base[i - 60].split(" ")
        w[len(w) // 2] = "changed%d" % (i % 3)
        rows.append((i, " ".join(w), "src0"))
    rows += [(100 + i, base[5], "src1") for i in range(7)]  # copies
    rows += [(200, None, "src1"), (201, "", None), (202, " \t\n ", "src2"), (203, "One", "src2"), (204, "one two", None),
             (205, "ONE Two", "src3"), (206, prose(1500), "src3"), (206, base[7], "src3"), (206, base[7], "src3"),
             (None, base[9], "src1"), (None, None, None), (207, "é  ß ▁ \x00 ﬁ\n\n日本", "src1"), (208, "x" * 300, "src1")]
    return rows


# 1 ---------------------------------------------------------------------------------------------------------------

def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark, texts):
    got = sharding.shard_rows(frame(spark, texts), 24).collect()
    assert len(got) == len(texts)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert (r.shard, r.grown_shard, r.law) == (jump(r.doc_id or 0, 24), jump(r.doc_id or 0, 25), "key")
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert sharding.shard_rows(frame(spark, []), 24).count() == 0


def test_jump_matches_for_many_keys(spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 12345678901234567, *range(1000, 1100)]
    for n in (1, 2, 7, 1000):
        df = spark.createDataFrame([(k,) for k in keys], "doc_id long")
        got = {r.doc_id: r.shard for r in sharding.with_shard(df, n).collect()}
        assert got == {k: jump(k, n) for k in keys}


# 2, 3 ------------------------------------------------------------------------------------------------------------

def best_path(text, v):
    """Plain dynamic programme over the whole text (bytes), ties to the shortest last piece."""
    data = b" " + text.encode() if text else b""
    best, back = [0.0] + [-math.inf] * len(data), [None] * (len(data) + 1)
    chars = set(np.flatnonzero([(b & 0xC0) != 0x80 for b in data]).tolist()) | {len(data)}
    for e in sorted(chars - {0}):
        for b in range(e - 1, max(-1, e - 50), -1):
            if b in chars:
                piece = data[b:e]
                s = v.scores.get(piece)
                if s is None and len(piece.decode()) == 1:
                    s = len(piece) * v.byte_score
                if s is not None and best[b] + s > best[e]:
                    best[e], back[e] = best[b] + s, b
    ids, e = [], len(data)
    while e:
        piece = data[back[e]:e]
        ids = ([v.ids[piece]] if piece in v.ids else [v.byte_ids[c] for c in piece]) + ids
        e = back[e]
    return ids


def test_encoding_and_token_counts(spark, texts):
    v = vocab.load_vocab()
    docs = frame(spark, texts)
    counts = sorted(((r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs).collect()), key=str)
    got = sentencepiece_codec.encode(docs).select("doc_id", "text", "ids", "sig").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, _ in texts)
    for r in got:
        assert r.sig == "y"
        assert r.ids is None if r.text is None else r.ids == best_path(r.text, v)
    assert counts == sorted(((r.doc_id, len(r.ids or [])) for r in got), key=str)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs)).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t) for i, t, _ in texts)
    assert all(r.round_trip for r in sentencepiece_codec.encode_and_check(docs).collect())
    assert sentencepiece_codec.encode(frame(spark, [])).count() == token_counts.token_counts(frame(spark, [])).count() == 0


def test_long_pretokens_and_odd_bytes():
    v = vocab.load_vocab()
    index = sentencepiece_codec.PieceIndex(v)
    cases = ["a" * 500, "   " + "the" * 60 + "    ", "日本語" * 40 + " é" * 3, "\x7f\x01 \t\n" * 9, "▁▁ ▁x", " "]
    ids, n = sentencepiece_codec.encode_texts([c.encode() for c in cases], index)
    ends = np.cumsum(n)
    for c, e, k in zip(cases, ends, n):
        assert ids[e - k:e].tolist() == best_path(c, v)
        assert sentencepiece_codec.decode_ids(ids[e - k:e].tolist(), v.pieces) == c


# 4 ---------------------------------------------------------------------------------------------------------------

def test_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2500, 12)).astype(np.float32)
    x[1000:1400] = x[3]  # a very common vector
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(5000, None), (5100, []), (5200, [0.0] * 12), (5300, [float("nan")] * 12), (5400, [1.0] * 11 + [None]),
           (5500, [float("inf")] * 12), (None, rows[7][1]), (5600, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd + rows[:50], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in ann.nearest(df, shard_rows=700).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 2500, 100))  # 5600 has no vector of its own length beside it
    x = x.astype(float)
    hits = total = 0
    for q, near in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        assert [s for _, s in near] == sorted(s for _, s in near) and all(abs(d[i] - s) < 1e-12 for i, s in near)
        hits, total = hits + len({i for i, _ in near} & set(order)), total + 10
    assert hits / total >= 0.95
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in ann.nearest(few, every=5).orderBy("rank").collect()] == [
        i for i in np.argsort(((x[:5] - x[0]) ** 2).sum(1)) if i != 0]
    assert ann.nearest(few.limit(0)).count() == 0


# 5 ---------------------------------------------------------------------------------------------------------------

def brute_targets(sizes, weights, cap):
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(weights[s] for s in free)
        over = [s for s in free if level * weights[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * weights[s] for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def test_mixing(spark, texts):
    docs = frame(spark, texts)
    got = mixing.mix_sources(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(WORDS.findall(t or ""))) for i, t, _ in texts)
    sizes = Counter()
    for _, t, s in texts:
        sizes[s] += len(WORDS.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = brute_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 3)
    source = {r[0]: r[2] for r in texts}
    taken, target = Counter(), {}
    for r in got:
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        if r.doc_id is not None:
            taken[source[r.doc_id]] += r.taken
            assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]]
            target[source[r.doc_id]] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(130, 0.02 * t)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    rows = Counter(r.doc_id for r in mixing.mixed_rows(docs).collect())
    for r in got:
        if r.doc_id not in (206, None):  # repeated ids
            assert rows[r.doc_id] == (r.taken // r["size"] if r["size"] else 1)
    assert mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mix_sources(frame(spark, [])).count() == 0


def test_knapsack_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(60):
        k = int(rng.integers(1, 6))
        lengths = rng.choice(np.arange(1, 30), k, replace=False)
        counts, budget = rng.integers(0, 5, k), int(rng.integers(0, 120))
        sums = {0}
        for length, count in zip(lengths, counts):
            sums = {s + int(length) * c for s in sums for c in range(int(count) + 1)}
        take = mixing.knapsack(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        assert int((take * lengths).sum()) == max(s for s in sums if s <= budget)
        fit = mixing.fit_budget(lengths, counts, budget)
        assert (fit <= counts).all() and int((fit * lengths).sum()) <= budget


# 6 ---------------------------------------------------------------------------------------------------------------

PAGES = [(1, "http://a.example/x", "<p>same</p>"), (2, "http://a.example/y", "<p>same</p>"), (9, None, "<p>same</p>"),
         (9, None, "<p>same</p>"), (3, "http://b.example/\r\nX: 1", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (4, "u", None),
         (5, "u", ""), (None, "u", "é \r\n\r\nWARC/1.1\r\n"), (6, "u", "z" * 300_000)]


@pytest.mark.parametrize("least", [0, 5])
def test_warc(spark, least):
    pages = spark.createDataFrame([(*p, "d") for p in PAGES], "page_id long, url string, html string, digest string")
    got = warc.warc_round_trip(pages, least).collect()
    assert len(got) == len(PAGES)
    by = defaultdict(list)
    for i, _, h in PAGES:
        by[h or ""].append(i)
    want = Counter()
    for h, ids in by.items():
        data, top, first = h.encode(), max((i for i in ids if i is not None), default=None), True
        for i in ids:
            keeps = len(data) < least or (i == top and first)
            first &= not (i == top)
            want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if keeps else "revisit",
                  None if keeps else top)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_archives_give_payloads_back(spark, tmp_dir):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(pages, tmp_dir + "/w", records_per_file=2)
    got = {r.page_id: r.payload for r in warc.read_archives(spark, tmp_dir + "/w").filter("record_type = 'response'").collect()}
    assert got[9] == "<p>same</p>" and got[3] == PAGES[4][2] and got[None] == PAGES[7][2] and got[6] == PAGES[8][2]
    with pytest.raises(ValueError):
        list(warc.parse_archive(__import__("io").BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


# 7 ---------------------------------------------------------------------------------------------------------------

def page(body, extra="", title="T"):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>'</script></head><body>"
            f"<nav><ul><li><a href='/a'>menu</a></li><li>two</li></ul></nav><div class='ad'>buy</div>{body}{extra}"
            "<footer>&copy; foot</footer></body></html>")


def test_main_text(spark):
    art = "<article><h1>Head &amp; more</h1><p>One\n  two</p><p><b>Three<br>four<p>five &lt;x&gt;</p></article>"
    pages = [
        (1, "http://a.example/1", page(art)),
        (2, "http://a.example/2", page("<article><h1>Other</h1><p>Text</p><div class='comments'><p>reader says</p></div></article>",
                                       "<aside>side</aside><form>Your name</form>")),
        (3, "http://a.example/3", page("<article><h1>Only</h1></article>")[:-14]),
        (4, "http://b.example/1", page("<div id='content'><h2>No article</h2><p>" + "long text " * 30 + "</p></div>")),
        (5, "http://b.example/2", page("<div id='content'><h2>Second</h2><p>" + "other words " * 30 + "</p></div>")),
        (6, None, None), (7, "http://c.example/", ""), (8, "nonsense", "just text\n here"), (8, "nonsense", "just text\n here"),
    ]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_wrapper.main_texts(df).collect()}
    assert html_wrapper.main_texts(df).count() == len(pages)
    assert got[1].text == "Head & more\nOne two\nThree four\nfive <x>" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "Other\nText"
    assert got[3].text == "Only"
    assert got[4].text == "No article\n" + ("long text " * 30).strip()
    assert got[5].text.startswith("Second\nother words")
    assert got[6].text == got[7].text == "" and got[8].text == "just text here"
    assert html_wrapper.main_texts(df.limit(0)).count() == 0


def test_wrapper_is_a_union_free_expression():
    one = html_wrapper.to_wrapper(html_wrapper.parse("<div><h2>a</h2><p>b</p><h2>c</h2><p>d</p></div>"))
    two = html_wrapper.to_wrapper(html_wrapper.parse("<div><h2>a</h2><p>b</p><ul><li>x<li>y</ul></div>"))
    both = html_wrapper.align(one, two)
    assert both[0][0] == "div"
    names = [(html_wrapper._name(n), n[1]) for n in both[0][2]]
    assert ("ul", 1) in names and any(f & 1 for _, f in names)
    assert html_wrapper.to_wrapper(html_wrapper.parse("<div>" * 400 + "deep" + "</div>" * 400))


def all_texts(html):
    return [t for ts in html_wrapper.slot_texts(html_wrapper.parse(html)).values() for t in ts]


@pytest.mark.parametrize("html,texts", [
    ("<p>a <svg class='i'/> b</p><p>c</p>", ["a b", "c"]),
    ("<object data='x'/><p>c</p>", ["c"]),
    ("<div><button>Like</div><p>c</p>", ["Like", "c"]),
    ("<div><video src='x'><p>c</p></div>", ["c"]),
    ("<video-player></video-player><p>c</p><svg-icon></svg-icon><button-group><p>d</p></button-group>", ["c", "d"]),
    ("<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", ["So x=1 holds"]),
    ("<object data='x'><p>fallback</p></object>", ["fallback"]),
    ("<p>Press <button type='b'><div>OK</div></button> now</p><select><option>1<option>2</select><p>c</p>", ["Press now", "c"]),
    ("<script src='x'/><p>c</p>", ["c"]),
    ("<script src=http://x/>var t</script><p>c</p><iframe src='a'>", ["c"]),
    ("<title>t</title><noscript><p>n</p></noscript><p>c</p><style>p{}", ["c"]),
])
def test_only_raw_text_elements_run_to_their_end_tag(html, texts):
    assert sorted(all_texts(html)) == sorted(texts)


def test_wrappers_do_not_grow_with_the_pages(spark):
    def one(i):
        rng = np.random.default_rng(i)
        name = chr(97 + i % 26) + chr(97 + i // 26)
        body = "".join(f"<{t} id='s{t}{name}{k}x'>t{i}-{k}</{t}>"
                       for k, t in enumerate(rng.choice(["h2", "p", "pre", "blockquote"], 90)))
        return (i, "http://a.example/%d" % i, f"<body class='post-{name}'><div class='content'>{body}</div></body>")

    def size(n):
        df = spark.createDataFrame([one(i) for i in range(n)], "page_id long, url string, html string")
        return max(len(r.paths) + len(r.labels or "") for r in html_wrapper.infer_wrappers(df).collect())

    assert size(120) == size(60)
    trees = [html_wrapper.to_wrapper(html_wrapper.parse(one(i)[2], frozenset())) for i in range(60)]
    whole = trees[0]
    for tree in trees[1:]:
        whole = html_wrapper.align(whole, tree)
    assert len(str(whole)) < 2 * len(str(trees[0])) + 10_000
    df = spark.createDataFrame([one(i) for i in range(60)], "page_id long, url string, html string")
    for r in html_wrapper.main_texts(df).collect():
        assert r.text.split("\n") == [f"t{r.page_id}-{k}" for k in range(90)]


def main_text_of(spark, pages):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html_wrapper.main_texts(df).orderBy("page_id").collect()]


def test_main_text_of_mixed_templates(spark):
    card = "<article><h2>card %d</h2></article>"
    post = "<div class='content'><h1>Post %d</h1><p>words of post %d</p></div>"
    pages = [("http://a.example/l", page(card % 1 + card % 2))]
    pages += [("http://a.example/%d" % i, page(post % (i, i))) for i in range(4)]
    pages += [("http://a.example/m", page("<main><p>in main</p></main><p>beside</p>")), (None, page(card % 3)),
              (None, page(post % (8, 8)))]
    assert main_text_of(spark, pages) == ["card 1\ncard 2", *(f"Post {i}\nwords of post {i}" for i in range(4)), "in main",
                                          "card 3", "Post 8\nwords of post 8"]


def test_main_text_in_elements_named_like_furniture(spark):
    art = "<article><h1>T%d</h1><p>text %d</p></article>"
    aside = "<aside><article>card</article></aside>"
    div = "<div class='content'><h1>T%d</h1><p>text %d</p></div>"
    wraps = ["<form action='x'><div>%s</div><div class='menu'>m</div></form>", "<main class='with-sidebar'>%s</main>",
             "<section class='has-menu'>%s</section>", "<section class='sidebar right'>%s</section>",
             "<form><fieldset class='widget'>%s</fieldset></form>"]
    pages = [("http://a%d.example/%d" % (k, i), page(w % (inner % (i, i)), more))
             for k, w in enumerate(wraps * 2) for i in range(4) for inner, more in [(art, aside) if k < 5 else (div, "")]]
    assert main_text_of(spark, pages) == [f"T{i}\ntext {i}" for _ in range(10) for i in range(4)]
    mixed = [("http://b.example/%d" % i, page((wraps[0] if i == 5 else "%s") % (div % (i, i)))) for i in range(6)]
    assert main_text_of(spark, mixed) == [f"T{i}\ntext {i}" for i in range(6)]


def test_main_text_keeps_what_stands_beside_most_of_it(spark):
    def long(i):
        return " ".join(f"w{i}-{k}" for k in range(60))

    pages, texts = [], []
    for i in range(4):
        pages += [("http://a.example/%d" % i, page(f"<div id=content><header><h1>T{i}</h1></header><div class=lead>lead {i}</div>"
                                                   f"<div class=body><p>{long(i)}</p><p>end</p></div></div>")),
                  ("http://b.example/%d" % i, page(f"<div id=content><p>before {i}</p><ul><li>{long(i)}<li>two</ul>"
                                                   f"<p>after {i}</p></div>"))]
        texts += [f"T{i}\nlead {i}\n{long(i)}\nend", f"before {i}\n{long(i)}\ntwo\nafter {i}"]
    assert main_text_of(spark, pages) == texts


def test_main_text_of_copies(spark):
    one = "<div class='content'><h1>Same</h1><p>text</p></div>"
    pages = [("http://a.example/%d" % i, page(one, f"<div class='ads'>{i}</div>")) for i in range(4)]
    pages += [("http://b.example/%d" % i, page(f"<div class='content'><h1>H{i}</h1></div><p class='tag'>tagline</p>"))
              for i in range(40)]
    pages += [("http://b.example/c%d" % i, page("<div class='content'><h1>H</h1><blockquote>said once</blockquote></div>"))
              for i in range(4)]
    pages += [("http://b.example/t", page("<p class='tag'>tagline</p>"))]
    assert main_text_of(spark, pages) == (["Same\ntext"] * 4 + [f"H{i}" for i in range(40)] + ["H\nsaid once"] * 4 + ["tagline"])


# 8 ---------------------------------------------------------------------------------------------------------------

def test_quality(spark):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    rows, labels = [], []
    for i in range(400):
        n = int(rng.integers(5, 60))
        w = [words[int(k)] + str(int(rng.integers(0, 500))) for k in rng.integers(0, 8, n)]
        good = i % 3 != 0
        rows.append((i, " ".join(w if good else [x + "$$$" for x in w]), "s"))
        labels.append((i, int(good)))
    rows += [(900, None, "s"), (901, "", "s"), (902, "alpha " * 50_000, "s"), (None, "beta1 gamma2", "s"), (5, rows[5][1], "s")]
    labels += [(7000, 1), (None, 1), (8, None)]
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    learn = lab.filter(~quality.held_out("doc_id"))
    assert learn.filter("doc_id is not null").collect() == [
        r for r in lab.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    w = quality.train(docs, learn, sample_rows=250)
    assert (w == quality.train(docs, learn, sample_rows=250)).all()
    got = quality.score(docs, w).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    seen = {r.doc_id: r.score for r in got}
    assert seen[900] == seen[901]
    held = [(seen[i], y) for i, y in labels[:400] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.97
    kept = quality.keep_good(docs, w)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in seen.items() if s >= 0.7}
    none = quality.train(docs, lab.limit(0))
    assert not none.any() and quality.score(frame(spark, []), none).count() == 0


# 9 ---------------------------------------------------------------------------------------------------------------

def brute_components(rows, width, num):
    sets = []
    for i, t, _ in rows:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width
                    else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        ids[find(k)].append(i)
    low = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return Counter((rows[k][0], len(sets[k]), low[find(k)]) for k in range(len(rows)))


@pytest.mark.parametrize("width,threshold", [(3, 0.9), (5, 0.8), (1, 0.5), (2, 1.0)])
def test_similar_sets(spark, texts, width, threshold):
    got = jaccard_join.similar_sets(frame(spark, texts), width, threshold, sketch_bits=18, filter_bits=20)
    assert Counter(tuple(r) for r in got.collect()) == brute_components(texts, width, round(threshold * 100))


def test_similar_sets_of_variants(spark):
    """One base text in hundreds of variants: linked through the base, not pair by pair; others only look alike."""
    rng = np.random.default_rng(6)
    base = ["b%d" % i for i in range(100)]
    rows = [(0, " ".join(base), "s")]
    for i in range(1, 200):
        w = list(base)
        for k in rng.integers(0, 100, 1 + i % 3):
            w[int(k)] = "v%d" % int(rng.integers(0, 10_000))
        rows.append((i, " ".join(w), "s"))
    got = jaccard_join.similar_sets(frame(spark, rows), 3, 0.9, sketch_bits=18, filter_bits=20)
    assert Counter(tuple(r) for r in got.collect()) == brute_components(rows, 3, 90)


def test_drop_near_copies(spark, texts):
    docs = frame(spark, texts)
    kept = jaccard_join.drop_near_copies(docs, 5, 0.8, sketch_bits=18, filter_bits=20)
    assert kept.columns == docs.columns
    low = {i for (i, _, c) in brute_components(texts, 5, 80) if i == c or i is None}
    assert {r.doc_id for r in kept.collect()} == low
    assert jaccard_join.similar_sets(frame(spark, []), sketch_bits=18, filter_bits=20).count() == 0


def test_drop_near_copies_keeps_one_row_of_each_component(spark):
    one, other, third = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    near = one.replace("a59", "z")
    rows = [(5, near, "s"), (4, one, "s"), (4, one, "s"), (4, other, "s"), (None, one, "s"), (7, other, "s"),
            (None, third, "s"), (None, third, "s"), (None, third + " c60", "s"), (9, None, "s"), (9, None, "s"), (None, " ", "s")]
    kept = jaccard_join.drop_near_copies(frame(spark, rows), 5, 0.8, sketch_bits=18, filter_bits=20)
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert sum(n for (i, x), n in got.items() if i is None and x in (third, third + " c60")) == 1
    assert {k: n for k, n in got.items() if k[0] is not None or k[1] == " "} == {
        (4, one): 1, (4, other): 1, (9, None): 2, (None, " "): 1}
    assert sum(got.values()) == 6


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}


# 10 --------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [48, 8])  # 8: many different texts share a fingerprint
def test_exact_dedup(spark, texts, bits):
    docs = frame(spark, texts)
    got = exact_dedup.exact_dedup(docs, fingerprint_bits=bits).collect()
    groups = defaultdict(list)
    for i, t, _ in texts:
        groups[t or ""].append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(
        (i, top[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in texts)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(
        {hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.drop_exact_copies(docs, fingerprint_bits=bits)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter({(top[t], t): 1 for t in groups})
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0


def test_golomb_round_trip():
    rng = np.random.default_rng(8)
    for n, span in ((1, 10), (5, 5), (1000, 1 << 40), (3000, 4000), (2, 1 << 47)):
        values = np.sort(rng.choice(span, n, replace=False)) if span < 10_000 else np.unique(rng.integers(0, span, n))
        values = values.astype(np.int64) + 77
        k, data = exact_dedup.golomb_encode(values, 77, span)
        assert (exact_dedup.golomb_decode(len(values), k, 77, data) == values).all()
        assert len(data) * 8 <= len(values) * (math.log2(span / len(values)) + 3) + 8


# pipeline --------------------------------------------------------------------------------------------------------

def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = first = spark.read.parquet(sf + "/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf), "t-" + name)
        assert docs.columns == first.columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count() and last.filter(F.col("ids").isNull() & F.col("text").isNotNull()).count() == 0
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == Counter(r.doc_id for r in docs.collect())
