"""Word n-gram Jaccard similarity join by grouped prefixes.

A pair of sets reaches the threshold only if the prefixes of both, in one
global token order, share a token.  Sets with the same prefix and the same
size form one group; groups, not documents, are joined on prefix tokens and
filtered by size and position, and only surviving group pairs are expanded
to members and verified on the whole sets.

The global order is rare tokens first.  Frequencies come from a count-min
sketch over all documents, of fixed width: any order gives exact results,
the sketch only keeps frequent tokens out of the prefixes.

What is wanted is connectivity, so pairs are expanded in two steps.  First
every group and every token list links its members to one pivot (linear in
its length).  After that, only pairs whose members are still in different
components are expanded, all of them, which makes the components exact
without emitting all pairs of a group of copies.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import discard, lean, quoted, shingle_set
from fieldbook.llm.components import components
from fieldbook.session import materialize, scratch_path

_CHUNK = 1 << 16
_ROWS = 2
_PART_BITS = 20
BLOCK_BYTES = 4 << 20  # text whose sets a worker holds at a time
SEEN = 1 << 18  # groups that a task remembers to have sent; more only means more postings


def _slots(tokens: np.ndarray, bits: int) -> list[np.ndarray]:
    """The sketch slots of tokens, one array per sketch row."""
    return [(tokens >> np.uint64(s)) & np.uint64((1 << bits) - 1) for s in (0, 64 - bits)]


def _sketcher(width: int, bits: int):
    def run(batches):
        table = [np.zeros(1 << bits, np.uint32) for _ in range(_ROWS)]
        held, n = [], 0

        def add():
            for row, slots in zip(table, _slots(np.concatenate(held), bits)):
                at, count = np.unique(slots.astype(np.uint32), return_counts=True)
                row[at] += count.astype(np.uint32)

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.append(shingle_set(text.as_py(), width))
                n += len(held[-1])
                if n > 500_000:
                    add()
                    held, n = [], 0
        if n:
            add()
        for r, row in enumerate(table):
            for c in range(0, 1 << bits, _CHUNK):
                part = row[c:c + _CHUNK]
                if part.any():
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([r * (1 << bits) + c], pa.int64()),
                        "counts": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})
    return run


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum of a chunk over tasks, kept as a rounded logarithm (order is all that counts)."""
    total = np.zeros(_CHUNK, np.float64)
    for data in pdf["counts"]:
        part = np.frombuffer(zlib.decompress(data), np.uint32)
        total[:len(part)] += part
    level = np.minimum(255, np.round(8 * np.log2(1 + total))).astype(np.uint8)
    return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "levels": [level.tobytes()]})


def token_levels(docs: DataFrame, text_col: str, width: int, bits: int) -> np.ndarray:
    """The sketch as a (2, 2^bits) table of logarithmic counts: 2^(bits+1) bytes, whatever the input."""
    parts = (docs.select(quoted(text_col).cast("string").alias("t"))
             .mapInArrow(lean(_sketcher(width, bits)), "part long, counts binary")
             .groupBy("part").applyInPandas(_summed, "part long, levels binary"))
    table = np.zeros(_ROWS << bits, np.uint8)
    for r in parts.collect():
        level = np.frombuffer(r["levels"], np.uint8)[:_ROWS << bits]
        size = min(len(level), 1 << bits)
        table[r["part"]:r["part"] + size] = level[:size]
    return table.reshape(_ROWS, 1 << bits)


def _need(n: int, num: int, den: int) -> int:
    """Least intersection of a set of n tokens with any set it links to."""
    return -(-num * n // den)


def _blocks(batch: pa.RecordBatch, text_at: int):
    """Parts of a batch with about ``BLOCK_BYTES`` of text (or one longer text) each, and their texts."""
    first, size, held = 0, 0, []
    for text in batch.column(text_at).cast(pa.binary()):
        held.append(text.as_py())
        size += len(held[-1] or b"")
        if size >= BLOCK_BYTES:
            yield batch.slice(first, len(held)), held
            first, size, held = first + len(held), 0, []
    if held:
        yield batch.slice(first, len(held)), held


def _prefixer(width: int, num: int, den: int, bits: int, levels):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("sig", pa.binary()), ("n", pa.int64()),
                        ("gkey", pa.int64()), ("typ", pa.float64()), ("prefix", pa.list_(pa.int64()))])

    def block(batch, texts, seen):
        sig, size, gkey, typ, lengths, prefix = [], [], [], [], [], []
        for text in texts:
            s = shingle_set(text, width)
            n = len(s)
            size.append(n)
            if n == 0:
                sig.append(None), gkey.append(None), typ.append(None), lengths.append(0)
                continue
            level = np.minimum(*(row[i] for row, i in zip(levels.value, _slots(s, bits))))
            order = np.argsort(level, kind="stable")[:n - _need(n, num, den) + 1]  # by (level, token)
            first = s[order].view(np.int64)
            sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            g = hashlib.blake2b(first.tobytes() + n.to_bytes(8, "little"), digest_size=8).digest()
            gkey.append(int.from_bytes(g, "little", signed=True))
            typ.append(float(np.mean(level[order])))
            if gkey[-1] in seen:  # one row of a group per task brings the group's postings
                lengths.append(0)
                continue
            seen.add(gkey[-1])
            prefix.append(first)
            lengths.append(len(first))
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()),
            pa.array(np.concatenate(prefix) if prefix else np.empty(0, np.int64)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sig, pa.binary()), pa.array(size, pa.int64()),
             pa.array(gkey, pa.int64()), pa.array(typ, pa.float64()), lists], schema=schema)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part, texts in _blocks(batch, 2):
                if len(seen) > SEEN:
                    seen.clear()
                yield block(part, texts, seen)
    return run


def _probes(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bit numbers per 64-bit key in a filter of 2^bits bits."""
    keys = keys.astype(np.int64).view(np.uint64)
    return [(keys & np.uint64((1 << bits) - 1)).astype(np.int64), (keys >> np.uint64(64 - bits)).astype(np.int64)]


def _filter_part(bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(1 << _PART_BITS, np.uint8)
        on[pdf["bit"].to_numpy() & ((1 << _PART_BITS) - 1)] = 1
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "data": [np.packbits(on).tobytes()]})
    return run


def _key_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of ``keys(h)``: 2^bits bits, whatever the input."""
    numbers = keys.select(F.explode(F.array(
        F.col("h").bitwiseAND(F.lit((1 << bits) - 1).cast("long")), F.shiftrightunsigned("h", 64 - bits))).alias("bit"))
    parts = (numbers.distinct().withColumn("part", F.shiftright("bit", _PART_BITS))
             .groupBy("part").applyInPandas(_filter_part(bits), "part long, data binary"))
    table = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << _PART_BITS) // 8
    for r in parts.collect():
        table[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["data"], np.uint8)
    return table


def _tokeniser(width: int, bits: int, wanted):
    def run(batches):
        table = wanted.value
        for batch in batches:
            hits = np.ones(batch.num_rows, bool)
            for bit in _probes(batch.column(0).to_numpy(), bits):
                hits &= (table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
            for part, texts in _blocks(batch.filter(pa.array(hits)), 1):
                sets = [shingle_set(t, width) for t in texts]
                sig = [hashlib.blake2b(one.tobytes(), digest_size=16).digest() for one in sets]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(one) for one in sets])]), pa.int32()),
                    pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(sig, pa.binary()), lists], names=["sig", "tokens"])
    return run


def _text_rows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    text = quoted(text_col).cast("string")
    ident = quoted(id_col).cast("long")
    return docs.select(ident.alias("id"), F.xxhash64(ident, text).alias("h"), text.alias("t"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str, id_col: str, width: int,
              num: int, den: int, filter_bits: int) -> DataFrame:
    """The pairs (x, y) of class signatures whose sets reach the threshold.

    Only texts of classes in a pair are cut into tokens again, one text per
    class: a Bloom filter of their keys goes to the scan, so no text is
    shuffled, and the join by signature drops what the filter lets through
    by chance.
    """
    spark = docs.sparkSession
    ends = pairs.select(F.col("x").alias("sig")).unionByName(pairs.select(F.col("y").alias("sig"))).distinct()
    keys = classes.join(ends, "sig").select("h")
    wanted = spark.sparkContext.broadcast(_key_filter(keys, filter_bits))
    sets = (_text_rows(docs, text_col, id_col).select("h", "t")
            .mapInArrow(lean(_tokeniser(width, filter_bits, wanted)), "sig binary, tokens array<long>"))
    path = scratch_path(spark, f"fieldbook-tables/join-sets-{uuid.uuid4().hex}")
    sets.write.parquet(path)
    sets = spark.read.parquet(path).dropDuplicates(["sig"])
    left = pairs.join(sets.select(F.col("sig").alias("y"), F.col("tokens").alias("b")), "y")
    both = left.join(sets.select(F.col("sig").alias("x"), F.col("tokens").alias("a")), "x")
    common = F.size(F.array_intersect("a", "b"))
    links = materialize(both.select("x", "y", common.cast("long").alias("i"),
                                    (F.size("a") + F.size("b")).cast("long").alias("s")).filter(
        F.col("i") * (num + den) >= F.col("s") * num).select("x", "y"), "join-links")
    discard(spark, path)  # the links are written: nothing reads the sets again
    return links


def _fits(pair_n: str, pair_m: str, num: int, den: int):
    """Sizes n and m can reach the threshold together."""
    return (F.col(pair_n) * den >= F.col(pair_m) * num) & (F.col(pair_m) * den >= F.col(pair_n) * num)


def _in_index(n: str, p: str, num: int, den: int):
    """Place p (from 0) of a set of n tokens lies in the shorter prefix, of n - ceil(2t/(1+t) n) + 1 tokens,
    that suffices for partners not smaller than the set."""
    return (F.col(n) - F.col(p)) * (num + den) >= F.col(n) * (2 * num)


def _reach(num: int, den: int):
    """Position filter of two postings (n, p) and (m, q) of one token.

    If it is the first token the sets share, the intersection is at most one
    plus the shorter rest; needed is t/(1+t) of the sum of the sizes.
    """
    return F.least(F.col("n") - F.col("p"), F.col("m") - F.col("q")) * (num + den) >= (F.col("n") + F.col("m")) * num


def _size_class(num: int, den: int, wide: float = 1.0):
    """Sizes that can link lie in one class or in two next to each other."""
    if num == den:
        return F.col("n")
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(-np.log(num / den) * 1.000001 * wide))


def similar_sets(docs: DataFrame, width: int = 5, threshold: float = 0.8, text_col: str = "text",
                 id_col: str = "doc_id", sketch_bits: int = 21, filter_bits: int = 25) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links).

    A document's set: distinct ``width``-word shingles of its whole text,
    A-Z lower-cased; fewer words are one shingle.  Two documents link when
    |A and B| / |A or B| >= ``threshold`` (taken exactly, to a hundredth).
    Null and empty texts and texts without words have no set (0 shingles),
    link with nothing, and form a component with their own id.  Repeated
    rows and copies link as any others.  Null ids come out as null; a
    component's smallest id is taken over its ids that are not null.  An
    empty table gives no rows; other columns are not looked at.

    Tokens are 64-bit hashes of the shingles.  ``sketch_bits`` sets the width
    of the frequency sketch and so of its broadcast, 2^(sketch_bits+1) bytes;
    ``filter_bits`` that of the key filter, 2^filter_bits bits.  Raise both
    for larger corpora: they steer the work, never the result.
    """
    sets, final = _linked(docs, width, threshold, text_col, id_col, sketch_bits, filter_bits)
    out = sets.filter("n > 0").select("id", "n", "sig").join(final.select("sig", "component_id"), "sig").select(
        "id", "n", "component_id")
    return out.unionByName(sets.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _linked(docs: DataFrame, width: int, threshold: float, text_col: str, id_col: str, sketch_bits: int,
            filter_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows (id, h, sig, n, ...) and the classes (sig, top, component_id); ``top`` names a component, whatever its ids."""
    spark = docs.sparkSession
    num, den = round(threshold * 100), 100
    levels = spark.sparkContext.broadcast(token_levels(docs, text_col, width, sketch_bits))
    sets = materialize(_text_rows(docs, text_col, id_col).mapInArrow(
        lean(_prefixer(width, num, den, sketch_bits, levels)),
        "id long, h long, sig binary, n long, gkey long, typ double, prefix array<long>"), "join-docs")

    # identical sets are one class; the class keeps the key of one of its rows
    classes = materialize(
        sets.filter("n > 0").groupBy("sig").agg(
            F.min("h").alias("h"), F.min("id").alias("low"), F.min("n").alias("n"), F.min("gkey").alias("g"),
            F.min("typ").alias("typ")),
        "join-classes")
    # classes with one prefix and size are one group; its pivot stands for it in the first step
    groups = materialize(
        classes.groupBy("g").agg(F.min("sig").alias("pivot"), F.min("n").alias("n"), F.min("typ").alias("typ")),
        "join-groups")
    # Postings that some posting of another group can reach: per token and size class, the bounds of sizes and
    # of what follows the token.  Both are dealt by token; a token adds one posting per group and task at most
    # (copies and near copies of one prefix send one), and only if it is among the group's rarest.
    spread = (sets.filter("n > 0").select(F.col("gkey").alias("g"), "n", F.posexplode("prefix").alias("p", "t"))
              # never null, and said so: no null filter comes between the two uses and their exchange
              .select("g", "n", "p", F.coalesce("t", F.lit(0).cast("long")).alias("token"))
              .repartition("token").withColumn("z", _size_class(num, den)))
    bounds = spread.groupBy("token", "z").agg(
        F.min("g").alias("a"), F.max("g").alias("b"), F.max(F.col("n") - F.col("p")).alias("r"),
        F.min("n").alias("lo"), F.max("n").alias("hi"))
    bounds = bounds.groupBy("token").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.collect_list(
        F.struct("z", "a", "b", "r", "lo", "hi")).alias("cs")).filter("a != b").select("token", "cs")

    def reachable(c):
        return ((F.abs(c["z"] - F.col("z")) <= 1) & ((c["a"] != F.col("g")) | (c["b"] != F.col("g")))
                & (c["hi"] * den >= F.col("n") * num) & (F.col("n") * den >= c["lo"] * num)
                & (F.least(c["r"], F.col("n") - F.col("p")) * (num + den) >= (F.col("n") + c["lo"]) * num))

    postings = spread.join(bounds, "token").filter(F.exists("cs", reachable)).select("token", "g", "p").distinct()
    postings = materialize(postings.join(groups, "g"), "join-postings")

    # step 1: stars
    inside = classes.join(groups.select("g", "pivot"), "g").filter(F.col("sig") != F.col("pivot")).select(
        F.col("pivot").alias("x"), F.col("sig").alias("y"))
    sized = postings.withColumn("z", _size_class(num, den, 2.0))
    best = sized.groupBy("token", "z").agg(
        F.max(F.struct("typ", "pivot", F.col("n").alias("m"), F.col("p").alias("q"))).alias("b"))
    stars = (sized.join(best, ["token", "z"])
             .select("pivot", "n", "p", F.col("b.pivot").alias("x"), F.col("b.m").alias("m"), F.col("b.q").alias("q"))
             .filter((F.col("x") != F.col("pivot")) & _fits("n", "m", num, den) & _reach(num, den))
             .select("x", F.col("pivot").alias("y")))
    tried = materialize(inside.unionByName(stars).distinct(), "join-stars")
    links = _verified(tried, classes, docs, text_col, id_col, width, num, den, filter_bits)
    label = _labels(links)

    # step 2: all pairs of members that are still apart
    member = classes.select("g", "sig", "low").join(label, F.col("sig") == F.col("node"), "left").select(
        "g", "sig", "low", F.coalesce("label", "sig").alias("c"))
    member = materialize(member, "join-members")
    parts = member.select("g", "c").distinct()
    lists = postings.select("token", "g", "n", "p", _size_class(num, den).alias("z")).join(parts, "g")
    apart = (lists.groupBy("token").agg(F.min("c").alias("c1"), F.max("c").alias("c2"))
             .filter("c1 != c2").select("token"))
    lists = materialize(lists.join(apart, "token"), "join-lists")
    # The smaller (or equal) set of a pair has the token in its index prefix.  Components are paired first,
    # per token and size class, then only postings of paired components.
    small = lists.filter(_in_index("n", "p", num, den))
    rest = F.max(F.col("n") - F.col("p"))
    c_small = small.groupBy("token", "z", F.col("c").alias("c1")).agg(
        rest.alias("r1"), F.min("n").alias("low1"), F.max("n").alias("high1"))
    c_large = lists.groupBy("token", F.col("z").alias("z2"), F.col("c").alias("c2")).agg(
        rest.alias("r2"), F.min("n").alias("low2"), F.max("n").alias("high2")).withColumn(
        "z", F.explode(F.array(F.col("z2"), F.col("z2") - 1)))
    # no pair of postings can pass if the components' best values do not
    c_pairs = c_small.join(c_large, ["token", "z"]).filter(
        (F.col("c1") != F.col("c2")) & (F.col("low1") <= F.col("high2")) & (F.col("high1") * den >= F.col("low2") * num)
        & (F.least("r1", "r2") * (num + den) >= (F.col("low1") + F.col("low2")) * num)).select(
        "token", "z", "c1", "z2", "c2")
    g_pairs = (c_pairs
               .join(small.select("token", "z", F.col("c").alias("c1"), F.col("g").alias("g1"), "n", "p"),
                     ["token", "z", "c1"])
               .join(lists.select("token", F.col("z").alias("z2"), F.col("c").alias("c2"), F.col("g").alias("g2"),
                                  F.col("n").alias("m"), F.col("p").alias("q")), ["token", "z2", "c2"])
               .filter((F.col("n") <= F.col("m")) & _fits("n", "m", num, den) & _reach(num, den))
               .select("g1", "c1", "g2", "c2").distinct())
    # two parts of one group share their whole prefix
    own = parts.select(F.col("g").alias("g1"), F.col("c").alias("c1")).join(
        parts.select(F.col("g").alias("g2"), F.col("c").alias("c2")), F.col("g1") == F.col("g2")).filter(
        "c1 < c2").select("g1", "c1", "g2", "c2")
    pairs = (g_pairs.unionByName(own).distinct()
             .join(member.select(F.col("g").alias("g1"), F.col("c").alias("c1"), F.col("sig").alias("x")), ["g1", "c1"])
             .join(member.select(F.col("g").alias("g2"), F.col("c").alias("c2"), F.col("sig").alias("y")), ["g2", "c2"])
             .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    done = tried.unionByName(tried.select(F.col("y").alias("x"), F.col("x").alias("y")))
    pairs = materialize(pairs.join(done, ["x", "y"], "left_anti"), "join-pairs")
    more = _verified(pairs, classes, docs, text_col, id_col, width, num, den, filter_bits)
    # the new links join whole components of step 1
    at = member.select("sig", "c")
    joined = more.join(at.toDF("x", "u"), "x").join(at.toDF("y", "v"), "y")
    label = _labels(joined.select(F.col("u").alias("x"), F.col("v").alias("y")))
    parts = member.groupBy("c").agg(F.min("low").alias("low")).join(label, F.col("c") == F.col("node"), "left").select(
        "c", "low", F.coalesce("label", "c").alias("top"))
    lowest = parts.groupBy("top").agg(F.min("low").alias("component_id"))
    final = member.select("sig", "c").join(parts.join(lowest, "top").select("c", "top", "component_id"), "c").select(
        "sig", "top", "component_id")
    return sets, final


def _labels(links: DataFrame) -> DataFrame:
    return materialize(components(links.select(F.col("x").alias("u"), F.col("y").alias("v"))), "join-labels")


def drop_near_copies(docs: DataFrame, width: int = 5, threshold: float = 0.8, text_col: str = "text",
                     id_col: str = "doc_id", sketch_bits: int = 21, filter_bits: int = 25) -> DataFrame:
    """One row of each component of ``docs``, all its columns unchanged: that with the smallest id.

    Null ids come last; of rows with one id that with the smallest hash of id
    and text stays, of rows that are equal in both any one.  Rows without a
    set link with nothing and all stay.
    """
    sets, final = _linked(docs, width, threshold, text_col, id_col, sketch_bits, filter_bits)
    first = sets.filter("n > 0").groupBy("sig").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("k"))
    first = materialize(first.join(final.select("sig", "top"), "sig").groupBy("top").agg(F.min("k").alias("k")).select(
        F.col("k.id").alias("_near_id"), F.col("k.h").alias("_near_h")), "join-first")
    rows = sets.filter("n > 0").select("id", "h").join(
        first, (F.col("h") == F.col("_near_h")) & F.col("id").eqNullSafe(F.col("_near_id")))
    keep = rows.groupBy("_near_id", "_near_h").agg((F.count(F.lit(1)) > 1).alias("_near_many"))
    bare = sets.filter("n = 0").select(F.col("id").alias("_near_id"), F.col("h").alias("_near_h"),
                                       F.lit(False).alias("_near_many")).distinct()
    keep = materialize(keep.unionByName(bare), "join-keep")
    # the row as one struct: no column of ``docs`` can clash with those of the join
    ident = F.col("row").getField(id_col).cast("long")
    key = F.xxhash64(ident, F.col("row").getField(text_col).cast("string"))
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"))
    this = (key == F.col("_near_h")) & ident.eqNullSafe(F.col("_near_id"))
    once = rows.join(keep.filter(~F.col("_near_many")), this, "left_semi")
    many = rows.join(keep.filter("_near_many"), this, "left_semi").select("row", ident.alias("id"), key.alias("h"))
    kept = once.unionByName(many.groupBy("id", "h").agg(F.first("row").alias("row")).select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
