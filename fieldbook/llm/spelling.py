"""Groups of spelling variants by a dictionary of trie-node pairs.

Every word is a path in a trie and, read backwards, in a reversed trie.  The
nodes of both are numbered: a node's number is the rank of the first word
(in sorted order) that passes through it, together with its depth.  A word
with one position skipped is then a pair (prefix node, suffix node) of
integers, as is a word cut in two with nothing skipped.  Two words differ by
one replaced code point exactly if they share a pair with one skipped
position each, and by one inserted code point exactly if the shorter one's
cut is the longer one's pair.  Joining the pairs gives all neighbours, and
nothing else, with no string compared.

A pair determines a word up to the one skipped code point, so a group of
equal pairs has at most one member for each letter of the alphabet and one
cut word, however many words there are.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import quoted
from fieldbook.operators.ids import dense_ids
from fieldbook.session import materialize

BLOCK = 1 << 14  # words that one task numbers at a time
#: The letters whose case is folded.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(word: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def count_words(docs: DataFrame, min_length: int = 6, min_count: int = 5, change=None, text_col: str = "text",
                id_col: str = "doc_id") -> DataFrame:
    """(word, n): words of at least ``min_length`` code points that occur ``min_count`` times or more.

    Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the whole texts, A-Z lower-cased.  ``change``, if given, is
    a function of the columns (id, word) that rewrites each occurrence before it is counted; it must not lengthen it.
    Null and empty texts have no words.  Counts are pre-aggregated, so a very common word costs one row a task.
    """
    runs = F.regexp_extract_all(quoted(text_col).cast("string"), F.lit("([A-Za-z\\u00C0-\\u00FF]{%d,})" % min_length),
                                F.lit(1))
    words = docs.select(quoted(id_col).cast("long").alias("id"), F.explode(runs).alias("w")).select(
        "id", fold_ascii(F.col("w")).alias("w"))
    if change is not None:
        words = words.select(change(F.col("id"), F.col("w")).alias("w")).filter(F.length("w") >= min_length)
    return words.groupBy(F.col("w").alias("word")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def slipped(doc_id: Column, word: Column) -> Column:
    """The word, for one in 199 occurrences by CRC-32 of ``<doc_id>:<word>`` without one of its code points."""
    h = F.crc32(F.concat_ws(":", doc_id.cast("string"), word))
    at = F.pmod(h, F.length(word).cast("long")).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(doc_id.isNotNull() & (F.pmod(h, F.lit(199)) == 0), shorter).otherwise(word)


def _shared(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _number_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per word the rank of the first word of the block through each of its nodes; -1 where that is the block's first."""
    pdf = pdf.sort_values("rank")
    before, nodes, out = None, [], []
    for rank, word in zip(pdf["rank"].tolist(), pdf["word"].tolist()):
        if before is None:
            nodes = [-1] * len(word)
        else:
            common = _shared(before, word)
            nodes = nodes[:common] + [rank] * (len(word) - common)
        out.append(nodes)
        before = word
    return pd.DataFrame({"block": pdf["block"].to_numpy(), "rank": pdf["rank"].to_numpy(),
                         "word": pdf["word"].to_numpy(), "nodes": out})


def _carried(ends: list, block: int) -> list[tuple[int, list[int]]]:
    """Per block the numbers of the nodes that its first word shares with the last word before it."""
    out, state, last = [], [], ""
    for row in sorted(ends, key=lambda r: r["block"]):
        inherit = state[:_shared(last, row["first"])]
        start = row["block"] * block
        state = [x if x >= 0 else inherit[d] if d < len(inherit) else start for d, x in enumerate(row["nodes"])]
        last = row["last"]
        out.append((row["block"], inherit))
    return out


def trie_nodes(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, rank, nodes): the words' ranks in sorted order and the numbers of the trie nodes on their paths.

    ``nodes[d-1]`` is the rank of the first word that begins with the same d code points; with d it numbers the node.
    Words are distinct and not null.  Sorted ranks cut them into blocks that are numbered independently; only nodes that
    reach over a block's edge depend on what precedes it.  Two words a block, one word in ``block``, go to the driver
    to settle them.
    """
    spark = words.sparkSession
    ranked = dense_ids(words.select("word"), ["word"], id_col="rank", start=0)
    local = materialize(ranked.withColumn("block", F.floor(F.col("rank") / block).cast("long")).groupBy("block")
                        .applyInPandas(_number_block, "block long, rank long, word string, nodes array<long>"), "trie")
    ends = local.groupBy("block").agg(F.min_by("word", "rank").alias("first"), F.max_by("word", "rank").alias("last"),
                                      F.max_by("nodes", "rank").alias("nodes")).collect()
    carried = spark.createDataFrame(_carried(ends, block), "block long, inherit array<long>")
    nodes = F.transform("nodes", lambda x, d: F.when(x >= 0, x).otherwise(
        F.coalesce(F.get("inherit", d), F.col("block") * block)))
    return local.join(carried, "block").select("word", "rank", nodes.alias("nodes"))


def _node_pairs(words: DataFrame) -> DataFrame:
    """The trie-node pairs of ``words(rank, n, word, ahead, back)``, one row a pair, with the member it stands for.

    ``cut`` marks a word cut in two with nothing skipped.  A run of equal letters gives one word however it is
    shortened; ``first`` marks its first letter, so that each neighbour is met once.
    """
    size = F.length("word")

    def node(path: str, depth: Column) -> Column:
        return F.coalesce(F.get(path, depth - 1), F.lit(-1).cast("long"))

    def letter(k: Column) -> Column:
        return F.substring(F.col("word"), k + 1, F.lit(1))

    def pair(k: Column, skip: int) -> Column:
        rest = size - k - skip
        first = F.lit(False) if not skip else (k == 0) | (letter(k) != letter(k - 1))
        return F.struct(node("ahead", k).alias("p"), k.alias("pd"), node("back", rest).alias("s"), rest.alias("sd"),
                        F.lit(not skip).alias("cut"), first.alias("first"))

    skips = F.transform(F.sequence(F.lit(0), size - 1), lambda k: pair(k, 1))
    cuts = F.transform(F.sequence(F.lit(0), size), lambda k: pair(k, 0))
    return words.select("rank", "n", F.explode(F.concat(skips, cuts)).alias("e")).select("rank", "n", "e.*")


def neighbours(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, rank, n_near, near_n, near_rank) of ``words(word, n)``, words distinct and not empty.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced code point; ``near_rank`` is the
    rank of that with the largest n (ties: first in sorted order), null if there is none.
    """
    ahead = trie_nodes(words, block).withColumnRenamed("nodes", "ahead")
    back = trie_nodes(words.select(F.reverse("word").alias("word")), block).select(
        F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    numbered = materialize(words.join(ahead, "word").join(back, "word"), "trie-words")
    member = F.struct("n", (-F.col("rank")).alias("o"), "cut", "first")
    groups = _node_pairs(numbered).groupBy("p", "pd", "s", "sd").agg(
        F.sort_array(F.collect_list(member), asc=False).alias("g")).filter(F.size("g") > 1).select("g", F.explode("g").alias("x"))
    # members stand by falling n, ties by word: the first that fits is the best
    near = F.filter("g", lambda y: (y["o"] != F.col("x.o")) & F.when(
        F.col("x.cut"), y["first"]).otherwise(~y["cut"] | F.col("x.first")))
    met = groups.select((-F.col("x.o")).alias("rank"), near.alias("near")).filter(F.size("near") > 0).groupBy("rank").agg(
        F.sum(F.size("near")).alias("n_near"),
        F.max(F.struct(F.col("near")[0]["n"].alias("n"), F.col("near")[0]["o"].alias("o"))).alias("best"))
    return numbered.select("word", "n", "rank").join(met, "rank", "left").select(
        "word", "n", "rank", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.n").alias("near_n"), (-F.col("best.o")).alias("near_rank"))


def _roots(links: DataFrame) -> DataFrame:
    """(rank, root) of ``links(rank, next)``, a forest: where the links end, by pointer doubling."""
    now = links.select("rank", F.col("next").alias("root"))
    while True:
        on = now.alias("a").join(now.select(F.col("rank").alias("via"), F.col("root").alias("far")),
                                 F.col("root") == F.col("via"), "left")
        now = materialize(on.select("rank", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")),
                          "spelling-roots")
        if now.filter("moved").limit(1).count() == 0:
            return now.select("rank", "root")


def spelling_variants(words: DataFrame, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words(word string, n long)``, one row a word.

    A word's ``form`` is its neighbour of largest n (ties: smallest in code-point order), if that n is at least ``ratio``
    times its own; else null.  ``root`` is where the forms lead (the word itself if it has none); counts grow ``ratio``
    times (2 at least) with every step, so there are no circles and at most 63 steps.

    Null and empty words are left out and repeated words counted together; an empty table gives no rows; other columns
    are not looked at.  Words may be of any length: a word of L code points makes 2 L + 1 pairs.
    """
    if ratio < 2:
        raise ValueError("ratio: 2 or more")
    words = words.filter(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n"))
    near = neighbours(materialize(words, "spelling-words"), block)
    near = materialize(near.withColumn("form_rank", F.when(F.col("near_n") >= F.col("n") * ratio, F.col("near_rank"))),
                       "spelling-near")
    roots = _roots(near.filter("form_rank is not null").select("rank", F.col("form_rank").alias("next")))
    names = near.select(F.col("rank").alias("at"), F.col("word").alias("named"))
    variants = (near.filter("form_rank is not null").join(roots, "rank")
                .join(names.toDF("form_rank", "form"), "form_rank").join(names.toDF("root", "root_word"), "root")
                .select("word", "form", F.col("root_word").alias("root"), "n", "n_near", F.col("near_n").alias("form_n")))
    plain = near.filter("form_rank is null").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near",
        F.lit(None).cast("long").alias("form_n"))
    return variants.unionByName(plain)
