"""Mixing sources to target weights by subset-sum budget fitting.

Sources share the whole word count by weight; a target stops at a multiple
of its source's size and the excess is shared again.  A source repeats all
its documents as often as the target holds its size.  What remains of the
budget is fitted by counts per exact document length: a proportional part of
every length, then long documents, then a bounded-knapsack dynamic programme
on what is left.  Which documents of a length are taken is drawn by a seeded
hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import packed, quoted, word_count
from fieldbook.operators.ids import dense_ids
from fieldbook.session import materialize

KNAPSACK_BUDGET = 1 << 15  # words that the dynamic programme fits at most, unless one document is longer


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take (at most counts) for the largest sum <= budget."""
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return take
    items, first = [], np.full(budget + 1, -1, np.int64)
    reach = np.zeros(budget + 1, bool)
    reach[0] = True
    for i, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist())):
        count, part = min(count, budget // length), 1
        while count > 0:  # binary splitting
            part = min(part, count)
            w = part * length
            new = np.zeros_like(reach)
            new[w:] = reach[:budget + 1 - w]
            new &= ~reach
            first[new] = len(items)
            reach |= new
            items.append((i, part, w))
            count, part = count - part, part * 2
        if reach[budget]:
            break
    at = int(np.flatnonzero(reach)[-1])
    while at > 0:
        i, part, w = items[first[at]]
        take[i] += part
        at -= w
    return take


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts per length whose total length comes as near below ``budget`` as the steps reach.

    The proportional part bounds the rest by the sum of the distinct lengths;
    long documents bring it under ``KNAPSACK_BUDGET``; the knapsack is exact.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    rest = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= KNAPSACK_BUDGET:
            break
        q = min(int(counts[i] - take[i]), -(-(rest - KNAPSACK_BUDGET) // int(lengths[i])), rest // int(lengths[i]))
        take[i] += q
        rest -= q * int(lengths[i])
    left = counts - take
    fits = (lengths <= rest) & (left > 0)
    take[fits] += knapsack(lengths[fits], left[fits], rest)
    return take


def _planner(max_repeat: int):
    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("len")
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        lengths, counts = pdf["len"].to_numpy(), pdf["docs"].to_numpy()
        base = min(max_repeat, int(target // size))
        rest, more = int(round(target - base * size)), []
        for _ in range(max_repeat - base):  # a further time round only if the documents do not fill the budget
            more.append(fit_budget(lengths, counts, rest))
            rest -= int((more[-1] * lengths).sum())
        if more and rest > 0:  # one more document if that comes nearer
            near = np.flatnonzero((more[0] < counts) & (lengths > rest) & (lengths < 2 * rest))
            if len(near):
                more[0][near[0]] += 1
        return pd.DataFrame({"srank": pdf["srank"], "len": lengths, "base": base,
                             "more": list(np.array(more, np.int64).reshape(len(more), len(pdf)).T)})
    return plan


def targets(sizes: DataFrame, weights: tuple[float, ...], max_repeat: float, share: float) -> DataFrame:
    """Targets of ``sizes(srank, source_size)``: water filling under the caps.

    Every round caps the sources whose share is over ``max_repeat`` times
    their size and shares the rest anew; two sums per round reach the driver.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("srank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sizes = sizes.withColumn("w", w).withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    total = (sizes.agg(F.sum("source_size")).first()[0] or 0) * share
    level, before = 0.0, -1.0
    while level != before:
        over = F.col("w") * F.lit(level) > F.col("cap")
        spent, open_w = sizes.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
                                  F.sum(F.when(over, 0.0).otherwise(F.col("w")))).first()
        before = level
        if not open_w:
            break
        level = max(level, (total - spent) / open_w)
    return sizes.withColumn("target", F.least(F.col("cap"), F.col("w") * F.lit(level)))


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, share: float = 1.0,
             seed: int = 7, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source"):
    """(rows, decisions): the narrow rows of ``docs`` and one decision per (source, id, size).

    Rows that agree in source, id and size are one item and share one
    decision; they count with the sum of their sizes.
    """
    rows = materialize(docs.select(
        quoted(id_col).alias("id"), quoted(source_col).cast("string").alias("source"),
        word_count(quoted(text_col).cast("string")).alias("size")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "last", F.col("source").isNull())
    sizes = materialize(targets(dense_ids(sizes, ["last", "source"], id_col="srank"), weights, max_repeat, share),
                        "mix-sources").select("source", "srank", "source_size", "target")
    items = rows.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("copies"))
    items = items.join(sizes.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    items = items.withColumn("len", F.col("size") * F.col("copies"))
    lengths = items.filter("len > 0").groupBy("srank", "len").agg(
        F.count(F.lit(1)).alias("docs"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    plan = lengths.groupBy("srank").applyInPandas(_planner(max_repeat), "srank long, len long, base long, more array<long>")
    items = materialize(items.withColumn("draw", F.xxhash64(F.lit(seed), F.col("id"))), "mix-items")
    drawn = dense_ids(items, ["draw", "id", "size"], id_col="rank", partition_by=["srank", "len"])
    decided = drawn.join(materialize(plan, "mix-plan"), ["srank", "len"], "left").select(
        "source", "id", "size", "source_size", "target",
        F.coalesce(F.col("base") + F.size(F.filter("more", lambda m: F.col("rank") <= m)), F.lit(0)).cast("long")
        .alias("repeats"))
    return rows, decided


def _same(a: DataFrame, b: DataFrame):
    """Join condition: one item (null equals null)."""
    return a["id"].eqNullSafe(b["id"]) & a["source"].eqNullSafe(b["source"]) & (a["size"] == b["size"])


def mix_sources(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (size times repeats).

    ``size`` counts the words ``[^\\x20\\x09-\\x0D]+`` (null: 0).  Sources in
    code point order, null last, weigh ``weights`` in turn.  Null is a source
    of its own.  Documents without words take part with 0; a table without
    rows gives none.  Ties between documents of one length are drawn by
    xxhash64 of (seed, id), so reruns agree.  Extra columns are not looked at.
    """
    rows, decided = mix_plan(docs, id_col=id_col, **options)
    return rows.join(decided, _same(rows, decided)).select(
        rows["id"].alias(id_col), rows["size"], "source_size", "target",
        (rows["size"] * F.col("repeats")).alias("taken"))


def mixed_rows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source",
               **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all its columns unchanged.

    Documents without words carry no budget and stay once.
    """
    _, decided = mix_plan(docs, text_col=text_col, id_col=id_col, source_col=source_col, **options)
    decided = decided.select("id", "source", "size", F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.col("repeats")).cast("int").alias("repeats")).filter("repeats > 0")
    row = F.col("row")
    whole = packed(docs).select(
        "row", row.getField(id_col).alias("id"), row.getField(source_col).cast("string").alias("source"),
        word_count(row.getField(text_col).cast("string")).alias("size"))
    picked = whole.join(decided, _same(whole, decided)).select(
        F.explode(F.array_repeat(F.col("row"), F.col("repeats"))).alias("row"))
    return picked.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
