"""Connected components of an edge table by alternating star contraction.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): large
stars and small stars alternate until every node points at the smallest node
of its component.  Every round is two aggregations with map-side minima and
two joins; edges are written after each round, so lineage stays short and a
lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter(F.col("v") < F.col("u"))
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    pairs = near.join(low, "u")
    if large:
        out = pairs.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): for every node of ``edges(u, v)`` the smallest node it is connected to.

    Any orderable node type; self loops and repeated edges do no harm, nulls
    are not allowed.  Only a count and a checksum per round reach the driver.
    """
    now = materialize(edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        now = materialize(_star(now, True), "cc")
        now = materialize(_star(now, False), "cc")
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
