"""Approximate nearest neighbours on robust-pruned directed graphs.

Vectors are dealt into shards of bounded size, and every shard builds a graph
as DiskANN's Vamana does (Subramanya et al. 2019): a greedy search from the
entry point proposes neighbours of a new point, relaxed distance pruning
(alpha) keeps few, diverse edges, and reverse edges are added and pruned in
turn.  Points are inserted in batches whose searches run side by side.  A
query goes through every shard by beam search, and the shards' best are
merged.  Distances in results are computed in double precision on the
original vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import quoted
from fieldbook.session import materialize


ENTRIES = 128  # points of a shard where searches start


def spread_points(x: np.ndarray, count: int) -> np.ndarray:
    """Points far from each other: the one next to the mean, then always the one farthest from those chosen."""
    near = ((x - x.mean(0)) ** 2).sum(1)
    chosen = [int(near.argmin())]
    left = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(count, len(x)):
        far = int(left.argmax())
        if left[far] <= 0:
            break
        chosen.append(far)
        left = np.minimum(left, ((x - x[far]) ** 2).sum(1))
    return np.array(chosen, np.int64)


def beam_search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int):
    """(ids, squared distances) of the beams, nearest first, -1 where a beam is not full.

    A search starts from all ``entries``, of which the beam keeps the nearest.
    """
    b = len(queries)
    ids = np.full((b, beam), -1, np.int64)
    dist = np.full((b, beam), np.inf, x.dtype)
    seen = np.zeros((b, beam), bool)
    first = ((queries[:, None, :] - x[entries][None, :, :]) ** 2).sum(2)
    start = np.argsort(first, axis=1, kind="stable")[:, :beam]
    ids[:, :start.shape[1]] = entries[start]
    dist[:, :start.shape[1]] = np.take_along_axis(first, start, 1)
    rows = np.arange(b)
    while True:
        fresh = ~seen[rows] & (ids[rows] >= 0)
        rows, fresh = rows[fresh.any(1)], fresh[fresh.any(1)]
        if not len(rows):
            return ids, dist
        pick = fresh.argmax(1)
        here = ids[rows, pick]
        seen[rows, pick] = True
        near = edges[here]
        new = (near >= 0) & ~(near[:, :, None] == ids[rows][:, None, :]).any(2)
        d = ((x[near] - queries[rows][:, None, :]) ** 2).sum(2)
        d[~new] = np.inf
        all_d = np.concatenate([dist[rows], d], 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        take = np.arange(len(rows))[:, None]
        dist[rows] = all_d[take, order]
        ids[rows] = np.where(np.isinf(dist[rows]), -1, np.concatenate([ids[rows], near], 1)[take, order])
        seen[rows] = np.concatenate([seen[rows], np.zeros(near.shape, bool)], 1)[take, order]


def robust_prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of ``points`` chosen from candidate ids (-1: none): nearest first, and a
    candidate goes when a chosen one is ``alpha`` times nearer to it than the point is."""
    b, c = cand.shape
    cand = np.sort(cand, 1)
    gone = (cand < 0) | (cand == points[:, None])
    gone[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    v = x[cand]
    d = ((v - x[points][:, None, :]) ** 2).sum(2)
    d[gone] = np.inf
    sq = (v ** 2).sum(2)
    between = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * (v @ v.transpose(0, 2, 1)), 0)
    out = np.full((b, degree), -1, np.int64)
    rows = np.arange(b)
    left = d.copy()
    for k in range(degree):
        best = left.argmin(1)
        ok = np.isfinite(left[rows, best])
        if not ok.any():
            break
        out[ok, k] = cand[rows, best][ok]
        drop = (alpha * alpha) * between[rows, best] <= d
        left[drop] = np.inf
        left[rows, best] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int, beam: int, alpha: float, batch: int = 256, seed: int = 5):
    """(edges, entries) of the robust-pruned graph of the rows of x.

    Pruning favours near edges, so a graph of tight clusters may fall apart; searches therefore start from ``ENTRIES``
    points spread over the data, one in every cluster as long as there are no more clusters than that.
    """
    n = len(x)
    edges = np.full((n, degree), -1, np.int64)
    entries = spread_points(x, ENTRIES)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([entries, order[~np.isin(order, entries)]])
    at = len(entries)
    for a in range(0, at, 32):
        some = entries[a:a + 32]
        edges[some] = robust_prune(x, some, np.tile(entries, (len(some), 1)), degree, alpha)
    while at < n:
        new = order[at:at + min(batch, max(8, at))]
        found, _ = beam_search(x, edges, entries, x[new], beam)
        # points of one batch cannot find each other yet: add their nearest within the batch
        sq = (x[new] ** 2).sum(1)
        mutual = sq[:, None] + sq[None, :] - 2 * (x[new] @ x[new].T)
        np.fill_diagonal(mutual, np.inf)
        k = min(8, len(new) - 1)
        own = new[np.argsort(mutual, 1)[:, :k]] if k else np.empty((len(new), 0), np.int64)
        edges[new] = robust_prune(x, new, np.concatenate([found, own], 1), degree, alpha)
        # reverse edges, by target
        src, dst = np.repeat(new, degree), edges[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        at += len(new)
        if not len(dst):
            continue
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        targets, first, count = np.unique(dst, return_index=True, return_counts=True)
        wide = np.full((len(targets), int(count.max())), -1, np.int64)
        wide[np.repeat(np.arange(len(targets)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
        for a in range(0, len(targets), batch):
            t = targets[a:a + batch]
            w = wide[a:a + batch]
            w = w[:, (w >= 0).any(0)]
            both = np.concatenate([edges[t], w], 1)
            full = (both >= 0).sum(1) > degree
            if full.any():
                edges[t[full]] = robust_prune(x, t[full], both[full], degree, alpha)
            if (~full).any():
                kept = np.sort(both[~full], 1)
                kept[:, 1:][kept[:, 1:] == kept[:, :-1]] = -1  # an edge that was there already
                edges[t[~full]] = -np.sort(-kept, 1)[:, :degree]
    return edges, entries


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows moved by their median and scaled into [-1, 1], in single precision: neighbours stay neighbours, and neither
    a far origin nor huge or tiny values cost the graph its digits."""
    top = np.abs(x).max()
    x = x / top if top > 0 else x  # first, so that no difference overflows
    x = x - np.median(x, axis=0)
    top = np.abs(x).max()
    return (x / top if top > 0 else x).astype(np.float32)


def _builder(degree: int, beam: int, alpha: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid").reset_index(drop=True)
        x = scaled(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        edges, entries = build_graph(x, degree, beam, alpha)
        pdf["edges"] = [e[e >= 0] for e in edges]
        pdf["entry"] = np.isin(np.arange(len(pdf)), entries)
        return pdf[["dim", "shard", "cid", "v", "ids", "edges", "entry"]]
    return run


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x to q, also where the squares would overflow or vanish."""
    with np.errstate(over="ignore", under="ignore"):
        diff = x - q
        d = np.sqrt((diff ** 2).sum(1))
        odd = ~(d < 1e150) | (d < 1e-150)
        if odd.any():
            top = np.abs(diff[odd]).max(1)
            safe = np.where((top > 0) & np.isfinite(top), top, 1.0)
            d[odd] = top * np.sqrt(((diff[odd] / safe[:, None]) ** 2).sum(1)) if np.isfinite(top).all() else d[odd]
    return d


def _searcher(k: int, beam: int):
    cols = ["query_id", "qcid", "vec_id", "score"]

    def run(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if graph.empty or queries.empty:
            return pd.DataFrame({c: [] for c in cols})
        graph = graph.sort_values("cid").reset_index(drop=True)
        x = np.stack(graph["v"].to_numpy()).astype(np.float64)
        q = np.stack(queries["v"].to_numpy()).astype(np.float64)
        n = len(x)
        top = max(np.abs(x).max(), np.abs(q).max())
        # squares of huge or tiny components leave the range of numbers: the walk takes scaled ones
        walk, wq = (x / top, q / top) if not 1e-100 < top < 1e100 else (x, q)
        if n > beam:
            edges = np.full((n, max(1, max(map(len, graph["edges"])))), -1, np.int64)
            for i, e in enumerate(graph["edges"]):
                edges[i, :len(e)] = e
            entries = np.flatnonzero(graph["entry"].to_numpy())
        out = []
        for a in range(0, len(q), 256):
            part = q[a:a + 256]
            if n > beam:
                found, _ = beam_search(walk, edges, entries, wq[a:a + 256], beam)
            else:  # the beam holds the whole shard
                found = np.tile(np.arange(n), (len(part), 1))
            for j, near in enumerate(found):
                near = np.unique(near[near >= 0])
                d = distances(x[near], part[j])
                ids = graph["ids"].to_numpy()[near]
                vec = np.concatenate(ids)
                score = np.repeat(d, [len(i) for i in ids])
                own = int(queries["query_id"].iloc[a + j])
                vec, score = vec[vec != own], score[vec != own]
                best = np.lexsort((vec, score))[:k]
                out.append(pd.DataFrame({"query_id": own, "qcid": int(queries["cid"].iloc[a + j]),
                                         "vec_id": vec[best], "score": score[best]}))
        return pd.concat(out, ignore_index=True)[cols]
    return run


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, shard_rows: int = 8192, degree: int = 32,
            build_beam: int = 48, search_beam: int = 240, alpha: float = 1.2, query_block: int = 20000,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest found of every row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Euclidean distance in double precision, nearest first, ties to the
    smaller id; candidates are all rows but those with the query's own id
    (all of them, if fewer than k).  Rows with a null id and vectors that are
    null, empty, zero or hold null or non-finite numbers take no part;
    vectors are compared with those of their own length.  Repeated rows
    count once.  An empty table gives no rows.

    Equal vectors are one point of the graph that carries its k+1 smallest
    ids: no more can be among anyone's k nearest, so nothing is lost and a
    very common vector stays small (each task sends k+1 of its ids).
    """
    v = quoted(vec_col)
    rows = (vectors.select(quoted(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))
            .filter("id is not null and size(v) > 0")
            .filter(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))))
            .filter(F.exists("v", lambda c: c != 0)).dropDuplicates())
    by = Window.partitionBy("v").orderBy("id")
    points = (rows.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= k + 1)
              .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
              .select("v", "ids", F.element_at("ids", 1).alias("cid"), F.size("v").alias("dim")))
    points = materialize(points, "ann-points")
    shards = max(1, -(-points.count() // shard_rows))
    graph = (points.withColumn("shard", F.pmod(F.xxhash64("cid"), F.lit(shards)).cast("int"))
             .groupBy("dim", "shard").applyInPandas(
                 _builder(degree, build_beam, alpha),
                 "dim int, shard int, cid long, v array<double>, ids array<long>, edges array<long>, entry boolean"))
    graph = materialize(graph, "ann-graph")
    queries = rows.filter(F.col("id") % every == 0).select(
        F.col("id").alias("query_id"), F.xxhash64("v").alias("cid"), "v", F.size("v").alias("dim"))
    blocks = max(1, -(-queries.count() // query_block))
    queries = queries.select(
        "query_id", "cid", "v", "dim", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    spread = graph.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = spread.groupBy("dim", "shard", "qb").cogroup(queries.groupBy("dim", "shard", "qb")).applyInPandas(
        _searcher(k, search_beam), "query_id long, qcid long, vec_id long, score double")
    best = Window.partitionBy("query_id", "qcid").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
