"""Maximal periodic runs of words by longest common extensions over a difference cover.

The words of a block of texts become one sequence of integers, a separator
of its own before, between and after the texts.  A difference cover of 31
residues has, for any two positions, a common shift below 31 that brings
both to sampled positions.  Only suffixes at sampled positions (6 of 31)
are sorted; the common prefix of any two is a range minimum over the
neighbours' common prefixes, answered by a sparse table.  A longest common
extension of two positions thus compares at most 30 words and asks once.

For every period p the sequence carries a grid of positions p apart (n/p of
them, a harmonic sum over all p).  A run of period p holds two neighbouring
grid positions, and their extensions to both sides give the whole run.
Separators are unique, so no run reaches over the end of its text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import WORD_CLASS, lean, quoted

#: A perfect difference set; every residue modulo 31 is a difference of two of them.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)

BLOCK_BYTES = 2 << 20
_PAIRS = 1 << 20  # grid pairs looked at together
_ROWS = 1 << 16


def _shifts() -> np.ndarray:
    """For residues a and b, the least shift that brings both into the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    table = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for s in range(MODULUS - 1, -1, -1):
        moved = np.roll(inside, -s)
        table[np.outer(moved, moved)] = s
    return table


class CommonExtensions:
    """Length of the longest common prefix of the suffixes at any two positions of an integer sequence.

    The last value must be unique in the sequence, so that no two suffixes
    are equal and every common prefix ends inside.
    """

    def __init__(self, seq: np.ndarray):
        self.n = len(seq)
        self.padded = np.concatenate([seq.astype(np.int64) + 1, np.zeros(MODULUS, np.int64)])
        self.shift = _shifts()
        self.rank = None  # the sampled suffixes are sorted when a query first needs them

    def _sort_samples(self) -> None:
        chains = [np.arange(c, self.n, MODULUS) for c in COVER]  # the next sample of a chain is 31 words on
        at = np.concatenate(chains)
        m = len(at)
        after = np.concatenate([np.arange(len(c) - 1, -1, -1) for c in chains])
        self.slot = np.full(self.n + 1, -1, np.int64)
        self.slot[at] = np.arange(m)
        words = np.lib.stride_tricks.sliding_window_view(self.padded, MODULUS)
        keys = words[at].astype(">u4").view(np.dtype((np.void, 4 * MODULUS))).ravel()
        levels = [np.unique(keys, return_inverse=True)[1].ravel()]
        step = 1
        while int(levels[-1].max()) + 1 < m:  # twice as many words a round, until all suffixes differ
            rank = levels[-1].astype(np.int64)
            more = np.zeros(m, np.int64)
            has = np.flatnonzero(after >= step)
            more[has] = rank[has + step] + 1
            levels.append(np.unique(rank * (m + 1) + more, return_inverse=True)[1].ravel())
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        common = np.empty(max(m - 1, 0), np.int64)
        for a in range(0, m - 1, _ROWS):
            x, y = order[a:a + _ROWS][:m - 1 - a].copy(), order[a + 1:a + 1 + _ROWS].copy()
            first = at[x]
            for t in range(len(levels) - 1, -1, -1):
                same = levels[t][x] == levels[t][y]
                x[same] += 1 << t
                y[same] += 1 << t
            differ = words[at[x]] != words[at[y]]
            common[a:a + _ROWS] = at[x] - first + np.argmax(differ, axis=1)
        self.rank = levels[-1].astype(np.int64)
        self.table = [common]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            half, now = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(now[:-half], now[half:]))

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if self.rank is None:
            self._sort_samples()
        a, b = self.rank[self.slot[i]], self.rank[self.slot[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            out[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << int(k))])
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix lengths at the positions i and j (i != j), one for each pair."""
        out = np.zeros(len(i), np.int64)
        shift = self.shift[i % MODULUS, j % MODULUS]
        alive, t = np.arange(len(i)), 0
        while len(alive):
            there = shift[alive] == t
            if there.any():
                own = alive[there]
                out[own] = t + self._sampled(i[own] + t, j[own] + t)
                alive = alive[~there]
            same = self.padded[i[alive] + t] == self.padded[j[alive] + t]
            out[alive[~same]] = t
            alive, t = alive[same], t + 1
        return out


def find_runs(seq: np.ndarray, longest_text: int, least: int) -> np.ndarray:
    """Rows (start, end, period) of all runs of a sequence whose first and last value are unique.

    A run is a stretch of smallest period q and length max(least, 2 q) or more that cannot be extended; ``longest_text``
    bounds its length.  Sorted by start, end.
    """
    n = len(seq)
    right, left = CommonExtensions(seq), CommonExtensions(seq[::-1])
    found = np.empty((0, 3), np.int64)
    top = longest_text // 2
    counts = (n - 1) // np.arange(1, top + 1) if top else np.empty(0, np.int64)
    ends = np.cumsum(counts)
    p = 1
    while p <= top:
        done = int(ends[p - 2]) if p > 1 else 0
        last = max(p, int(np.searchsorted(ends, done + _PAIRS, side="right")))
        for cut in range(0, int(ends[last - 1]) - done, _PAIRS):  # a single small period may hold more than _PAIRS
            number = np.arange(cut, min(cut + _PAIRS, int(ends[last - 1]) - done))
            period = p + np.searchsorted(ends[p - 1:last] - done, number, side="right")
            before = np.where(period > 1, ends[period - 2], 0) - done
            i = (number - before) * period
            inside = i + period < n
            i, period = i[inside], period[inside]
            same = np.flatnonzero(seq[i] == seq[i + period])
            i, q = i[same], period[same]
            ahead = right(i, i + q)
            back = left(n - i, n - i - q)
            hit = (ahead + back >= q) & (ahead + back + q >= least)
            i, q, ahead, back = i[hit], q[hit], ahead[hit], back[hit]
            found = np.concatenate([found, np.stack([i - back, i + q + ahead, q], axis=1)])
            # one stretch found at many grid positions, or again at a multiple of its period: the least period stays
            found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
            keep = np.ones(len(found), bool)
            keep[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
            found = found[keep]
        p = last + 1
    return found


def _block(texts: list[bytes | None], least: int):
    """Runs and collapsed texts of a block of texts."""
    words = [t.split() if t else [] for t in texts]  # bytes.split() cuts exactly at 0x20 and 0x09-0x0D
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [x for w in words for x in w]
    codes = pd.factorize(flat)[0].astype(np.int64) if len(flat) else np.empty(0, np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)])
    base = int(codes.max()) + 1 if len(codes) else 0
    # separator, words, separator, words, ..., separator
    seq = np.insert(codes, before, base + np.arange(len(texts) + 1))
    starts = before[:-1] + np.arange(1, len(texts) + 1)  # where each text begins in seq
    runs = find_runs(seq, int(sizes.max(initial=0)), least)
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    dropped = np.zeros(len(seq) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 1], -1)
    dropped = np.cumsum(dropped) > 0
    out = []
    for k, own in enumerate(words):
        gone = dropped[starts[k]:starts[k] + sizes[k]]
        out.append(b" ".join(own if not gone.any() else [x for x, g in zip(own, gone) if not g]))
    order = np.lexsort((runs[:, 2], runs[:, 0], owner))
    runs, owner = runs[order], owner[order]
    return sizes, runs, owner, starts, out


def _finder(least: int):
    def flush(ids, texts):
        sizes, runs, owner, starts, collapsed = _block(texts, least)
        rows = pa.StructArray.from_arrays(
            [pa.array(runs[:, 0] - starts[owner], pa.int64()), pa.array(runs[:, 1] - runs[:, 0], pa.int64()),
             pa.array(runs[:, 2], pa.int64())], names=["start", "length", "period"])
        lists = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()), rows)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), lists, pa.array(collapsed, pa.binary()).view(pa.string())],
            names=["id", "n_words", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            ids, held, size, first = batch.column(0), [], 0, 0
            for text in batch.column(1).cast(pa.binary()):
                held.append(text.as_py())
                size += len(held[-1] or b"")
                if size >= BLOCK_BYTES:
                    yield flush(ids.slice(first, len(held)), held)
                    first += len(held)
                    held, size = [], 0
            if held:
                yield flush(ids.slice(first, len(held)), held)
    return run


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = 12) -> DataFrame:
    """One row per input row: ``id_col``, n_words, runs, collapsed; no shuffle.

    ``runs`` (array of start, length, period in words from 0, by start, then
    period) holds every stretch of words of smallest period q and length
    max(``min_length``, 2 q) or more that no neighbouring word extends.
    ``collapsed`` is the words outside repetitions joined by one space: a
    word goes if some run contains it after that run's first q words.

    Whole texts of any length: a text is never cut, and a block holds 2 MB of
    texts or one longer text (some 25 times its bytes of memory in the task).
    Null and empty texts have 0 words, no runs and an empty collapsed text;
    repeated rows count each; an empty table gives no rows; other columns are
    not looked at.  Ids are whole numbers or null.
    """
    if min_length < 2:
        raise ValueError("min_length: 2 or more")
    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("t"))
    return rows.mapInArrow(
        lean(_finder(min_length)),
        "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    ).withColumnRenamed("id", id_col)


def repeated_stretch(doc_id: Column, text: Column) -> Column:
    """The text, for a tenth of the documents with its end replaced by a repetition of its own words.

    Let h be the CRC-32 of the decimal id and g = h div 10.  If h mod 10 = 0 and the text has n > 0 words, each word
    i >= a becomes word a + (i-a) mod p, with a = g mod n and p = 1 + (n-a) div (3 + g mod 8).
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD_CLASS})"), F.lit(1))

    def changed(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int")))), " ")

    # the words are cut once: the array is the only element that transform sees
    planted = F.element_at(F.transform(F.array(words), changed), 1)
    return F.when((F.pmod(h, F.lit(10)) == 0) & (F.regexp_instr(text, F.lit(WORD_CLASS)) > 0), planted).otherwise(text)


def run_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = 12) -> DataFrame:
    """Per document the number of runs, the longest one (ties: smallest start, then period) and digests of the results."""
    found = periodic_runs(docs, text_col, id_col, min_length)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
