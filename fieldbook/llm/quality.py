"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

A text is cut into runs of letters and digits and runs of other marks.  Two
families of n-grams are hashed into one table: the tokens' own uni- and
bigrams, and uni-, bi- and trigrams of their shapes (case, digits, the mark
itself, "same as the token before").  Each family is scaled to length one.

Training follows the regularised leader (McMahan et al. 2013) on shards of a
bounded sample of labelled rows; after every epoch the shards' states are
averaged.  Scoring is one sparse dot product per document over the whole
text, in the scan itself: no text is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import lean, quoted, splitmix
from fieldbook.session import materialize

TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\s]+")
_SLICE = 1 << 20
_C = np.uint64(0x9E3779B97F4A7C15)


class _Tokens(dict):
    """token -> (hash, shape), forgetting everything when it grows large."""

    def __missing__(self, token: bytes):
        t = token.decode("utf-8", "replace")
        if t[0].isdigit():
            shape = 1
        elif not (t[0].isalpha() or t[0] == "_"):
            shape = 16 + (xxhash.xxh3_64_intdigest(token) & 0xFFFFF)
        elif t.islower():
            shape = 2
        elif t.isupper():
            shape = 3 if len(t) > 1 else 4
        elif t.istitle():
            shape = 5
        else:
            shape = 6
        if len(self) > 300_000:
            self.clear()
        self[token] = value = (xxhash.xxh3_64_intdigest(token), shape)
        return value


def _grams(text: bytes, known: _Tokens, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the token n-grams and of the shape n-grams of a text."""
    tokens = TOKEN.findall(text)
    if not tokens:
        none = np.empty(0, np.int64)
        return none, none
    both = np.array([known[t] for t in tokens], np.uint64)
    h, s = both[:, 0], both[:, 1].copy()
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    s[same] = 7
    shift = np.uint64(64 - bits)

    def slots(x, salt):
        return (splitmix(x * _C + np.uint64(salt)) >> shift).astype(np.int64)

    s2 = s[:-1] * np.uint64(1 << 21) + s[1:]
    return (np.concatenate([slots(h, 1), slots(splitmix(h[:-1] + _C) + h[1:], 2)]),
            np.concatenate([slots(s, 3), slots(s2, 4), slots(s2[:-1] * np.uint64(1 << 21) + s[2:], 5)]))


def features(text: bytes | None, known: _Tokens, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text; long texts go through slice by slice, counts add up.

    Counts enter as 1 + ln(count).  Slice ends move to the next space.
    """
    text = text or b""
    words, shapes = [], []
    at = 0
    while at < len(text):
        end = min(len(text), at + _SLICE)
        if end < len(text):
            nxt = text.find(b" ", end, end + _SLICE)
            end = nxt if nxt >= 0 else min(len(text), end + _SLICE)
        w, s = _grams(text[at:end], known, bits)
        words.append(np.unique(w, return_counts=True))
        shapes.append(np.unique(s, return_counts=True))
        at = end
    out_i, out_v = [], []
    for family in (words, shapes):
        if not family:
            continue
        i, where = np.unique(np.concatenate([x[0] for x in family]), return_inverse=True)
        if len(i) == 0:
            continue
        v = 1 + np.log(np.bincount(where, np.concatenate([x[1] for x in family])))
        out_i.append(i)
        out_v.append(v / np.sqrt(v @ v))
    if not out_i:
        return np.empty(0, np.int64), np.empty(0)
    return np.concatenate(out_i), np.concatenate(out_v)


def _weights(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    w[np.abs(z) <= l1] = 0.0
    return w


def _featuriser(bits: int):
    def run(batches):
        known = _Tokens()
        for batch in batches:
            found = [features(t.as_py(), known, bits) for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))], names=["id", "label", "slots", "vals"])
    return run


def _epoch(state, bits: int, alpha: float, beta: float, l1: float, l2: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        z, n = (a.astype(np.float64) for a in state.value)
        pdf = pdf.sort_values(["draw", "id"])
        bias = 1 << bits
        for y, i, v in zip(pdf["label"], pdf["slots"], pdf["vals"]):
            i, v = np.append(np.asarray(i, np.int64), bias), np.append(np.asarray(v, np.float64), 1.0)
            w = _weights(z[i], n[i], alpha, beta, l1, l2)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ v, -35, 35)))
            g = (p - y) * v
            # a slot may occur in both families: add, don't assign
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            np.add.at(z, i, g - sigma * w)
            np.add.at(n, i, g * g)
        return pd.DataFrame({"rows": [len(pdf)], "z": [z.astype(np.float32).tobytes()],
                             "n": [n.astype(np.float32).tobytes()]})
    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 12000, bits: int = 18, shards: int = 4,
          epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.0,
          text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality") -> np.ndarray:
    """Weights (2^bits slots and the bias) learnt from at most ``sample_rows`` labelled rows.

    ``labels`` has the id and a 0/1 label; rows with a null in either are
    left out.  The sample is the rows with the smallest hash of their id, so
    it is the same on every run.  Without any label all weights are 0 and
    every score is 0.5.
    """
    spark = docs.sparkSession
    picked = (labels.select(quoted(id_col).alias("_id"), quoted(label_col).cast("int").alias("label"))
              .filter("_id is not null and label in (0, 1)")
              .withColumn("_draw", F.xxhash64("_id")).orderBy("_draw", "_id", "label").limit(sample_rows))
    picked = materialize(picked, "quality-sample").dropDuplicates(["_id"])
    # the two columns that are looked at: no other one can clash
    texts = docs.select(quoted(id_col).alias("doc"), quoted(text_col).cast("string").alias("t"))
    rows = texts.join(F.broadcast(picked), F.col("doc") == F.col("_id"))  # at most sample_rows rows
    found = materialize(
        rows.select(F.col("_id").cast("long").alias("id"), "label", "t")
        .mapInArrow(lean(_featuriser(bits)), "id long, label int, slots array<int>, vals array<float>")
        .withColumn("draw", F.xxhash64(F.lit(1), "id")), "quality-features")
    found = found.withColumn("shard", F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(shards)))
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for _ in range(epochs):
        state = spark.sparkContext.broadcast((z, n))
        parts = found.groupBy("shard").applyInPandas(
            _epoch(state, bits, alpha, beta, l1, l2), "rows long, z binary, n binary").collect()
        if not parts:
            break
        total = sum(r["rows"] for r in parts)
        z = sum(np.frombuffer(r["z"], np.float32) * (r["rows"] / total) for r in parts)
        n = sum(np.frombuffer(r["n"], np.float32) * (r["rows"] / total) for r in parts)
        state.destroy()
    return _weights(z, n, alpha, beta, l1, l2)


def _scorer(weights, bits: int):
    def run(batches):
        known = _Tokens()
        w = weights.value
        for batch in batches:
            out = []
            for t in batch.column(1).cast(pa.binary()):
                i, v = features(t.as_py(), known, bits)
                out.append(1.0 / (1.0 + np.exp(-np.clip(w[i] @ v + w[-1], -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["id", "score"])
    return run


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, score) of every row; a null or empty text has the score of the bias alone.

    Only the text is an input of the score.  Repeated rows are scored each.
    """
    bits = int(len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32).astype(np.float64))
    return docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("t")).mapInArrow(
        lean(_scorer(shared, bits)), "id long, score double").withColumnRenamed("id", id_col)


def _filter(weights, bits: int, text_at: int, least: float):
    def run(batches):
        known = _Tokens()
        w = weights.value
        for batch in batches:
            keep = []
            for t in batch.column(text_at).cast(pa.binary()):
                i, v = features(t.as_py(), known, bits)
                keep.append(bool(1.0 / (1.0 + np.exp(-np.clip(w[i] @ v + w[-1], -35, 35))) >= least))
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def keep_good(docs: DataFrame, weights: np.ndarray, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, all their columns unchanged, no shuffle."""
    bits = int(len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32).astype(np.float64))
    return docs.mapInArrow(lean(_filter(shared, bits, docs.columns.index(text_col), least)), docs.schema)
