"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_CLASS = r"[^\x20\x09-\x0D]+"
_SLICE = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table whose only readers have been written themselves."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def lean(run):
    """A mapInArrow function whose worker hands freed memory back to the system at the end of each task.

    Spark keeps Python workers between tasks; what their allocators hold on to would add up.
    """
    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)
    return task


def quoted(name: str) -> Column:
    """Column of that exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, new: list[str]) -> list[str]:
    """Input columns whose names do not clash (ignoring case) with ``new``."""
    taken = {c.lower() for c in new}
    return [c for c in df.columns if c.lower() not in taken]


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """The whole row as one struct, so no input column can clash with ours.

    Columns of the void type, which files cannot hold, become strings.
    """
    fields = [quoted(c).cast("string").alias(c) if t == "void" else quoted(c) for c, t in df.dtypes]
    return df.select(F.struct(*fields).alias(name))


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased, in order.

    ``bytes.split()`` cuts exactly at 0x20 and 0x09-0x0D, ``bytes.lower()``
    changes only A-Z.  Long texts go through in slices that end at white
    space, so only 8 bytes a word stay in memory.
    """
    h = xxhash.xxh3_64_intdigest
    if len(text) <= _SLICE:
        words = text.lower().split()
        return np.fromiter(map(h, words), np.uint64, len(words))
    parts, at, n = [], 0, len(text)
    while at < n:
        end = min(n, at + _SLICE)
        while end < n and text[end] not in b" \t\n\x0b\x0c\r":
            nxt = min((p for p in (text.find(bytes([c]), end, end + _SLICE) for c in b" \t\n\x0b\x0c\r") if p >= 0),
                      default=min(n, end + _SLICE))
            end = nxt
        words = text[at:end].lower().split()
        parts.append(np.fromiter(map(h, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Fewer words than ``width``: the whole sequence is one shingle.  No words:
    an empty set.
    """
    w = word_hashes(text) if text else np.empty(0, np.uint64)
    n = len(w)
    if n == 0:
        return w
    k = min(width, n)
    s = np.full(n - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        s = splitmix(s * _MUL + w[j:n - k + 1 + j])
    return np.unique(s)
