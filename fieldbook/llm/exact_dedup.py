"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Texts stay where they are; what travels first is one short fingerprint per
document.  Every block of rows sorts its distinct fingerprints, cuts them at
the owners' ranges and sends each owner the Golomb-coded differences.  An
owner decodes what it got, finds the fingerprints that came from more than
one block and answers each block with a bitmap.  Rows whose fingerprint is
marked (or occurs twice in their own block) are suspects; only their texts
are shuffled, and compared byte by byte.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import packed
from fieldbook.session import materialize, scratch_path

BLOCK_BITS = 15  # rows of a block: 2^15 at most


def golomb_encode(sorted_values: np.ndarray, base: int, span: int) -> tuple[int, bytes]:
    """Golomb-Rice code of the gaps of sorted distinct values in [base, base+span).

    The parameter is the power of two next to ln 2 times the mean gap.  All
    quotients come first in unary, then all remainders with k bits each.
    """
    n = len(sorted_values)
    gaps = np.diff(sorted_values.astype(np.int64), prepend=np.int64(base - 1)) - 1
    k = max(0, int(np.floor(np.log2(max(1.0, 0.69 * span / n)))))
    q = gaps >> k
    ends = np.cumsum(q + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = gaps & ((1 << k) - 1)
    bits = ((rest[:, None] >> np.arange(k - 1, -1, -1)) & 1).astype(np.uint8).ravel() if k else np.empty(0, np.uint8)
    return k, np.packbits(np.concatenate([unary, bits])).tobytes()


def golomb_decode(n: int, k: int, base: int, data: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    ends = np.flatnonzero(bits)[:n]
    q = np.diff(ends, prepend=-1) - 1
    gaps = q.astype(np.int64) << k
    if k:
        at = int(ends[-1]) + 1
        rest = bits[at:at + n * k].reshape(n, k).astype(np.int64)
        gaps += rest @ (np.int64(1) << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps + 1) + (base - 1)


def _ranges(owners: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // owners for i in range(owners + 1)], np.int64)


def _encoder(owners: int, bits: int):
    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        cuts = _ranges(owners, bits)
        fps = np.unique(pdf["fp"].to_numpy(np.int64))
        at = np.searchsorted(fps, cuts)
        out = []
        for o in np.flatnonzero(np.diff(at)):
            part = fps[at[o]:at[o + 1]]
            k, data = golomb_encode(part, int(cuts[o]), int(cuts[o + 1] - cuts[o]))
            out.append((int(pdf["blk"].iloc[0]), int(o), len(part), k, data))
        return pd.DataFrame(out, columns=["blk", "owner", "n", "k", "data"])
    return encode


def _owner(owners: int, bits: int):
    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        base = int(_ranges(owners, bits)[int(pdf["owner"].iloc[0])])
        got = [golomb_decode(n, k, base, d) for n, k, d in zip(pdf["n"], pdf["k"], pdf["data"])]
        values, counts = np.unique(np.concatenate(got), return_counts=True)
        twice = values[counts > 1]
        marks = [np.packbits(np.isin(g, twice, assume_unique=True)).tobytes() for g in got]
        return pd.DataFrame({"blk": pdf["blk"], "owner": pdf["owner"], "bits": marks})
    return find


def _marker(owners: int, bits: int):
    def mark(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        fp = rows["fp"].to_numpy(np.int64)
        fps, where, counts = np.unique(fp, return_inverse=True, return_counts=True)
        at = np.searchsorted(fps, _ranges(owners, bits))
        dup = counts > 1
        for o, data in zip(replies["owner"], replies["bits"]):
            part = slice(at[o], at[o + 1])
            dup[part] |= np.unpackbits(np.frombuffer(data, np.uint8))[:at[o + 1] - at[o]].astype(bool)
        order = rows["ord"].to_numpy()
        flags = np.zeros(int(order.max()) + 1, bool)
        flags[order] = dup[where]
        return pd.DataFrame({"blk": [int(rows["blk"].iloc[0])], "marks": [np.packbits(flags).tobytes()]})
    return mark


def _staged(docs: DataFrame, text_col: str, id_col: str, bits: int) -> DataFrame:
    """The rows with digest, fingerprint, block and place, written bucketed by block.

    The write fixes which row belongs to which block.  Reading by bucket
    brings the blocks' bitmaps to the rows without moving a text.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    rows = packed(docs).select(
        "row", F.sha2(text, 256).alias("sha"), F.monotonically_increasing_id().alias("mid")
    ).select(
        "row", "sha", "mid",
        F.conv(F.substring("sha", 1, bits // 4), 16, 10).cast("long").alias("fp"),
        F.shiftright("mid", BLOCK_BITS).alias("blk"),
        F.col("mid").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")).cast("int").alias("ord"),
    )
    name = f"fb_dedup_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    (rows.write.format("parquet").bucketBy(buckets, "blk")
     .option("path", scratch_path(spark, f"fieldbook-tables/{name}")).saveAsTable(name))
    return spark.table(name)


def _marked(staged: DataFrame, bits: int, owner_rows: int) -> DataFrame:
    """One row per block: the bitmap of its suspect rows, by place in the block."""
    spark = staged.sparkSession
    rows = staged.count()
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // owner_rows))
    narrow = staged.select("blk", "ord", "fp")
    sent = narrow.groupBy("blk").applyInPandas(
        _encoder(owners, bits), "blk long, owner int, n int, k int, data binary")
    replies = sent.groupBy("owner").applyInPandas(_owner(owners, bits), "blk long, owner int, bits binary")
    marks = narrow.groupBy("blk").cogroup(replies.groupBy("blk")).applyInPandas(
        _marker(owners, bits), "blk long, marks binary")
    return materialize(marks, "dedup-marks")


def _exchange(docs: DataFrame, text_col: str, id_col: str, bits: int, owner_rows: int):
    if bits % 4 or not 8 <= bits <= 60:
        raise ValueError("fingerprint bits: a multiple of 4 from 8 to 60")
    staged = _staged(docs, text_col, id_col, bits)
    marks = _marked(staged, bits, owner_rows)
    byte = F.conv(F.hex(F.expr("substring(marks, cast(ord div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, 7 - pmod(ord, 8)) & 1")
    rows = (staged.join(marks.hint("shuffle_hash"), "blk")
            .withColumn("_byte", byte).withColumn("dup", bit == F.lit(1)).drop("_byte", "marks"))
    ident = F.col("row").getField(id_col)
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    # byte verification: grouping by the text itself; each task sends one row per text it holds
    texts = (rows.filter("dup").select("sha", text.alias("t"), "mid", ident.alias("id"))
             .groupBy("sha", "t").agg(
                 F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                 F.max_by("mid", F.coalesce(F.col("id"), F.lit(-(1 << 63)))).alias("keep_mid")))
    groups = (texts.groupBy("sha").agg(
        F.count(F.lit(1)).alias("n"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"),
        F.max("keep_mid").alias("keep_mid"))
        .withColumn("keep_mid", F.when(F.col("n") == 1, F.col("keep_mid")).otherwise(
            F.raise_error(F.lit("two different texts have one SHA-256")).cast("long"))))
    return rows, groups


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", fingerprint_bits: int = 48,
                owner_rows: int = 1 << 20) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    Equal are texts identical in their bytes; a null text counts as empty.
    Of equal texts the row with the largest id stays (null ids are smallest);
    of repeated rows with that id exactly one stays.  An empty table gives no
    rows; other columns are not looked at.

    ``owner_rows`` bounds the fingerprints an owner gets from distinct
    documents (a hot text adds one per block at most), ``fingerprint_bits``
    sets how many texts become suspects by chance: all suspects are compared
    by their bytes, so it never changes a result.
    """
    rows, groups = _exchange(docs, text_col, id_col, fingerprint_bits, owner_rows)
    ident = F.col("row").getField(id_col).alias("id")
    alone = rows.filter(~F.col("dup")).select(
        ident, ident.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    # a hot text sends one row per block into the join, not one per copy
    members = (rows.filter("dup").select("blk", "sha", F.struct("mid", ident).alias("m"))
               .groupBy("blk", "sha").agg(F.collect_list("m").alias("ms")))
    again = (members.join(groups, "sha")
             .select("sha", "keep_id", "group_size", "keep_mid", F.explode("ms").alias("m"))
             .select(F.col("m.id").alias("id"), "keep_id", "group_size",
                     (F.col("m.mid") == F.col("keep_mid")).alias("kept"), "sha"))
    return alone.unionByName(again).select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long"), "kept",
        F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", fingerprint_bits: int = 48,
                      owner_rows: int = 1 << 20) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (see ``exact_dedup``)."""
    rows, groups = _exchange(docs, text_col, id_col, fingerprint_bits, owner_rows)
    first = rows.filter("dup").join(groups.select(F.col("keep_mid").alias("mid")), "mid", "left_semi")
    kept = rows.filter(~F.col("dup")).select("row").unionByName(first.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
