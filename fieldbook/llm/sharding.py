"""Sharding by jump consistent hashing, in DataFrame functions only.

Lamping and Veach's jump hash gives a key a shard from the key and the shard
count alone, without a ring table.  One more shard takes rows only into
itself, about 1/(n+1) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import quoted, without
from fieldbook.operators.ids import dense_ids
from fieldbook.session import materialize

_MULTIPLIER = 2862933555777941757  # fixed value of the jump hash
_M32 = 0xFFFFFFFF


def _next_key(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 modulo 2^64, on 32-bit halves.

    The multiplier is cut into four 16-bit limbs, so no product or sum leaves
    53 bits and nothing overflows under ANSI arithmetic.
    """
    b = [F.lit((_MULTIPLIER >> s) & 0xFFFF).cast("long") for s in (0, 16, 32, 48)]
    m32, m16 = F.lit(_M32).cast("long"), F.lit(0xFFFF).cast("long")
    p1 = lo * b[1]
    low = lo * b[0] + F.shiftleft(p1.bitwiseAND(m32), 16) + F.lit(1).cast("long")
    high = (F.shiftright(low, 32)
            + F.shiftleft(F.shiftright(p1, 32), 16)
            + (lo * b[2]).bitwiseAND(m32)
            + F.shiftleft((lo * b[3]).bitwiseAND(m16), 16)
            + (hi * b[0]).bitwiseAND(m32)
            + F.shiftleft((hi * b[1]).bitwiseAND(m16), 16))
    return high.bitwiseAND(m32), low.bitwiseAND(m32)


def jump_state(key: Column, shards: int) -> Column:
    """struct(b, j) at the end of the jump loop for ``shards`` buckets.

    ``b`` is the shard; ``j`` the next jump, so with one shard more the shard
    is ``shards`` when ``j = shards`` and ``b`` otherwise.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    zero = F.lit(0).cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_M32).cast("long")).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), zero.alias("j"))

    def step(acc, _):
        hi, lo = _next_key(acc["hi"], acc["lo"])
        jump = F.floor((acc["j"] + F.lit(1).cast("long")).cast("double")
                       * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + F.lit(1).cast("long")).cast("double")))
        return F.when(acc["j"] >= F.lit(shards).cast("long"), acc).otherwise(
            F.struct(hi.alias("hi"), lo.alias("lo"), acc["j"].alias("b"), jump.cast("long").alias("j")))

    # every step raises j by one at least, so ``shards`` steps always end the loop
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


def shard_rows(docs: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard 0..shards-1 by its key and number the rows of each shard.

    Adds ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``law``
    ('key'), ``shard``, ``slot`` (0, 1, ... in every shard, in key order) and
    ``grown_shard`` (the shard with one shard more).  Only the key and these
    columns are kept: texts are never moved.  An integer key is used as it
    is, any other through xxhash64; a null key counts as key 0.  A null text
    has size 8 and the checksum of no bytes.  Rows that are equal in key,
    size and checksum get slots in any order.  Slots are drawn over ranges of
    (shard, key), so a shard of any size is numbered in parallel.
    """
    c = quoted(key_col)
    whole = dict(docs.dtypes)[key_col] in ("tinyint", "smallint", "int", "bigint")
    key = F.coalesce(c.cast("long") if whole else F.when(c.isNotNull(), F.xxhash64(c)), F.lit(0).cast("long"))
    text = quoted(text_col)
    rows = docs.select(
        c.alias("_key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).cast("long").alias("text_crc32"),
        jump_state(key, shards).alias("_jump"),
    ).select(
        "_key", "size", "text_crc32", F.lit("key").alias("law"),
        F.col("_jump.b").cast("int").alias("shard"),
        F.when(F.col("_jump.j") == F.lit(shards), F.lit(shards)).otherwise(F.col("_jump.b")).cast("int")
        .alias("grown_shard"),
    )
    rows = materialize(rows, "shard-rows")  # narrow; the range sampling reads this, not the texts again
    slots = dense_ids(rows, ["_key", "size", "text_crc32"], id_col="slot", start=0, partition_by=["shard"])
    return slots.select(F.col("_key").alias(key_col), "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def with_shard(df: DataFrame, shards: int, key_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """The whole rows with their shard, without moving any (a column named ``name`` is replaced)."""
    c = quoted(key_col)
    whole = dict(df.dtypes)[key_col] in ("tinyint", "smallint", "int", "bigint")
    key = F.coalesce(c.cast("long") if whole else F.when(c.isNotNull(), F.xxhash64(c)), F.lit(0).cast("long"))
    return df.select(*[quoted(x) for x in without(df, [name])], jump_state(key, shards)["b"].cast("int").alias(name))
