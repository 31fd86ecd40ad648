"""Ids of leased blocks: several writers at once, order, stored ids, restarts."""

import threading

import pytest
from pyspark.sql import functions as F

from fieldbook.operators.id_blocks import IdBlocks, leased_ids


def _threads(work, n):
    out, errors = [None] * n, []

    def run(i):
        try:
            out[i] = work(i)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors, errors
    return out


def test_a_block_has_one_writer(spark, tmp_dir):
    blocks = IdBlocks(spark, tmp_dir + "/ids", 10)
    got = _threads(lambda i: [b for _ in range(10) for b in blocks.lease(25)], 8)
    flat = [b for one in got for b in one]
    assert len(flat) == len(set(flat)) == 8 * 10 * 3
    assert sorted(flat) == blocks.leased()
    assert all(one[i:i + 3] == sorted(one[i:i + 3]) for one in got for i in range(0, 30, 3))


def test_two_inserts_at_once_share_no_id(spark, tmp_dir):
    stored = spark.range(1, 38).withColumnRenamed("id", "old")
    rows = [spark.range(i * 1000, i * 1000 + 1234).select(F.col("id").alias("seq"), F.lit(i).alias("w")) for i in range(3)]

    def insert(i):
        new = leased_ids(rows[i], ["seq"], IdBlocks(spark, tmp_dir + "/ids", 100), stored=stored, stored_id_col="old")
        new.write.parquet(f"{tmp_dir}/out/w={i}")
        return [(r["seq"], r["id"]) for r in spark.read.parquet(f"{tmp_dir}/out/w={i}").orderBy("seq").collect()]

    got = _threads(insert, 3)
    ids = [i for one in got for _, i in one]
    assert len(ids) == len(set(ids)) == 3 * 1234 and min(ids) > 37
    for one in got:
        assert [i for _, i in one] == sorted(i for _, i in one)


def test_ids_stay_when_the_frame_is_read_again(spark, tmp_dir):
    new = leased_ids(spark.range(500).select(F.col("id").alias("seq")), ["seq"], IdBlocks(spark, tmp_dir + "/ids", 64))
    assert sorted(map(tuple, new.collect())) == sorted(map(tuple, new.collect())) == [(i, i + 1) for i in range(500)]
    more = leased_ids(spark.range(5).select(F.col("id").alias("seq")), ["seq"], IdBlocks(spark, tmp_dir + "/ids", 64))
    assert more.agg(F.min("id")).first()[0] == 8 * 64 + 1  # the rest of the last block is a gap


def test_empty_batches_lease_nothing_and_sizes_must_agree(spark, tmp_dir):
    blocks = IdBlocks(spark, tmp_dir + "/ids", 64)
    assert leased_ids(spark.range(0).select(F.col("id").alias("seq")), ["seq"], blocks).count() == 0
    assert blocks.leased() == [] and blocks.lease(0) == []
    with pytest.raises(ValueError, match="other blocks"):
        IdBlocks(spark, tmp_dir + "/ids", 65)
    with pytest.raises(ValueError, match="at least one"):
        IdBlocks(spark, tmp_dir + "/ids2", 0)
    assert blocks.lease(1, above=64) == [1] and blocks.lease(1, above=64 * 5 + 1) == [6]
