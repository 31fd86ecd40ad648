"""Which micro-batch first brought a key, kept in Spark's state store.

The keys of a micro-batch are dropped into a folder that a second, stateful
query reads: ``groupBy(keys)`` in update mode, whose state (RocksDB, with
changelog checkpoints) holds one row per key with the first and the last
turn that brought it.  A key whose first turn is the last one is new.  A
micro-batch thus costs what its own keys cost, however many are stored; the
stored table is read once, when a checkpoint is fresh.

Turns are the batch ids of the ingest query, stored rows have turn -1.  A
key dropped twice by a replay has the same turn both times, so replays of
either query give the verdicts they gave before.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.sources import io

SEEDED = -1
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class KeyState:
    """Keys seen by an ingest query with the given checkpoint; everything lies beside that checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str, schema: T.StructType, keys: list[str]):
        self.root = checkpoint.rstrip("/") + "-keys"
        self.keys = list(keys)
        self.schema = T.StructType([T.StructField(k, schema[k].dataType) for k in keys] + [T.StructField("_turn", T.LongType())])
        self.session = spark.newSession()  # the settings of the state are not the caller's
        self.session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
        for name, value in STATE_SETTINGS.items():
            self.session.conf.set(name, value)
        self.query = None

    def _drop(self, rows: DataFrame, name: str, turn: int) -> None:
        """Give rows' keys to the state, once; a NULL key equals no other and is not kept."""
        done = f"{self.root}/given/{name}"
        if io.read_text_file(self.session, done) is None:
            # appended: files of a broken attempt may be in the state query's log already, and repeats change nothing
            rows.select(*self.keys).dropna().distinct().withColumn("_turn", F.lit(turn).cast("long")) \
                .write.mode("append").parquet(f"{self.root}/drops")
            io.write_text_file(self.session, done, "done")

    def unseen(self, folders: list[str]) -> list[str]:
        """Those of the folders whose rows the state was not given."""
        given = set(io.list_names(self.session, f"{self.root}/given"))
        return [f for f in folders if f not in given]

    def seed(self, rows: DataFrame, folders: list[str]) -> None:
        """Give the keys of stored folders, all in one write."""
        self._drop(rows, "seed-" + folders[0], SEEDED)
        for name in folders:
            io.write_text_file(self.session, f"{self.root}/given/{name}", "done")

    def start(self) -> None:
        """Start the state query; it runs until ``stop``."""
        io.ensure_table(self.session, f"{self.root}/drops", self.schema)
        news = f"{self.root}/news"

        def write_news(df: DataFrame, _batch_id: int) -> None:
            df.where((F.col("_first") == F.col("_last")) & (F.col("_first") > SEEDED)).drop("_last") \
                .withColumnRenamed("_first", "_turn").write.mode("append").partitionBy("_turn").parquet(news)

        self.query = (
            self.session.readStream.schema(self.schema).option("cleanSource", "delete").parquet(f"{self.root}/drops")
            .groupBy(*self.keys).agg(F.min("_turn").alias("_first"), F.max("_turn").alias("_last"))
            .writeStream.outputMode("update").foreachBatch(write_news)
            .option("checkpointLocation", f"{self.root}/checkpoint").trigger(processingTime="200 milliseconds").start())

    def known(self, rows: DataFrame, name: str, turn: int) -> DataFrame:
        """Keys of ``rows`` that were there before this turn."""
        self._drop(rows, name, turn)
        self.query.processAllAvailable()
        spark = rows.sparkSession
        found = rows.select(*self.keys).dropna().distinct()
        path = f"{self.root}/news/_turn={turn}"
        if not io._exists(spark, path):
            return found
        new = spark.read.schema(T.StructType(self.schema.fields[:-1])).parquet(path)
        return found.join(new, self.keys, "left_anti")

    def stop_after(self, query) -> None:
        """Stop the state query when the ingest query ends."""
        def wait():
            try:
                query.awaitTermination()
            except Exception:  # noqa: BLE001  # the caller sees it on the query itself
                pass
            finally:
                self.query.stop()
        threading.Thread(target=wait, daemon=True).start()
