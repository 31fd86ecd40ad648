"""Stored keys dealt once into buckets, so that batch after batch meets them where they lie.

An existence check against a stored table shuffles that table's keys for
every batch.  A key table holds the distinct keys, one row each, bucketed by
the key on the shared file system.  A batch's own distinct keys are brought
to the same buckets and joined bucket by bucket; the stored side is scanned
but neither exchanged nor rehashed.  A key that holds a third of a batch or
of the stored rows is one row on either side before anything moves.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators.ingest import DUPLICATE, EXISTS, INSERTED, stamp
from fieldbook.operators.ids import continue_ids
from fieldbook.session import materialize
from fieldbook.sources import io

_KEY = "_key"
_SHAPE = "shape.json"


def _cell(df: DataFrame, name: str) -> Column:
    """A value as text that differs where the values differ: length and text, 'n' for NULL."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # the two zeros are equal
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)  # its text is ambiguous where clocks are put back
    elif isinstance(kind, T.BinaryType):
        c = F.hex(c)
    elif not isinstance(kind, T.AtomicType):
        raise ValueError(f"{name}: keys are plain values, not {kind.simpleString()}")
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


class KeyTable:
    """The dealt keys under ``path``: made by ``deal_keys``, found again by ``open_keys``, in any session."""

    def __init__(self, spark: SparkSession, path: str, types: dict[str, str], buckets: int):
        self.spark, self.path, self.types, self.buckets = spark, path.rstrip("/"), types, buckets
        self.name = "fb_keys_" + hashlib.md5(self.path.encode()).hexdigest()

    @property
    def keys(self) -> list[str]:
        return list(self.types)

    def _key_of(self, df: DataFrame) -> Column:
        for k, kind in self.types.items():
            if df.schema[k].dataType.simpleString() != kind:
                raise ValueError(f"{k} is {df.schema[k].dataType.simpleString()}, its dealt keys are {kind}: cast it first")
        return F.concat(*[_cell(df, k) for k in self.types])

    def rows(self) -> DataFrame:
        """The dealt keys as they are now, one column of texts, bucketed."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_KEY} STRING) USING parquet "
            f"CLUSTERED BY ({_KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/keys'")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _found(self) -> DataFrame:
        # joined by outer joins: a semi or anti join would be pushed below the repartition that fits the buckets
        return self.rows().select(_KEY, F.lit(True).alias("_exists"))

    def _in_buckets(self, keys: DataFrame) -> DataFrame:
        # distinct first, so that a hot key is one row per task before it is shuffled
        return keys.distinct().repartition(self.buckets, _KEY)

    def add(self, rows: DataFrame) -> None:
        """Deal the keys of further stored rows; those already here are left out, so a replay adds nothing.

        Each call adds at most one file to a bucket; after very many of them deal the keys anew.
        """
        dealt = self._in_buckets(rows.select(self._key_of(rows).alias(_KEY)))
        new = dealt.join(self._found(), _KEY, "left").where(F.col("_exists").isNull()).select(_KEY)
        # written before the table grows: the plan reads the table that it appends to
        materialize(new, "new-keys").repartition(self.buckets, _KEY).write.format("parquet").bucketBy(
            self.buckets, _KEY).mode("append").saveAsTable(self.name)

    def classify(self, batch: DataFrame, seq: str, null_safe: bool = False, dedupe: bool = True,
                 outcome: str = "outcome") -> DataFrame:
        """G3 against the dealt keys: the outcomes of ``ingest.classify_new``, with the stored side left in place.

        NULL in a key never matches a stored key unless ``null_safe``; inside the batch NULL equals NULL.  Key columns
        must have the types of the dealt keys.
        """
        keyed = batch.withColumn(_KEY, self._key_of(batch))
        open_key = F.lit(False)
        if not null_safe:
            for k in self.types:
                open_key = open_key | F.col(f"`{k}`").isNull()
        firsts = keyed.groupBy(_KEY).agg(F.min(seq).alias("_first_seq"), F.max(open_key).alias("_open"))
        firsts = firsts.repartition(self.buckets, _KEY)
        # grouped once more, in place: two writers may have dealt one key
        judged = firsts.join(self._found(), _KEY, "left").groupBy(_KEY).agg(
            F.min("_first_seq").alias("_first_seq"),
            F.max(F.coalesce("_exists", F.lit(False)) & ~F.col("_open")).alias("_exists"))
        later = (F.col(seq) != F.col("_first_seq")) if dedupe else F.lit(False)
        return keyed.join(judged, _KEY).withColumn(
            outcome, F.when(later, F.lit(DUPLICATE)).when(F.col("_exists"), F.lit(EXISTS)).otherwise(F.lit(INSERTED))
        ).drop(_KEY, "_first_seq", "_exists")


def deal_keys(stored: DataFrame, keys: list[str], path: str, buckets: int | None = None) -> KeyTable:
    """Write the distinct ``keys`` of a stored table as a key table under a fresh ``path``.

    ``buckets`` (default: the session's shuffle partitions) is fixed for the table's life: take as many as give files
    of some hundred megabytes at the size the table will grow to.
    """
    spark = stored.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if io.list_names(spark, path):
        raise ValueError(f"{path} is not empty")
    table = KeyTable(spark, path, {k: stored.schema[k].dataType.simpleString() for k in keys}, n)
    rows = table._in_buckets(stored.select(table._key_of(stored).alias(_KEY)))
    rows.write.format("parquet").bucketBy(n, _KEY).option("path", f"{table.path}/keys").saveAsTable(table.name)
    io.write_text_file(spark, f"{table.path}/{_SHAPE}", json.dumps({"types": table.types, "buckets": n}))
    return table


def open_keys(spark: SparkSession, path: str) -> KeyTable:
    """The key table that ``deal_keys`` wrote at ``path``."""
    shape = io.read_text_file(spark, f"{path.rstrip('/')}/{_SHAPE}")
    if shape is None:
        raise ValueError(f"no finished key table at {path}")
    shape = json.loads(shape)
    return KeyTable(spark, path, shape["types"], shape["buckets"])


def insert_new_dealt(batch: DataFrame, table: KeyTable, seq: str, run_ts, null_safe: bool = False,
                     id_source: DataFrame | None = None, id_col: str = "id"):
    """G3 on dealt keys: (rows to append, outcome per batch row), as ``ingest.insert_new``.

    The outcomes are written once, so they do not change when the keys of the new rows are dealt.  Append the rows
    first and call ``table.add(rows)`` then: a crash in between leaves rows whose keys are unknown, which ``add`` mends
    when it is called again; keys dealt first would hide rows that were never written.  ``id_source`` is the table
    whose ids the new rows continue.
    """
    labelled = materialize(table.classify(batch, seq, null_safe), "dealt-outcomes")
    new = labelled.where(F.col("outcome") == INSERTED).drop("outcome")
    if id_source is not None:
        new = continue_ids(new, [seq], id_source, id_col=id_col)
    return stamp(new, run_ts), labelled
