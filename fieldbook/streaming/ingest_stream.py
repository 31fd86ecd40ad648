"""Drop-folder stream into the strain table.

``spark.readStream`` picks up JSON files dropped into a folder; every
micro-batch goes through the batch operators (``ingest.insert_new`` or
``ingest.upsert``) inside ``foreachBatch``.

Exactly-once without a transactional table format:

* insert mode writes the micro-batch's new rows into a folder named after
  (query id, batch id) with ``overwrite``; which keys are new is told by
  ``KeyState``, the same for a replayed batch, so that writes its rows
  again instead of adding them twice.  Its highest id is written before its
  rows, so a crash between the two leaves a gap in the ids, never a second
  use of one;
* upsert mode writes a new snapshot version holding a marker of the
  (query id, batch id) it applied, so data and marker commit together; a
  replay of an applied batch is skipped.

The query id survives restarts with the same checkpoint, while batch ids
restart at 0 with a fresh checkpoint; keying on both keeps a fresh
checkpoint from being mistaken for a replay.  Batch order inside a
micro-batch is (file name, position in the file).  Dropped files are JSON
lines (splittable), read as field maps, so a JSON null and a missing field
stay apart.  A line that is no JSON object, or in insert mode holds a value
that does not fit its column, goes to ``rejects/`` with its file.
"""

from __future__ import annotations

import datetime as _dt
import json
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators import ingest
from fieldbook.operators.ids import read_order
from fieldbook.session import materialize
from fieldbook.sources import io
from fieldbook.streaming.key_state import KeyState

MARKER = "_applied"


def _read_marker(spark: SparkSession, data: str) -> dict:
    """(query, batch) applied by the current snapshot of an upsert-mode table."""
    cur = io.current_version(spark, data)
    txt = io.read_text_file(spark, f"{cur}/{MARKER}") if cur else None
    return json.loads(txt) if txt else {}


def with_batch_order(batch: DataFrame, seq: str = "seq", max_files: int = 100) -> DataFrame:
    """Number a micro-batch 1..n in read order (file, split start, row in split)."""
    return read_order(batch, seq, max_files=max_files)


def read_drops(spark: SparkSession, src_dir: str, max_files: int = 100) -> DataFrame:
    """Stream of the lines of files dropped anywhere under ``src_dir``: (_file, _start, record, fields)."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").text(src_dir)
    return lines.where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.col("value").alias("record"), io.parse_object(F.col("value")).alias("fields"))


def _folders(spark: SparkSession, data: str) -> list[str]:
    return [n[len("batch="):] for n in io.list_names(spark, data) if n.startswith("batch=")]


def _rows_of(spark: SparkSession, data: str, folders: list[str]) -> DataFrame:
    """Rows of the named batch folders; the others are not opened."""
    return io.read_table(spark, data).where(F.col("batch").isin(folders))


def _seed_ids(spark: SparkSession, data: str, ids: str, id_col: str) -> None:
    """Record the highest id of rows whose folder has no entry in ``ids/`` (a table loaded by other means)."""
    seen = set(_folders(spark, ids))
    foreign = [f for f in _folders(spark, data) if f not in seen]
    for_state = [f for f in foreign if io.read_text_file(spark, f"{ids}/_seeded/{f}") is None]
    if for_state or "seed" not in seen:
        rows = _rows_of(spark, data, foreign) if foreign else io.read_table(spark, data).limit(0)
        rows = materialize(rows.agg(F.max(id_col).alias(id_col)), "stream-seed")
        rows.write.mode("overwrite").parquet(f"{ids}/batch=seed")
        for f in for_state:
            io.write_text_file(spark, f"{ids}/_seeded/{f}", "done")


def _typed_lines(lines: DataFrame, payload: T.StructType) -> DataFrame:
    """(seq, file_path, record, _ok, _values): numbered lines parsed; ``record`` only where the line is a reject."""
    parsed = lines.select("seq", "file_path", "record", io.parse_object(F.col("record")).alias("fields"))
    fields = F.col("fields")
    ok = fields.isNotNull() & F.coalesce(io.fields_fit(fields, payload), F.lit(False))
    values = F.struct(*[io.typed_field(fields, f.name, f.dataType).alias(f.name) for f in payload.fields])
    return parsed.select("seq", "file_path", F.when(~ok, F.col("record")).alias("record"), ok.alias("_ok"),
                         values.alias("_values"))


def start_ingest(spark: SparkSession, src_dir: str, table: str, checkpoint: str, keys: list[str],
                 schema: T.StructType, mode: str = "insert", id_col: str = "id",
                 run_ts=None, min_age: str | None = ingest.DEFAULT_MIN_AGE,
                 available_now: bool = True, max_files: int = 100):
    """Start the stream; returns the ``StreamingQuery``.

    ``schema`` is the stored table's schema (id, payload, audit columns).
    insert mode: dropped rows (payload fields) get G3 treatment plus ids.
    The table is a folder of ``batch=<tag>`` folders.  The stored keys live in
    the state store of a second query beside the checkpoint (``KeyState``), so
    a micro-batch does not read the table.  Each micro-batch writes
    its highest id to a one-row ``ids/`` folder, which is read instead of
    the id column; rows that came by other means are seen once, at start.
    upsert mode: dropped maps get G4 treatment (updates by id, inserts) and
    each micro-batch writes a new snapshot of the whole table.
    Rows are stamped with ``run_ts`` or the Asia/Kolkata wall clock of the
    batch's first run, which a replay takes again.
    """
    if mode not in ("insert", "upsert"):
        raise ValueError("mode must be 'insert' or 'upsert'")
    root = table.rstrip("/")
    data, ids_dir = f"{root}/data", f"{root}/ids"
    if not io._exists(spark, data):
        empty = spark.createDataFrame([], schema)
        if mode == "insert":
            empty.write.mode("overwrite").parquet(f"{data}/batch=init")
        else:
            io.write_snapshot(empty, data)
    if mode == "insert":
        _seed_ids(spark, data, ids_dir, id_col)
        state = KeyState(spark, checkpoint, schema, keys)
        fresh = state.unseen(_folders(spark, data))
        if fresh:
            state.seed(_rows_of(spark, data, fresh), fresh)
        state.start()
    payload = T.StructType([f for f in schema.fields
                            if f.name not in (id_col, "created_date", "last_updated_timestamp")])

    def stamp_time(s: SparkSession, tag: str) -> str:
        if run_ts:
            return run_ts
        path = f"{root}/stamps/{tag}"
        if io.read_text_file(s, path) is None:
            now = _dt.datetime.now(ZoneInfo(ingest.DEFAULT_ZONE)).strftime("%Y-%m-%d %H:%M:%S")
            io.write_text_file(s, path, now)
        return io.read_text_file(s, path)

    def apply(batch_df: DataFrame, batch_id: int) -> None:
        s = batch_df.sparkSession
        qid = s.sparkContext.getLocalProperty("sql.streaming.queryId")
        tag = f"q{qid}-b{batch_id}"
        marker = _read_marker(s, data) if mode == "upsert" else {}
        if marker.get("query") == qid and int(marker.get("batch", -1)) >= batch_id:
            return  # replay of an applied batch
        now = stamp_time(s, tag)
        # insert mode numbers the bare lines: what is parsed before would be parsed again for the ranges of the numbers
        read = batch_df.drop("fields") if mode == "insert" else batch_df
        lines = with_batch_order(read.withColumn("file_path", F.col("_file")), max_files=max_files)
        if mode == "insert":
            lines = materialize(_typed_lines(lines, payload), "stream-rows")  # parsed once for all that follows
        else:
            lines = lines.withColumn("_ok", F.col("fields").isNotNull())
        lines.where(~F.col("_ok")).select("seq", "file_path", "record").write.mode("overwrite") \
            .parquet(f"{root}/rejects/batch={tag}")
        if mode == "insert":
            rows = lines.where("_ok").select("seq", "_values.*")
            stored = state.known(rows, tag, batch_id)
            id_source = io.read_table(s, ids_dir).where(F.col("batch") != tag).select(id_col)
            new, outcomes = ingest.insert_new(rows, stored, keys, "seq", now, with_ids=True,
                                              id_col=id_col, id_source=id_source, written=True)
            outcomes.select("seq", "outcome", *keys).write.mode("overwrite").parquet(f"{root}/outcomes/batch={tag}")
            # the numbered rows lie written, so both reads give the same ids
            new.agg(F.max(id_col).alias(id_col)).write.mode("overwrite").parquet(f"{ids_dir}/batch={tag}")
            new.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{data}/batch={tag}")
        else:
            good = lines.where("_ok").select("seq", "fields")
            tbl, outcomes = ingest.upsert(read_ingested(s, table), good, keys, now, id_col=id_col, min_age=min_age)
            outcomes.write.mode("overwrite").parquet(f"{root}/outcomes/batch={tag}")
            # the marker lands inside the new version before it is committed
            io.write_snapshot(tbl.select(*schema.fieldNames()), data,
                              extra_files={MARKER: json.dumps({"query": qid, "batch": batch_id})})

    writer = read_drops(spark, src_dir, max_files).writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    if mode == "upsert":
        return writer.start()
    try:
        query = writer.start()
    except Exception:
        state.query.stop()
        raise
    state.stop_after(query)
    return query


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """The stream's target table (current snapshot or all appended batches)."""
    path = f"{table.rstrip('/')}/data"
    df = io.read_table(spark, path)
    return df.drop("batch")
