"""Observation ETL: wide sheets -> long observations with a date range and a run log.

All files are one DataFrame with a ``file_path`` column; per-file decisions
(missing id column, no dates, bad date, non-numeric measure) are aggregates
keyed by ``file_path`` joined back, never a loop over files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.columns import unit_for
from fieldbook.functions.dates import date_tokens, parse_dmy
from fieldbook.schemas import OBSERVATION, RUN_LOG
from fieldbook.session import materialize
from fieldbook.sources import io

# Sheet column renames and the id columns of the long table.
RENAMES = {"productid": "product_id", "product": "product_name", "pest": "pest_name"}
ID_COLUMNS = ["product_id", "product_name", "pest_name"]

# Run-log messages.
MSG_NO_ID = "Missing 'productid' column"
MSG_NO_DATES = "No dates found"
MSG_BAD_DATE = "Invalid date"
MSG_BAD_VALUE = "Non-numeric observation value"
MSG_BAD_ID = "Non-integer product id"
MSG_NO_PRODUCT = "Missing 'product' column"
MSG_UNREADABLE = "Unreadable file"


def rename_sheet(wide: DataFrame) -> DataFrame:
    """B1: productid/product/pest -> product_id/product_name/pest_name (absent names ignored)."""
    return wide.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in wide.columns})


def unpivot_observations(wide: DataFrame, units: dict[str, str] | None = None,
                         keep: list[str] | None = None) -> DataFrame:
    """C2 + C3: every non-id column becomes (observation_name, observation_value, unit).

    NULL values are kept.  Values are cast to double with ``try_cast``; the
    text is kept in ``observation_text`` so callers can reject a file whose
    non-NULL text is not a number.  ``keep`` columns (e.g. file_path) ride along.
    """
    w = rename_sheet(wide)
    keep = [c for c in (keep or []) if c in w.columns]
    if "pest_name" not in w.columns:
        w = w.withColumn("pest_name", F.lit(None).cast("string"))
    if "product_id" not in w.columns:
        w = w.withColumn("product_id", F.lit(None).cast("long"))
    if "product_name" not in w.columns:
        w = w.withColumn("product_name", F.lit(None).cast("string"))
    measures = [c for c in w.columns if c not in ID_COLUMNS and c not in keep]
    ids = [integer_id("product_id").alias("product_id"),
           F.col("product_name").cast("string").alias("product_name"),
           F.col("pest_name").cast("string").alias("pest_name")]
    if not measures:
        empty = w.select(*ids, *keep).where(F.lit(False))
        return empty.select("*", F.lit(None).cast("string").alias("observation_name"),
                            F.lit(None).cast("double").alias("observation_value"),
                            F.lit(None).cast("string").alias("observation_text"),
                            F.lit(None).cast("string").alias("observation_unit"))
    texts = w.select(*ids, *keep, *[F.col(m).cast("string").alias(m) for m in measures])
    long = texts.unpivot(["product_id", "product_name", "pest_name", *keep], measures,
                         "observation_name", "observation_text")
    return long.select(
        "product_id", "product_name", "pest_name", *keep, "observation_name",
        F.col("observation_text").try_cast("double").alias("observation_value"),
        "observation_text",
        unit_for("observation_name", units).alias("observation_unit"),
    )


def file_dates(data_sheet: DataFrame, file_col: str = "file_path") -> DataFrame:
    """Per file: min and max ``dd.mm.yyyy`` date found in any string cell (E5).

    Returns (file_col, date_created, date_expired, n_dates, n_bad_dates); an
    impossible date such as 31.02.2023 counts as bad (the reference raises).
    """
    strings = [f.name for f in data_sheet.schema.fields
               if isinstance(f.dataType, T.StringType) and f.name != file_col]
    if strings:
        tokens = F.flatten(F.array(*[F.coalesce(date_tokens(c), F.array().cast("array<string>"))
                                     for c in strings]))
    else:
        tokens = F.array().cast("array<string>")
    t = data_sheet.select(file_col, F.explode(tokens).alias("_tok")).withColumn("_d", parse_dmy("_tok"))
    per = t.groupBy(file_col).agg(
        F.min("_d").alias("date_created"),
        F.max("_d").alias("date_expired"),
        F.count("_tok").alias("n_dates"),
        F.sum(F.col("_d").isNull().cast("long")).alias("n_bad_dates"),
    )
    return per


def integer_id(c: str | Column) -> Column:
    """A product id as a whole number; NULL for other text (``7.0``, as sheets write it, is 7)."""
    col = F.col(c) if isinstance(c, str) else c
    number = col.cast("string").try_cast("decimal(38,9)")
    return F.when(number == F.floor(number), number.try_cast("long"))


def _is_bad_id(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & integer_id(col).isNull()


def _judge(files: DataFrame, long: DataFrame, dates: DataFrame, file_col: str, ts: Column):
    """(accepted files with their dates, run log) from per-file facts.

    ``files`` brings ``early_reason`` (why its sheet cannot be loaded at all,
    or NULL) and ``n_bad_ids``; every row of it gets a log row.
    """
    stats = long.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("observation_text").isNotNull() & F.col("observation_value").isNull()).alias("n_bad_values"),
    )
    per_file = files.join(stats, file_col, "left").join(dates, file_col, "left")
    reason = F.coalesce(
        F.col("early_reason"),
        F.when(F.coalesce("n_bad_dates", F.lit(0)) > 0, F.lit(MSG_BAD_DATE))
        .when(F.coalesce("n_dates", F.lit(0)) == 0, F.lit(MSG_NO_DATES))
        .when(F.coalesce("n_bad_ids", F.lit(0)) > 0, F.lit(MSG_BAD_ID))
        .when(F.coalesce("n_bad_values", F.lit(0)) > 0, F.lit(MSG_BAD_VALUE)),
    )
    per_file = materialize(per_file.withColumn("error_message", reason), "file-facts")  # read by the rows and by the log
    log = per_file.select(
        ts.alias("timestamp"), F.col(file_col).alias("file_path"),
        F.when(F.col("error_message").isNull(), F.coalesce("n_rows", F.lit(0))).otherwise(F.lit(0))
        .cast("long").alias("rows_loaded"),
        "error_message",
    )
    return per_file.where(F.col("error_message").isNull()).select(file_col, "date_created", "date_expired"), log


def _accepted(long: DataFrame, good: DataFrame, file_col: str) -> DataFrame:
    return long.join(good, file_col, "inner").select(*OBSERVATION.fieldNames(), file_col)


def _run_ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(str(run_ts)).cast("timestamp_ntz")


def load_files(sheet: DataFrame, data_sheet: DataFrame, run_ts, file_col: str = "file_path",
               units: dict[str, str] | None = None, id_present: DataFrame | None = None):
    """ETL of sheets of one shape.  Returns (observation rows to append, run log).

    Every file is taken to have every column of ``sheet``; ``load_sheets``
    takes files whose columns differ.  A file is skipped with a log row when
    it has no product id column, no date, a bad date, a product id that is no
    whole number or a non-numeric measure; otherwise its rows get the file's
    min/max date (B10) and the log row carries the row count (E6).
    ``id_present`` (file_col, has_id) says which files have a ``productid``
    column; by default a file has it when some row carries a value there.
    """
    long = unpivot_observations(sheet, units, keep=[file_col])
    idc = next((c for c in ("productid", "product_id") if c in sheet.columns), None)
    ids = F.col(idc) if idc else F.lit(None).cast("long")
    files = sheet.groupBy(file_col).agg(F.max(ids.isNotNull()).alias("has_id"),
                                        F.count_if(_is_bad_id(ids)).alias("n_bad_ids"))
    if id_present is not None:
        files = files.drop("has_id").join(id_present, file_col, "left")
    files = files.withColumn(
        "early_reason", F.when(~F.coalesce(F.col("has_id"), F.lit(False)), F.lit(MSG_NO_ID)))
    good, log = _judge(files, long, file_dates(data_sheet, file_col), file_col, _run_ts(run_ts))
    return _accepted(long, good, file_col), log


def unpivot_sheets(sheets: DataFrame, file_col: str = "file_path", units: dict[str, str] | None = None) -> DataFrame:
    """C2 + C3 for rows of ``fields`` maps: each file yields its own columns and no other's.

    A file's columns are the keys that any of its rows brings (at most one
    entry per column and file); a row without one of them has NULL there.
    """
    own = sheets.select(file_col, F.explode(F.map_keys("fields")).alias("_c")).groupBy(file_col).agg(
        F.collect_set("_c").alias("_own"))
    own = materialize(own, "sheet-columns")  # one row per file: its size is known, and rows stay where they are
    measures = F.filter("_own", lambda c: ~c.isin(*RENAMES, *ID_COLUMNS))
    f = F.col("fields")
    either = {new: F.coalesce(f[old], f[new]) for old, new in RENAMES.items()}
    return sheets.join(own, file_col).select(
        file_col, "fields", integer_id(either["product_id"]).alias("product_id"),
        either["product_name"].alias("product_name"), either["pest_name"].alias("pest_name"),
        F.explode(measures).alias("observation_name"),
    ).withColumn("observation_text", F.col("fields")[F.col("observation_name")]).select(
        "product_id", "product_name", "pest_name", file_col, "observation_name",
        F.col("observation_text").try_cast("double").alias("observation_value"), "observation_text",
        unit_for("observation_name", units).alias("observation_unit"),
    )


def load_sheets(sheets: DataFrame, files: DataFrame, data_sheets: DataFrame, run_ts,
                file_col: str = "file_path", units: dict[str, str] | None = None):
    """ETL of sheets with columns of their own (``io.read_sheets``).  Returns (rows to append, run log).

    ``files`` (file_col, n_bad) names every listed file and its unreadable
    lines; each gets a log row: unreadable, empty (no columns, so no product
    id), or as in ``load_files``.  ``data_sheets`` has rows of ``fields``
    maps under the same file names.
    """
    long = unpivot_sheets(sheets, file_col, units)
    f = F.col("fields")

    def has(key: str) -> Column:
        return F.max(F.map_contains_key(f, F.lit(key)))

    facts = sheets.groupBy(file_col).agg(has("productid").alias("_has_id"), has("product").alias("_has_product"),
                                         F.count_if(_is_bad_id(f["productid"])).alias("n_bad_ids"))
    files = files.join(facts, file_col, "left").withColumn(
        "early_reason",
        F.when(F.col("n_bad") > 0, F.lit(MSG_UNREADABLE))
        .when(~F.coalesce("_has_id", F.lit(False)), F.lit(MSG_NO_ID))
        .when(~F.coalesce("_has_product", F.lit(False)), F.lit(MSG_NO_PRODUCT)),
    )
    cells = data_sheets.select(file_col, F.array_join(F.map_values("fields"), "\u0001").alias("cells"))
    good, log = _judge(files, long, file_dates(cells, file_col), file_col, _run_ts(run_ts))
    return _accepted(long, good, file_col), log


def load_folder(spark: SparkSession, sheet_dir: str, data_dir: str, run_ts, table: str, log_table: str,
                sheet_name: str = r"([^/]+)$", fmt: str = "json", expected: list[str] | None = None) -> None:
    """A folder of sheets to the observation table and the run log.

    ``fmt``: ``json`` (lines) or ``csv`` (each file with its own header).  A
    file that cannot be read to its end, or that ``expected`` names and the
    folder lacks, gets a log row with 0 rows; the others load.

    ``sheet_name`` is a pattern whose first group names the sheet in a file
    path (the file name by default), under which a sheet meets its data
    sheet; several files may make up one sheet.  Both tables are created
    when absent and appended to.
    """
    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("file_path", F.regexp_extract("file_path", sheet_name, 1))

    sheets, files = io.read_sheets(spark, sheet_dir, fmt=fmt, expected=expected)
    data, data_files = io.read_sheets(spark, data_dir, fmt=fmt)
    bad = named(files.select("file_path", "n_bad").unionByName(data_files.where(F.col("n_bad") > 0)))
    files = bad.groupBy("file_path").agg(F.sum("n_bad").alias("n_bad"))
    rows, log = load_sheets(named(sheets), files, named(data), run_ts)
    io.ensure_table(spark, table, OBSERVATION)
    io.ensure_table(spark, log_table, RUN_LOG)
    io.write_append(rows.select(*OBSERVATION.fieldNames()), table)
    io.write_append(log.select(*RUN_LOG.fieldNames()), log_table)
