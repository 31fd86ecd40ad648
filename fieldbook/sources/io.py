"""Scans and sinks: Parquet tables, JSON batches, file folders, snapshots.

Snapshots stand in for a transactional table format (none is on the
classpath here): a table is a folder of ``v=<n>/`` versions, each committed
by an empty ``_committed`` file written last.  Readers take the highest
committed version, so a job never overwrites the folder it is reading, and a
failed write leaves the old version current.
"""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.session import materialize

COMMITTED = "_committed"


# ---------------------------------------------------------------- reads
def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Full scan of a Parquet table (a snapshot folder is resolved first)."""
    resolved = current_version(spark, path) or path
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(resolved)
    return df.select(*columns) if columns else df


def read_limit(df: DataFrame, n: int | None) -> DataFrame:
    """``head(limit)``: any n rows (no order is implied by the source)."""
    return df if n is None else df.limit(n)


def table_columns(df: DataFrame) -> list[str]:
    """Column list of a table, in schema order."""
    return list(df.columns)


FIELDS = T.MapType(T.StringType(), T.StringType(), True)


def parse_object(text: Column) -> Column:
    """A JSON object's fields as ``map<string,string>``; NULL for anything else.

    Exactly one whole object: a torn line, an array, a bare value or text
    after the closing brace is NULL.  A field given as JSON null is a present
    key with a NULL value, a missing field an absent key; nested values stay
    JSON text.
    """
    whole = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(T.StringType()))
    is_object = (F.size(whole) == 1) & F.ltrim(text).startswith("{")
    return F.when(is_object, F.from_json(text, FIELDS))


def _typed(v: Column, dtype: T.DataType) -> Column:
    return F.from_json(v, dtype) if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)) else v.try_cast(dtype)


def typed_field(fields: Column, name: str, dtype: T.DataType) -> Column:
    """One field of a map in its column type; NULL when absent, null or not of that type."""
    return _typed(fields[name], dtype)


def fields_fit(fields: Column, schema: T.StructType) -> Column:
    """True when every field of ``schema`` that has a value fits its column type.

    The values are taken by another expression than in ``typed_field``: where
    a plan filters on this and also selects those columns, the optimizer
    would else derive a constraint for every combination of them.
    """
    values = [(F.try_element_at(fields, F.lit(f.name)), f.dataType) for f in schema.fields]
    misfits = [v.isNotNull() & _typed(v, dtype).isNull() for v, dtype in values]
    return ~F.array_contains(F.array(*misfits), True) if misfits else F.lit(True)


def _json_records(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """(_file, _start, record, fields): every JSON record, ``fields`` NULL where it is malformed.

    Lines are read as splittable text, blank ones skipped; an array file is
    one row (``wholetext``), and one that does not parse is a single record.
    """
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=multiline).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), "value")
    if not multiline:
        return raw.where(F.trim("value") != "").select(
            "_file", "_start", F.col("value").alias("record"), parse_object(F.col("value")).alias("fields"))
    text = F.when(F.ltrim("value").startswith("{"), F.concat(F.lit("["), F.col("value"), F.lit("]"))).otherwise(
        F.col("value"))
    whole = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(T.StringType()))
    items = F.when((F.size(whole) == 1) & F.ltrim(text).startswith("["), F.from_json(text, T.ArrayType(T.StringType())))
    objects = F.forall("_items", lambda e: F.coalesce(F.ltrim(e).startswith("{"), F.lit(False)))
    maps = F.when(objects, F.from_json(text, T.ArrayType(FIELDS))).otherwise(F.transform("_items", parse_object))
    one = F.struct(F.col("value").alias("record"), F.lit(None).cast(FIELDS).alias("fields"))
    pairs = F.zip_with("_items", "_maps", lambda r, m: F.struct(r.alias("record"), m.alias("fields")))
    return (
        raw.withColumn("_items", items).withColumn("_maps", maps)
        .select("_file", F.posexplode(F.when(F.col("_items").isNull(), F.array(one)).otherwise(pairs))
                .alias("_start", "_e"))
        .select("_file", F.col("_start").cast("long").alias("_start"), "_e.record", "_e.fields")
    )


def _keep_good(records: DataFrame, good: Column, on_bad: str) -> DataFrame:
    if on_bad == "skip":
        return records.where(good)
    if on_bad != "fail":
        raise ValueError("on_bad must be 'fail' or 'skip'")
    message = F.concat(F.lit("malformed JSON record in "), F.col("_file"))
    return records.where(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _good(schema: T.StructType | None) -> Column:
    ok = F.col("fields").isNotNull()
    return ok if schema is None else ok & F.coalesce(fields_fit(F.col("fields"), schema), F.lit(False))


def json_rejects(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 multiline: bool = False) -> DataFrame:
    """(file_path, record): the records that the JSON readers of this module do not return.

    A torn line, an element that is no object, an array file that does not
    parse (its whole text), and with ``schema`` a value that does not fit its
    column.
    """
    return _json_records(spark, path, multiline).where(~_good(schema)).select(
        F.col("_file").alias("file_path"), "record")


def read_json_batch(spark: SparkSession, path: str, schema: T.StructType,
                    multiline: bool = False, seq_col: str | None = None, on_bad: str = "fail") -> DataFrame:
    """Read a JSON batch with a fixed schema (no inference).

    JSON lines by default (splittable); ``multiline=True`` for files holding
    one JSON array.  With ``seq_col`` each row gets its position in the batch
    (file name, then position in the file) so batch order can decide ids and
    which duplicate wins.  A malformed record fails the job, or with
    ``on_bad="skip"`` is left to ``json_rejects``.
    """
    if multiline:
        return read_json_array(spark, path, schema, seq_col or "_seq", on_bad=on_bad)
    df = _keep_good(_json_records(spark, path, False), _good(schema), on_bad)
    cols = [typed_field(F.col("fields"), f.name, f.dataType).alias(f.name) for f in schema.fields]
    if not seq_col:
        return df.select(*cols)
    from fieldbook.operators.ids import read_order
    return read_order(df.select("_file", "_start", *cols), seq_col)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, seq_col: str = "seq",
                    file_col: str | None = None, on_bad: str = "fail") -> DataFrame:
    """Files that each hold one JSON array of objects; keeps element order.

    ``seq_col`` numbers the elements 1..n by (file name, position in the
    file).  Malformed elements and files as in ``read_json_batch``.
    """
    good = _keep_good(_json_records(spark, path, True), _good(schema), on_bad)
    out = _number_by_file(good, seq_col)
    cols = [typed_field(F.col("fields"), f.name, f.dataType).alias(f.name) for f in schema.fields]
    return out.select(*([F.col("_file").alias(file_col)] if file_col else []), seq_col, *cols)


def read_json_maps(spark: SparkSession, path: str, seq_col: str = "seq", multiline: bool = True,
                   on_bad: str = "fail") -> DataFrame:
    """JSON objects read as ``map<string,string>`` rows, numbered in read order.

    Array files, or with ``multiline=False`` JSON lines (splittable).  Key
    presence survives: a field given as JSON null is a present key with a
    NULL value, a missing field an absent key.  Used for partial updates.
    """
    good = _keep_good(_json_records(spark, path, multiline), _good(None), on_bad)
    if multiline:
        return _number_by_file(good, seq_col).select(seq_col, "fields")
    from fieldbook.operators.ids import read_order
    return read_order(good.select("_file", "_start", "fields"), seq_col)


def _number_by_file(df: DataFrame, seq_col: str) -> DataFrame:
    from fieldbook.operators.ids import dense_ids
    return dense_ids(df, ["_file", "_start"], id_col=seq_col)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as ``_metadata.file_path`` writes it."""
    fs, p = _fs(spark, path)
    return _uri(fs.makeQualified(p))


def _uri(p) -> str:
    return re.sub("^file:/+", "file:/", p.toUri().toString())


def list_files(spark: SparkSession, path: str, file_col: str = "file_path") -> DataFrame:
    """(file_col, length): one row per file below ``path``, empty ones included; no content is read.

    Names are written as ``_metadata.file_path`` writes them.  Like Spark's
    own file index, the listing is held by the driver; files and folders
    whose name starts with ``_`` or ``.`` are left out.
    """
    fs, root = _fs(spark, path)
    found = []
    for top in fs.globStatus(root) or []:
        base = _uri(top.getPath())
        left = fs.listFiles(top.getPath(), True)
        while left.hasNext():
            one = left.next()
            name = _uri(one.getPath())
            if not any(part[:1] in ("_", ".") for part in name[len(base):].split("/")):
                found.append((name, one.getLen()))
    return spark.createDataFrame(found, f"{file_col} string, length long")


#: File name endings that Hadoop's codecs decode; such a file does not split.
PACKED = ("gz", "bz2", "zst", "lz4", "snappy", "deflate")


def read_lines(spark: SparkSession, path: str, file_col: str = "file_path",
               expected: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A folder of text files, read with an account: (file, _start, _at, value) and (file, complete).

    One undecodable or vanished file does not end the job, and does not go
    unnoticed.  Plain files are split and read line by line; such a file is
    complete when the bytes of its lines make up its listed size.  A packed
    file (``PACKED``) cannot be split, and a cut one gives its first lines
    before it fails; it is therefore decoded whole, in one row, which either
    arrives or does not.  A packed file must thus fit a task's memory
    (2 GB unpacked at most).

    Every listed file has a row in the account, as has every file name in
    ``expected`` (a manifest) whether it is there or not.  ``complete`` is
    false for a file of which not all was read; lines of such a file may be
    in the first frame.  ``_at`` orders the lines of one split.
    """
    def tolerant():
        return spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).option(
            "ignoreMissingFiles", True)

    name = F.col("_metadata.file_path").alias(file_col)
    is_packed = F.col("_metadata.file_name").rlike(r"\.(" + "|".join(PACKED) + ")$")
    plain = tolerant().option("lineSep", "\n").text(path).where(~is_packed).select(
        name, F.col("_metadata.file_block_start").alias("_start"), "value", F.col("_metadata.file_size").alias("_size"))
    whole = tolerant().option("pathGlobFilter", "*.{" + ",".join(PACKED) + "}").text(path, wholetext=True).select(
        name, "value")
    # LineRecordReader leaves out a byte order mark of 3 bytes; the last line may lack its line end
    read = plain.groupBy(file_col).agg(
        (F.sum(F.octet_length("value") + 1) + 3 >= F.max("_size")).alias("_read")).unionByName(
        whole.select(file_col, F.lit(True).alias("_read")))
    listed = list_files(spark, path, file_col)
    if expected is not None:
        given = spark.createDataFrame([(qualified(spark, f),) for f in expected], f"{file_col} string")
        listed = listed.join(given, file_col, "full")
    account = listed.join(read, file_col, "left").select(
        file_col, F.coalesce(F.col("_read"), F.col("length") == 0, F.lit(False)).alias("complete"))
    unpacked = whole.select(file_col, F.lit(0).cast("long").alias("_start"), F.posexplode(F.split("value", "\n")).alias(
        "_at", "value"))
    lines = plain.select(file_col, "_start", F.monotonically_increasing_id().alias("_at"), "value").unionByName(
        unpacked.withColumn("_at", F.col("_at").cast("long")))
    return lines.withColumn("value", F.regexp_replace("value", "\r$", "")), account


def csv_cells(line: Column, sep: str = ",") -> Column:
    """The cells of one CSV line as array<string>, quotes undone and empty cells NULL; NULL for a torn line.

    Quotes are doubled inside quoted cells.  A line end inside quotes is not supported: lines are read from
    splits, so such a line is torn.
    """
    one = re.escape(sep)
    whole = F.concat(F.lit(sep), line)
    raw = F.regexp_extract_all(whole, F.lit(one + '("[^"]*+(?:""[^"]*+)*+"|[^"' + one + "]*+)"), F.lit(1))
    inside = F.transform(raw, lambda c: F.when(
        c.startswith('"'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(F.array_join(F.transform(raw, lambda c: F.concat(F.lit(sep), c)), "") == whole,
                  F.transform(inside, lambda c: F.nullif(c, F.lit(""))))


def _csv_records(lines: DataFrame, file_col: str, sep: str) -> DataFrame:
    """Lines of CSV files as field maps by their own file's header; ``fields`` NULL for a torn line.

    A file's header is its first line that is not blank, in the split that
    starts at byte 0.  One row per file, written once, is joined to the lines, so
    the files stay splittable and, with few files, lines stay in their tasks.  A cell beyond the header makes its line torn; a column
    name that repeats counts once, the first; missing cells are NULL.
    """
    full = lines.where(F.trim("value") != "")
    # the least number first, which needs no sort of the lines, then the line that has it
    first = materialize(full.where(F.col("_start") == 0).groupBy(file_col).agg(F.min("_at").alias("_first")), "sheet-tops")
    at = first.select(F.col(file_col).alias("_ff"), "_first")
    names = F.transform(csv_cells(F.col("value"), sep), lambda c: F.trim(c))
    header = materialize(full.where(F.col("_start") == 0).join(
        at, (F.col(file_col) == F.col("_ff")) & (F.col("_at") == F.col("_first"))).select(
        file_col, "_first", names.alias("_names")), "sheet-headers")
    cells = csv_cells(F.col("value"), sep)
    pairs = F.filter(F.transform("_names", lambda n, i: F.struct(n.alias("n"), F.get("_cells", i).alias("v"), i.alias("i"))),
                     lambda e: e["n"].isNotNull() & (F.array_position("_names", e["n"]) == e["i"] + 1))
    entries = F.map_from_entries(F.transform(pairs, lambda e: F.struct(e["n"], e["v"])))
    return (full.withColumn("_cells", cells).join(header, file_col)
            .where((F.col("_start") > 0) | (F.col("_at") != F.col("_first")))
            .select(file_col, F.when(F.size("_cells") <= F.size("_names"), entries).alias("fields")))


def read_sheets(spark: SparkSession, path: str, file_col: str = "file_path", fmt: str = "json", sep: str = ",",
                expected: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A folder of sheet exports, JSON lines or CSV: (rows with a ``fields`` map, one row per listed file).

    Each file has only the columns it brings: JSON rows keep their own keys,
    CSV rows take the names of their own file's header, in whatever order
    these stand.  The file rows carry ``n_bad``, the number of torn lines,
    plus one where the file could not be read to its end (``read_lines``):
    an undecodable, cut or vanished file is known by it, ends no job and
    loses nothing silently.  A CSV file with a header and no rows is a file
    without rows here.  Records are parsed once and written.
    """
    lines, account = read_lines(spark, path, file_col, expected)
    if fmt == "csv":
        records = _csv_records(lines, file_col, sep)
    elif fmt == "json":
        records = lines.where(F.trim("value") != "").select(file_col, parse_object(F.col("value")).alias("fields"))
    else:
        raise ValueError("fmt must be 'json' or 'csv'")
    records = materialize(records, "sheet-records")
    bad = records.groupBy(file_col).agg(F.count_if(F.col("fields").isNull()).alias("n_bad"))
    files = account.join(bad, file_col, "left").select(
        file_col, (F.coalesce("n_bad", F.lit(0)) + F.when(F.col("complete"), 0).otherwise(1)).alias("n_bad"))
    return records.where(F.col("fields").isNotNull()).select(file_col, "fields"), files


def read_folder(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None,
                options: dict | None = None, file_col: str = "file_path",
                skip_bad_files: bool = False) -> DataFrame:
    """All files of a folder as one DataFrame plus the source file of each row.

    ``file_col`` comes from the hidden ``_metadata`` column.  Fits folders of
    identically shaped sheets (CSV columns are matched to the first header,
    and ``enforceSchema`` is off, so a file with other names fails the job);
    ``read_sheets`` keeps each file's own columns.
    A file that vanished or cannot be decoded fails the job; only
    ``skip_bad_files=True`` drops its rows (``ignoreMissingFiles`` /
    ``ignoreCorruptFiles``).
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    if skip_bad_files:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.withColumn(file_col, F.col("_metadata.file_path"))


# ---------------------------------------------------------------- writes
def write_append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a Parquet table (the reference's WRITE_APPEND)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table with ``schema`` unless one exists."""
    if _exists(spark, path):
        return
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none when it is not there."""
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version number -> committed, of the ``v=<n>`` folders under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    found = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), COMMITTED)
            found[int(name[2:])] = fs.exists(marker)
    return found


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the highest committed snapshot of ``path``; None when it is no snapshot table.

    Versions of which none is committed raise: their rows are unfinished.
    """
    found = _versions(spark, path)
    done = [n for n, committed in found.items() if committed]
    if found and not done:
        raise ValueError(f"{path} holds no committed version")
    return f"{path.rstrip('/')}/v={max(done)}" if done else None


def _next_version(spark: SparkSession, path: str) -> int:
    return max((n for n, committed in _versions(spark, path).items() if committed), default=0) + 1


def write_snapshot(df: DataFrame, path: str, version: int | None = None,
                   extra_files: dict[str, str] | None = None) -> str:
    """Write ``df`` as a new version of the table at ``path`` and switch to it.

    The data lands in ``path/v=<n>/`` first, ``extra_files`` next and the
    commit marker last, so readers see the old or the new version, never a
    half one.  Reading the current version while writing the next is safe.
    """
    spark = df.sparkSession
    n = version if version is not None else _next_version(spark, path)
    target = f"{path.rstrip('/')}/v={n}"
    df.write.mode("overwrite").parquet(target)
    for name, content in (extra_files or {}).items():
        write_text_file(spark, f"{target}/{name}", content)
    write_text_file(spark, f"{target}/{COMMITTED}", "")
    return target


def write_text_file(spark: SparkSession, path: str, content: str) -> None:
    """Small control file (marker) through the Hadoop file system."""
    write_bytes_file(spark, path, content.encode("utf-8"))


def write_bytes_file(spark: SparkSession, path: str, content: bytes) -> None:
    """Small binary file through the Hadoop file system."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def write_tables(tables: dict[str, DataFrame], base: str, mode: str = "snapshot") -> dict[str, str]:
    """Write a dict of frames (e.g. the 8 normalised tables), one folder each."""
    out = {}
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{name}"
        if mode == "snapshot":
            out[name] = write_snapshot(df, path)
        else:
            write_append(df, path)
            out[name] = path
    return out
