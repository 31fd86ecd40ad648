"""WARC archives with revisit records.

Pages become records; of records with one payload a single one is written
with it, the others become revisit records that name it.  Headers alone are
shuffled by payload digest, a payload is moved only for the record that keeps
it.  Archives go through Spark's own text writer (any store Spark reaches,
task retries included) and are read back record by record by Content-Length.
"""

from __future__ import annotations

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import quoted
from fieldbook.session import materialize, scratch_path

CRLF = "\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # base32, RFC 4648 (fixed)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()),
                    ("payload", pa.string())])
RECORD_DDL = ("record_id string, record_type string, page_id long, url string, payload_digest string, "
              "refers_to_id string, payload string")


def base32(digits: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 given as 40 hex digits: eight 20-bit groups of four letters."""
    letters = []
    for g in range(8):
        group = F.conv(F.substring(digits, 5 * g + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(group, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                    for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def resolve_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                     html_col: str = "html") -> DataFrame:
    """The records to write: record_id, record_type, page_id, url, digest, refers_to_id, payload.

    Records with equal payloads (SHA-1, SHA-256 and length agree) of at least
    ``min_bytes`` bytes keep one response, that with the largest page_id; the
    payload of all others is null and they refer to it.  Of repeated rows
    with that page_id one is the response.  A null payload is empty; a null
    page_id is smaller than any other.
    """
    html = F.coalesce(quoted(html_col).cast("string"), F.lit(""))
    page = quoted(id_col).cast("long")
    no_id = F.lit(-(1 << 63)).cast("long")  # stands for a null page_id in keys, so plain equality serves
    rows = pages.select(F.coalesce(page, no_id).alias("pid"), page.isNull().alias("unnamed"),
                        quoted(url_col).cast("string").alias("url"), html.alias("payload"),
                        F.sha1(html).alias("sha1"), F.sha2(html, 256).alias("sha2"),
                        F.octet_length(html).cast("long").alias("bytes"))
    key = ["sha1", "sha2", "bytes"]
    heads = materialize(rows.drop("payload"), "warc-heads")
    first = heads.groupBy(*key).agg(F.max("pid").alias("first_id"))
    again = heads.join(first, key).filter((F.col("pid") != F.col("first_id")) & (F.col("bytes") >= min_bytes))
    whole = rows.join(first.withColumn("pid", F.col("first_id")), [*key, "pid"])
    if min_bytes > 0:
        whole = whole.filter(F.col("bytes") >= min_bytes).unionByName(
            rows.filter(F.col("bytes") < min_bytes).withColumn("first_id", F.col("pid")))
    # repeated rows: the keys are those of the join, so the payloads do not move again
    whole = whole.withColumn("nth", F.row_number().over(Window.partitionBy(*key, "pid").orderBy("url")))
    # revisits are numbered by a key of their own: the join's would bring all copies of one payload into one task
    who = F.concat_ws("|", F.col("pid").cast("string"), "sha1", "sha2")
    again = again.withColumn("payload", F.lit(None).cast("string")).withColumn(
        "nth", F.row_number().over(Window.partitionBy(who).orderBy("url")))
    out = whole.unionByName(again)
    revisit = F.col("payload").isNull() | ((F.col("nth") > 1) & (F.col("bytes") >= min_bytes))

    def ident(page_col: str, n: Column) -> Column:
        h = F.md5(F.concat_ws("|", F.col(page_col).cast("string"), "sha2", n.cast("string")))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))

    return out.select(
        ident("pid", F.col("nth")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(~F.col("unnamed"), F.col("pid")).alias("page_id"), "url", base32(F.col("sha1")).alias("digest"),
        F.when(revisit, ident("first_id", F.lit(1))).alias("refers_to_id"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def record_text(date: str) -> Column:
    """A whole WARC/1.1 record (its closing CRLF is the writer's line separator)."""
    def head(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value, F.lit(CRLF))).otherwise(F.lit(""))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    length = F.octet_length(F.coalesce("payload", F.lit("")))
    block = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
                     F.when(F.col("payload").isNotNull(),
                            F.concat(F.lit("Content-Length: "), length.cast("string"), F.lit(CRLF))).otherwise(F.lit("")),
                     F.lit(CRLF), F.coalesce("payload", F.lit("")))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        head("WARC-Type", F.col("record_type")), head("WARC-Record-ID", F.col("record_id")),
        head("WARC-Date", F.lit(date)), head("WARC-Target-URI", url),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        head("WARC-Refers-To", F.col("refers_to_id")),
        head("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit(PROFILE))),
        head("X-Page-Id", F.col("page_id").cast("string")),
        head("Content-Type", F.lit("application/http;msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block, F.lit(CRLF))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = 20000, **columns) -> None:
    """Write deduplicated gzip archives of ``pages`` to the folder ``path``, with fresh headers."""
    (resolve_revisits(pages, min_bytes, **columns).select(record_text(date).alias("value"))
     .write.option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
     .text(path))


def parse_archive(stream):
    """(headers, block) of each record, cut by Content-Length; a torn record is an error."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {line[:40]!r}")
        heads = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            heads[name.strip().lower().decode()] = value.strip().decode("utf-8")
        size = int(heads["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("torn record")
        yield heads, block


def _reader(with_payload: bool):
    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for heads, block in parse_archive(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data.as_py())))):
                    page = heads.get("x-page-id")
                    payload = block.partition(b"\r\n\r\n")[2] if heads["warc-type"] == "response" else None
                    rows.append({
                        "record_id": heads["warc-record-id"], "record_type": heads["warc-type"],
                        "page_id": int(page) if page is not None else None, "url": heads.get("warc-target-uri"),
                        "payload_digest": heads["warc-payload-digest"].removeprefix("sha1:"),
                        "refers_to_id": heads.get("warc-refers-to"),
                        "payload": payload.decode("utf-8") if payload is not None and with_payload else None}
                        | ({} if with_payload else {"payload_bytes": len(payload) if payload is not None else None}))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=_schema(with_payload))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_schema(with_payload))
    return run


def _schema(with_payload: bool) -> pa.Schema:
    return RECORD if with_payload else pa.schema([*list(RECORD)[:-1], ("payload_bytes", pa.int64())])


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path`` (payload, or only its length)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    ddl = RECORD_DDL if with_payload else RECORD_DDL.replace("payload string", "payload_bytes long")
    return files.mapInArrow(_reader(with_payload), ddl)


def resolved(records: DataFrame) -> DataFrame:
    """Every record with its response's page_id (refers_to) and payload length, joined by record id."""
    full = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("_rid"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"))
    back = records.filter("record_type = 'revisit'").join(full, F.col("refers_to_id") == F.col("_rid")).select(
        "page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    own = records.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(back)


def warc_round_trip(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload; null urls are left out of the record; an
    empty table writes nothing and gives no rows; extra columns are not
    looked at.
    """
    import uuid

    spark = pages.sparkSession
    path = scratch_path(spark, f"fieldbook-tables/warc-{uuid.uuid4().hex}")
    write_archives(pages, path, min_bytes, **columns)
    return resolved(read_archives(spark, path, with_payload=False))
