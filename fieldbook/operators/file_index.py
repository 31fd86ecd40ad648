"""File skipping for repeated keyword searches.

A search by ``LIKE '%kw%'`` over all columns cannot be pushed into Parquet, so
each one reads the whole table.  Here a sketch per file is written once: the
slots that the hashed trigrams of its cells fall into.  A file can match a
keyword only if it has the slots of all of the keyword's trigrams, so a
search reads those files and no others, with the same rows as a full scan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators import search as keyword_search
from fieldbook.sources import io

#: what tells a file's state: name, size, change time, and the zone its times were made text in
_STAMP = ["name", "size", "changed", "zone"]


def _slots(grams: Column, slots: int) -> Column:
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(slots)).cast("int"))


def _glob_free(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


class FileIndex:
    """The sketches of a Parquet table's files, kept under ``path``: ``files/`` (what was sketched) and ``slots/``."""

    def __init__(self, spark: SparkSession, table: str, path: str, slots: int = 1 << 18):
        self.spark, self.table, self.path, self.slots = spark, table.rstrip("/"), path.rstrip("/"), slots

    def _listed(self) -> DataFrame:
        """(file, *_STAMP) of the table's files, from the listing, without opening them."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.table)
        return files.select(
            F.col("path").alias("file"), F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"),
            F.unix_micros("modificationTime").alias("changed"), F.current_timezone().alias("zone"))

    def _read(self, files: list[str] | None = None) -> DataFrame:
        fs, p = io._fs(self.spark, self.table)
        reader = self.spark.read.option("basePath", self.table) if fs.getFileStatus(p).isDirectory() else self.spark.read
        if files is None:
            return reader.parquet(self.table)
        return reader.schema(self._read().schema).parquet(*map(_glob_free, files))

    def _known(self) -> DataFrame:
        if not io.list_names(self.spark, self.path + "/files"):
            return self.spark.createDataFrame([], "name string, size long, changed long, zone string")
        return self.spark.read.parquet(self.path + "/files")

    def refresh(self) -> int:
        """Sketch the files that are new or changed since the last call; their number.

        Slots are written before the list of files, so a file counts as sketched only when its slots are there, and
        only in the state that was listed.  Trigrams are made distinct map-side: a slot of a file is one row.
        """
        fresh = self._listed().join(self._known(), _STAMP, "left_anti").collect()
        if not fresh:
            return 0
        rows = self._read([r["file"] for r in fresh])
        cells = F.array_compact(F.array(*[F.col(f"`{c}`").cast("string") for c in rows.columns]))
        grams = keyword_search._grams(F.array_join(cells, "\u0001"), keyword_search._GRAM)
        held = rows.select(
            F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("size"),
            F.unix_micros("_metadata.file_modification_time").alias("changed"), F.current_timezone().alias("zone"),
            F.explode(_slots(grams, self.slots)).alias("slot")).distinct()
        # sorted by slot: a search for a few slots skips the other row groups
        held.repartitionByRange("slot", "name").sortWithinPartitions("slot").write.mode("append").parquet(self.path + "/slots")
        done = self.spark.createDataFrame([tuple(r[c] for c in _STAMP) for r in fresh], self._known().schema)
        done.coalesce(1).write.mode("append").parquet(self.path + "/files")
        return len(fresh)

    def files_for(self, keywords: list[str], literal: bool = False) -> list[str]:
        """Files of the table that can hold a match of any keyword; those not sketched as they are now always count.

        A keyword without a literal stretch of three characters has no trigram: it can match in any file.
        """
        kw = self.spark.createDataFrame([(k,) for k in keywords], "_kw string")
        factors = F.array("_kw") if literal else keyword_search._factors(F.col("_kw"))
        grams = F.flatten(F.transform(factors, lambda f: keyword_search._grams(f, keyword_search._GRAM)))
        need = [r[0] for r in kw.select(F.array_distinct(_slots(grams, self.slots))).collect()]
        now = self._listed()
        if not all(need):
            return sorted(r["file"] for r in now.select("file").collect())
        hit = now.join(self._known(), _STAMP, "left_anti").select("file")
        if io.list_names(self.spark, self.path + "/slots"):
            wanted = sorted({s for slots in need for s in slots})
            held = (self.spark.read.parquet(self.path + "/slots").where(F.col("slot").isin(wanted))
                    .groupBy(*_STAMP).agg(F.collect_set("slot").alias("held")))  # no more than the keywords' own
            fits = reduce(lambda a, b: a | b, [
                F.size(F.array_except(F.array(*map(F.lit, slots)), "held")) == 0 for slots in need])
            hit = hit.unionByName(now.join(held.where(fits), _STAMP, "left_semi").select("file"))
        return sorted(r["file"] for r in hit.distinct().collect())

    def search(self, keywords: list[str], columns: list[str] | None = None, literal: bool = False) -> DataFrame:
        """The rows that ``search.search`` finds in the table, read from the files that can hold them."""
        whole = self._read()
        keyword_search.search(whole, keywords, columns, literal)  # refuses what the scan refuses
        files = self.files_for(keywords, literal)
        return keyword_search.search(self._read(files) if files else whole.limit(0), keywords, columns, literal)
