"""Ids for several writers: blocks of ids leased by files that only one writer can create.

``continue_ids`` reads max(id) and goes on from there, so two writers at the
same time give the same ids twice.  Here ids come in blocks of a fixed size;
block b holds the ids b*size+1 .. (b+1)*size.  A writer leases a block by
creating its file in a shared folder, which the file system lets exactly one
writer do.  What a writer that fails has leased is never used again: a gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.ids import dense_ids
from fieldbook.session import materialize
from fieldbook.sources import io

_SHAPE = "size"


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; True for the one writer that did.

    On a local disk the Hadoop client looks first and creates then, so the plain call of the JVM is used there.
    """
    fs, p = io._fs(spark, path)
    jvm = spark.sparkContext._jvm
    if fs.getUri().getScheme() == "file":
        return bool(jvm.java.io.File(p.toUri().getPath()).createNewFile())
    try:
        fs.create(p, False).close()
        return True
    except Exception as e:  # the class name tells the race lost from a real failure
        if "FileAlreadyExists" in str(e):
            return False
        raise


class IdBlocks:
    """The leases of one id sequence, kept under ``path``.

    ``size`` ids make a block.  It is fixed by the first writer; others must name the same.  Take it so that a
    usual batch needs some tens of blocks: a lease is one file, and the rest of a batch's last block is not used.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = 100_000):
        if size < 1:
            raise ValueError("a block holds at least one id")
        self.spark, self.path, self.size = spark, path.rstrip("/"), size
        fs, p = io._fs(spark, self.path)
        fs.mkdirs(p)
        shapes = [n for n in io.list_names(spark, self.path) if n.startswith(_SHAPE)]
        if not shapes:
            _create(spark, f"{self.path}/{_SHAPE}={size}")
            shapes = [n for n in io.list_names(spark, self.path) if n.startswith(_SHAPE)]
        if shapes != [f"{_SHAPE}={size}"]:
            raise ValueError(f"{self.path} deals other blocks: {', '.join(shapes)}")

    def leased(self) -> list[int]:
        """Numbers of the blocks that some writer has leased."""
        return sorted(int(n[2:]) for n in io.list_names(self.spark, self.path) if n.startswith("b="))

    def lease(self, ids: int, above: int = 0) -> list[int]:
        """Lease blocks for that many ids, all above ``above``; their numbers, ascending but not always neighbours."""
        need = -(-ids // self.size)
        taken = self.leased() if need else []
        block = max(-(-above // self.size), taken[-1] + 1 if taken else 0)
        mine: list[int] = []
        while len(mine) < need:
            if _create(self.spark, f"{self.path}/b={block:012d}"):
                mine.append(block)
            block += 1
        return mine


def leased_ids(df: DataFrame, order_cols: list[str], blocks: IdBlocks, id_col: str = "id",
               stored: DataFrame | None = None, stored_id_col: str = "id") -> DataFrame:
    """``df`` with ids of leased blocks, ascending in ``order_cols``; no other writer gets any of them.

    Unlike ``continue_ids`` the ids may have gaps.  ``stored`` is a table whose ids were dealt before there were
    blocks: ids stay above its largest.  The rows are numbered and written once, so a later job or a lost executor
    sees the same ids.  The leases (one per ``size`` rows) are the only thing that passes through the driver.
    """
    spark = df.sparkSession
    numbered = materialize(dense_ids(df, order_cols, id_col="_place", start=0), "leased-rows")
    rows = numbered.agg(F.coalesce(F.max("_place") + 1, F.lit(0))).first()[0]
    above = 0 if stored is None else stored.agg(F.coalesce(F.max(stored_id_col), F.lit(0))).first()[0]
    mine = blocks.lease(int(rows), int(above))
    lease = spark.createDataFrame(list(enumerate(mine)), "_nth long, _block long")
    # one row per lease beside a block of rows each: left to AQE, which broadcasts it while it is small
    return (numbered.withColumn("_nth", F.floor(F.col("_place") / blocks.size).cast("long")).join(lease, "_nth")
            .withColumn(id_col, F.col("_block") * blocks.size + F.pmod("_place", F.lit(blocks.size)) + 1)
            .drop("_nth", "_block", "_place"))
