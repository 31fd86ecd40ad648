"""Dense, ordered ids without funnelling rows through one task.

``row_number()`` over an unpartitioned window sends every row to a single
partition.  ``dense_ids`` instead range-partitions the rows on the full order
key, numbers rows inside each range in parallel, and adds the running count
of the ranges before it.  Any range cut is exact, so the sampled bounds only
affect balance, never the ids.  The max of an existing id column is a scalar
subquery; the per-range offsets (one row per range, a structural size bound)
are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_fb_bucket"
_RN = "_fb_rn"
_OFF = "_fb_off"


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "id",
              start: int | Column = 1, buckets: int | None = None,
              partition_by: list[str] | None = None) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ascending order of ``order_cols``.

    With ``partition_by`` the numbering restarts at ``start`` in every group
    (NULL is a group of its own), so several id sequences are drawn in one
    pass.  ``order_cols`` must identify a row within its group (ties get an
    arbitrary but valid order).  NULLs sort first, as in Spark's ascending
    order.

    How: ``repartitionByRange`` over (groups, order columns) - range bounds
    come from a sample of whole keys, so even a heavy leading value is split
    by the later columns - then ``sortWithinPartitions``; each row's index in
    its range is ``monotonically_increasing_id`` minus the range's first
    one.  The tagged rows are written once (checkpoint folder) before they
    are read twice - for the per-range counts (one row per range and group
    run, broadcast when ungrouped) and for the ids.  The write is required:
    the range bounds come from a seeded sample whose seed differs between
    two executions of the same plan, so recomputing the tagging for the
    counts could cut different ranges than the numbering.
    """
    parts = list(partition_by or [])
    keys = [F.col(c).asc_nulls_first() for c in parts + list(order_cols)]
    # without a number, adaptive execution merges neighbouring small ranges
    ranged = df.repartitionByRange(*keys) if buckets is None else df.repartitionByRange(max(1, int(buckets)), *keys)
    tagged = (
        ranged
        .sortWithinPartitions(*keys)
        .withColumn(_B, F.spark_partition_id())
        .withColumn(_RN, F.monotonically_increasing_id())
    )
    from fieldbook.session import materialize as _mat
    tagged = _mat(tagged, "ids")
    # rows of one (range, group) are contiguous in the sorted range, so the
    # smallest tag of the run is the run's first row
    counts = tagged.groupBy(_B, *parts).agg(F.count(F.lit(1)).alias("_fb_n"), F.min(_RN).alias("_fb_m0"))
    before = (Window.partitionBy(*parts) if parts else Window).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_B, *parts, "_fb_m0", F.coalesce(F.sum("_fb_n").over(before), F.lit(0)).alias(_OFF))
    if parts:
        joined = _join_on(tagged, offsets, [_B] + parts)
    else:
        # one row per range (<= buckets rows): safe to broadcast
        joined = tagged.join(F.broadcast(offsets), _B)
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        joined.withColumn(id_col, (F.col(_OFF) + (F.col(_RN) - F.col("_fb_m0")) + start_col.cast("long")).cast("long"))
        .drop(_B, _RN, _OFF, "_fb_m0")
    )


def _join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` with NULL = NULL, keeping the left's key columns."""
    r = right.select(*[F.col(k).alias("_j_" + k) for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r["_j_" + k])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "inner").drop(*["_j_" + k for k in keys])


def max_id(existing: DataFrame, id_col: str = "id") -> Column:
    """``coalesce(max(id), 0)`` of a table as a scalar subquery column."""
    return existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_fb_max")).scalar()


def continue_ids(df: DataFrame, order_cols: list[str], existing: DataFrame,
                 id_col: str = "id", existing_id_col: str = "id",
                 buckets: int | None = None) -> DataFrame:
    """Ids max(existing.id)+1, +2, ... over ``order_cols`` (empty table -> 1..n)."""
    return dense_ids(df, order_cols, id_col=id_col,
                     start=max_id(existing, existing_id_col) + F.lit(1), buckets=buckets)


def read_order(df: DataFrame, seq: str = "seq", file_col: str = "_file", start_col: str = "_start",
               max_files: int | None = None) -> DataFrame:
    """Number rows 1..n in the order they were read: (file, split start, row in split).

    ``file_col`` / ``start_col`` come from ``_metadata.file_path`` and
    ``_metadata.file_block_start``.  Inside one task rows of a split arrive in
    file order, which ``monotonically_increasing_id`` keeps; ``dense_ids``
    writes the rows once, so the numbering is fixed before any later join
    and a retried task cannot reshuffle it.  Files are ranked with a plain
    window when ``max_files`` bounds their number (micro-batches), else with
    ``dense_ids`` over the distinct file names.
    """
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    files = tagged.select(file_col).distinct()
    if max_files is not None:
        ranked = files.withColumn("_frank", F.row_number().over(Window.orderBy(file_col)))
        tagged = tagged.join(F.broadcast(ranked), file_col)
    else:
        ranked = dense_ids(files, [file_col], id_col="_frank")
        tagged = tagged.join(ranked, file_col)
    return dense_ids(tagged, ["_frank", start_col, "_mid"], id_col=seq).drop("_frank", start_col, "_mid", file_col)
