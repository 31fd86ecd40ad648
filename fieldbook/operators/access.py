"""User access lookup: id -> user record and a valid / not valid status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Status labels.
VALID = "valid"
NOT_VALID = "not valid"


def dedupe_last(user_access: DataFrame, order_col: str, key: str = "CWID") -> DataFrame:
    """One record per key; the last by ``order_col`` wins (a dict keeps the last seen).

    A NULL order value comes before all others; ties go to the greatest
    record.  ``max_by`` is a partially aggregated groupBy, so a key repeated
    across a third of the table costs one row per map task in the shuffle.
    """
    others = [c for c in user_access.columns if c != key]
    rec = F.struct(*[F.col(c) for c in others])
    order = F.col(order_col)
    last = F.max_by(rec, F.struct(order.isNotNull(), order, rec))
    return user_access.groupBy(key).agg(last.alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in others])


def lookup(ids: DataFrame, user_access: DataFrame, order_col: str, id_col: str = "CWID", key: str = "CWID",
           status_col: str = "status") -> DataFrame:
    """Every requested id with its user record (NULLs when unknown) and a status."""
    users = dedupe_last(user_access, order_col, key).drop(order_col)
    u = users.withColumnRenamed(key, "_key")
    out = ids.join(u, ids[id_col] == u["_key"], "left")
    return out.withColumn(status_col, F.when(F.col("_key").isNotNull(), F.lit(VALID)).otherwise(F.lit(NOT_VALID))).drop("_key")

