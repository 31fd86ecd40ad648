"""Loading to a fixed schema (truncate and load)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.sources.io import write_snapshot


def conform(df: DataFrame, schema: T.StructType, as_text: bool = False) -> DataFrame:
    """B2: keep the schema's columns in schema order, cast to the schema type.

    Extra columns are dropped, missing ones become typed NULLs.  With
    ``as_text`` every incoming value is first cast to string (B5; NULL stays
    NULL, where pandas would write 'nan'), then to the schema type.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name).cast("string") if as_text else F.col(f.name)
            cols.append(c.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def to_text(df: DataFrame) -> DataFrame:
    """Every column cast to string."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def truncate_load(df: DataFrame, path: str, schema: T.StructType, as_text: bool = False) -> str:
    """Replace the table with the conformed rows in one snapshot write.

    The reference empties the table first and loads after, so a failed load
    leaves it empty; here the old version stays current until the new one
    is fully written.
    """
    return write_snapshot(conform(df, schema, as_text), path)
