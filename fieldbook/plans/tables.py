"""Loading the driver's test tables with column pruning at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written_input(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A stand-in input table built from the test tables and written under the checkpoint folder.

    Every call builds and writes it again, so a repeated query does the same
    work and never reads rows of an earlier state of the tables.
    """
    from fieldbook.session import materialize

    return materialize(build(), f"input-{name}")
