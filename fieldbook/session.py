"""SparkSession construction and shared-folder helpers.

Cluster settings (shuffle partitions, AQE, checkpoint folder) come from the
session that the cluster hands us.  Only when a setting is missing, as in
tests on ``local[N]``, do we fill in a local default.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied only when the session does not carry a value already.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "fieldbook",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench.

    On a cluster ``SparkSession.getActiveSession()`` is already there and
    nothing of its configuration is overridden.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_defaults(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    """Set our defaults only where the session has no value."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; a local test session without one gets a fresh
    scratch folder so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="fieldbook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def tasks_for(spark: SparkSession, size: int, per_task: int) -> int:
    """Shuffle partitions for ``size`` rows (or characters): the session's number, or more so that none gets over ``per_task``.

    A session's number is fixed while tables grow, and with it what one task
    has to sort or hold.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // per_task))


def materialize(df, name: str = "table"):
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint
    folder and read it back.

    Used where one intermediate feeds several plans (exploded lists, inputs
    of ``dense_ids``).  One computation (an RDD checkpoint would compute it
    twice), files that survive executor loss, and a scan with real size
    statistics for AQE's join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"fieldbook-tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
