"""Spark session and checkpoint-folder helpers.

The library never creates machine-local folders on a cluster: the reliable
checkpoint folder is read from the session (``spark.checkpoint.dir``) and a
temporary folder is only made when the session runs in local mode and nothing
is configured (tests, benches).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "yieldlab",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only when unset.

    Order: folder already set on the context, then ``spark.checkpoint.dir``
    from the session conf, then (local mode only) a fresh temporary folder.
    On a cluster without a configured shared folder this raises instead of
    silently using a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(e.g. on the cluster file system) before running ordered operators"
            )
        base = os.environ.get("TMPDIR", "/tmp")
        configured = tempfile.mkdtemp(prefix="yieldlab-ckpt-", dir=base)
    sc.setCheckpointDir(configured)
    return configured


def shuffle_partitions(spark: SparkSession) -> int:
    """Configured shuffle parallelism (used to size range partitions)."""
    try:
        return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    except (TypeError, ValueError):
        return 200


_WRITTEN: list[str] = []  # folders written by materialize() in this process


def materialize(df, label: str = "table"):
    """Write ``df`` once as Parquet under the checkpoint folder and read it
    back: the lineage is cut, the data is computed exactly once (unlike an
    eager ``Dataset.checkpoint``, which computes it a second time to write),
    and later reads get column pruning and filter pushdown."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"yieldlab-{label}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


SMALL_SIDE_ROWS = 1_000_000


def small_side(df, label: str = "side", rows: int = SMALL_SIDE_ROWS):
    """A written table for the narrow side of a join with long data (one row
    per sensor, say): broadcast if it has at most ``rows`` rows by count, so
    that the long side isn't shuffled; else joined by a shuffle, whose hot
    keys adaptive execution splits."""
    from pyspark.sql import functions as F

    written = materialize(df, label)
    return F.broadcast(written) if written.count() <= rows else written


def drop_materialized(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote with ``materialize``
    (call it when no DataFrame built on them is needed any more). Uses the
    Hadoop file system of each path, so it works on any cluster storage.
    Returns the number of folders removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        if path.getFileSystem(conf).delete(path, True):
            removed += 1
    return removed
