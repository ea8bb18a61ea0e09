"""Session settings the library relies on, and the shared scratch location.

All event-time logic assumes the session time zone is UTC (dates and key text
depend on it) and that ANSI mode is on (bad casts raise instead of silently
becoming NULL).  AQE is on so that shuffle partition counts and join strategies
are re-planned from runtime statistics.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "eventmarts", extra: dict | None = None) -> SparkSession:
    """A session for tests and local runs. On a cluster, pass the cluster's own
    builder settings and call :func:`configure` on the session instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Skip capturing the Python call site of every Column/DataFrame call
        # (several JVM round trips each, only used for error context).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library's semantics depend on to a live session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  A local master (tests) may do without: one temporary folder
    is then chosen and registered, as driver and executor are one process.  On a
    cluster a machine-local folder would lose files, so its absence is an error.
    Paths are never reused; what is written there belongs to the run and goes
    with the folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="eventmarts-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)  # DataFrame.checkpoint() writes here
    return os.path.join(base, *parts, uuid.uuid4().hex)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: a table
    that survives lost executors, is scanned by column and cuts lineage."""
    path = shared_dir(df.sparkSession, "tables", name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
