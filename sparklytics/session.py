"""Session helpers: the settings every operator relies on.

Operators never create a session themselves; they take DataFrames. These helpers
are for tests, the bench and command-line use, plus the one setting that is part
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"


def pin_utc(spark: SparkSession) -> None:
    """Date parts, day windows and dd-MM-yyyy labels are defined in UTC.  For programs that own their
    session; library functions only check it (``require_utc``)."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def require_utc(spark: SparkSession) -> None:
    """Raises unless the session's time zone is UTC: nobody else's session is changed silently."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in (UTC, "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}: dates and day windows are defined in UTC; "
                         "set it to UTC (sparklytics.session.pin_utc)")


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "sparklytics", extra: dict | None = None) -> SparkSession:
    """A session tuned for these workloads (local runs, tests, bench)."""
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.session.timeZone", UTC)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stream state.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).
    Only when nothing is configured *and* the master is local (tests, laptops) a fresh
    temporary folder is created; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: the server owns the checkpoint folder)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        conf_dir = tempfile.mkdtemp(prefix="sparklytics-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
