"""C3 and C4 as running counts: one record per event, with the count that its key has reached.

* ``running_counts`` on a static table is a segmented scan: rows are range-partitioned on (key, event order), counted
  within partitions, and a key that spans partitions gets the sum of those before; no window ever
  holds a whole key, although there are only a handful of keys.
* ``start`` does the same on a stream.  Each micro-batch is scanned together with one row per key that carries the
  total so far, which comes first in its key, so totals reach a hot key's many partitions without a join.  An epoch
  folder has the batch's records and the new totals; it is written beside its place and renamed into it, so a
  retry finds either nothing or all of it.  Within a batch the order is that of the events, and batches follow each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import constants as K
from ..functions import fields
from ..operators.ordering import segmented_scan
from ..session import checkpoint_dir
from . import jobs
from .queries import TS

ORDER = ["ts", "sha", "position"]
EVENT, WEIGHT, COUNT = "event__", "weight__", "count"


def extension_events(commits: DataFrame, exts=K.COUNTED_EXTENSIONS, with_status: bool = False) -> DataFrame:
    """(sha, ts, position, extension[, status]): one row per counted file; ``position`` is the file's place in its commit."""
    f = commits.select("sha", F.col(TS).alias("ts"), F.posexplode("files").alias("position", "f"))
    name = F.col("f.filename")
    wanted = F.lit(False)
    for e in exts:
        wanted = wanted | name.endswith("." + e)
    rows = f.filter(name.isNotNull() & wanted).select("sha", "ts", "position", fields.last_dot_part(name).alias("extension"),
                                                      F.col("f.status").alias("status"))
    return rows.filter(F.col("status").isNotNull()) if with_status else rows.drop("status")


def running_counts(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``events`` with ``count``: how many events of the same ``keys`` there are up to this one in ``order``."""
    scanned = segmented_scan(events.withColumn(WEIGHT, F.lit(1).cast("bigint")), keys, order, {COUNT: ("sum", WEIGHT)})
    return scanned.select(*events.columns, COUNT)


def running_extension_counts(commits: DataFrame, exts=K.COUNTED_EXTENSIONS) -> DataFrame:
    """C3, one record per event: (sha, ts, position, extension, count)."""
    return running_counts(extension_events(commits, exts), ["extension"], ORDER)


def running_extension_status_counts(commits: DataFrame, exts=K.STATUS_EXTENSIONS) -> DataFrame:
    """C4, one record per event: (sha, ts, position, extension, status, count)."""
    return running_counts(extension_events(commits, exts, with_status=True), ["extension", "status"], ORDER)


def _epoch(sink: str, n: int) -> str:
    return f"{sink.rstrip('/')}/epoch-{n:010d}"


def write_running(batch: DataFrame, sink: str, epoch: int, keys: list[str], order: list[str]) -> None:
    """One micro-batch: its records with running counts, and every key's total after it."""
    spark = batch.sparkSession
    if jobs.exists(spark, _epoch(sink, epoch)):
        return  # a retry: the epoch was complete
    before = [n for n in jobs.numbered(spark, sink, "epoch") if n < epoch]
    events = batch.withColumn(EVENT, F.lit(1)).withColumn(WEIGHT, F.lit(1).cast("bigint"))
    totals = spark.read.parquet(f"{_epoch(sink, before[-1])}/totals") if before else None
    if totals is not None:
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema.fields if f.name not in keys]
        carried = totals.select(*keys, *missing, F.lit(0).alias(EVENT), F.col(COUNT).alias(WEIGHT))
        events = events.unionByName(carried)
    staging = f"{sink.rstrip('/')}/.staging-{epoch}"
    scanned = segmented_scan(events, keys, [EVENT, *order], {COUNT: ("sum", WEIGHT)}).filter(F.col(EVENT) == 1)
    scanned.select(*batch.columns, COUNT).write.mode("overwrite").parquet(f"{staging}/records")
    reached = spark.read.parquet(f"{staging}/records").select(*keys, COUNT)
    if totals is not None:
        reached = reached.unionByName(totals.select(*keys, COUNT))
    reached.groupBy(*keys).agg(F.max(COUNT).alias(COUNT)).write.mode("overwrite").parquet(f"{staging}/totals")
    jobs.rename(spark, staging, _epoch(sink, epoch))


def start(events: DataFrame, sink: str, name: str, keys: list[str], order: list[str] | None = None, *, trigger: dict | None = None,
          checkpoint: str | None = None) -> StreamingQuery:
    """Starts the running counts of a stream of events; ``read`` gives the records."""
    spark = events.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    return (events.writeStream.queryName(name).option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .foreachBatch(lambda b, n: write_running(b, sink, n, keys, order or ORDER)).start())


def read(spark: SparkSession, sink: str) -> DataFrame:
    """All records so far."""
    return spark.read.parquet(*[f"{_epoch(sink, n)}/records" for n in jobs.numbered(spark, sink, "epoch")])
