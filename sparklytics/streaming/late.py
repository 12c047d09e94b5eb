"""Late rows made visible: nothing that arrives behind the watermark disappears silently.

Spark drops a row whose window is closed and only counts it.  Two tools:

* ``split``: a stream job ahead of the windowed operators.  Each micro-batch is written once, as an epoch folder of
  on-time rows and a side table of late ones: those whose event time is behind the watermark that the epochs
  before it left (the largest event time so far, less the allowed lateness).  The operators read the on-time rows as a
  stream (``on_time``).  Their own watermark can't be ahead of the split's, and Spark drops a row only if its whole window is
  behind, so they drop nothing: what they see and the side table are together exactly the input.
* ``dropped_rows``: how many rows a running or ended query's stateful operators dropped, for queries without a split in
  front of them; ``DropCounter`` is a listener that keeps the count for every query of a session.

An epoch folder is written beside its place and renamed into it with its counts (taken by ``observe`` while the rows are
written), so a retry of an epoch finds either nothing or all of it, and readers never see a part.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..session import checkpoint_dir
from . import jobs
from .queries import interval_seconds

BEHIND = "behind__"
COUNTS = "epoch bigint, rows bigint, late_rows bigint, watermark_us bigint, newest_us bigint"


def split(stream: DataFrame, sink: str, name: str, ts: str, lateness: str = "0 seconds", *, trigger: dict | None = None,
          checkpoint: str | None = None) -> StreamingQuery:
    """Starts the job that splits ``stream`` by its event time column ``ts`` (a null one is on time)."""
    spark = stream.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    return (stream.writeStream.queryName(name).option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .foreachBatch(lambda b, n: write_split(b, sink, n, ts, lateness)).start())


def _epoch(sink: str, n: int) -> str:
    return f"{sink.rstrip('/')}/epoch-{n:010d}"


def write_split(batch: DataFrame, sink: str, epoch: int, ts: str, lateness: str) -> None:
    spark = batch.sparkSession
    if jobs.exists(spark, _epoch(sink, epoch)):
        return  # a retry: the epoch was complete
    newest = _newest(spark, sink, epoch)
    mark = None if newest is None else newest - interval_seconds(lateness) * 1_000_000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    behind = F.lit(False) if mark is None else F.coalesce(us < mark, F.lit(False))
    seen = Observation()
    staging = f"{sink.rstrip('/')}/.staging-{epoch}"
    (batch.withColumn(BEHIND, behind)
     .observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(BEHIND).alias("late"), F.max(us).alias("newest"))
     .write.mode("overwrite").partitionBy(BEHIND).parquet(f"{staging}/rows"))
    got = seen.get
    newest = max((x for x in (newest, got["newest"]) if x is not None), default=None)
    spark.createDataFrame([(epoch, got["rows"], got["late"], mark, newest)], COUNTS).coalesce(1) \
        .write.mode("overwrite").parquet(f"{staging}/counts")
    jobs.rename(spark, staging, _epoch(sink, epoch))


def _newest(spark: SparkSession, sink: str, epoch: int) -> int | None:
    """The largest event time of the epochs before this one: the newest of them carries it on."""
    before = [n for n in jobs.numbered(spark, sink, "epoch") if n < epoch]
    if not before:
        return None
    return spark.read.schema(COUNTS).parquet(f"{_epoch(sink, before[-1])}/counts").first()["newest_us"]


def on_time(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """The on-time rows as a stream."""
    return spark.readStream.schema(schema).parquet(f"{sink.rstrip('/')}/epoch-*/rows/{BEHIND}=false")


def late_rows(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """The side table: late rows with the epoch in which they came."""
    wide = T.StructType([*schema.fields, T.StructField(BEHIND, T.BooleanType())])
    paths = [f"{_epoch(sink, n)}/rows" for n in jobs.numbered(spark, sink, "epoch")]
    rows = spark.createDataFrame([], wide)
    for path in paths:  # each with a base of its own: the folder of the flag is a column
        rows = rows.unionByName(spark.read.schema(wide).parquet(path))
    number = F.regexp_extract(F.input_file_name(), r"/epoch-(\d+)/", 1).cast("bigint")
    return rows.filter(BEHIND).withColumn("epoch", number).drop(BEHIND)


def counts(spark: SparkSession, sink: str) -> DataFrame:
    """Per epoch: rows, late rows, the watermark they were compared with and the newest event time so far (microseconds)."""
    paths = [f"{_epoch(sink, n)}/counts" for n in jobs.numbered(spark, sink, "epoch")]
    return spark.read.schema(COUNTS).parquet(*paths) if paths else spark.createDataFrame([], COUNTS)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators dropped as late, over the progress reports that it keeps."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


class DropCounter(StreamingQueryListener):
    """``spark.streams.addListener(DropCounter())``: ``dropped`` has the late rows dropped per query name."""

    def __init__(self):
        self.dropped: Counter = Counter()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.dropped[p.name] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
