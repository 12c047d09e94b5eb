"""Replay static tables through Structured Streaming.

A table is cut into time-ordered batches; rows without a timestamp belong to the first one.  One query runs
through the whole replay: a batch is written beside the source folder with the table's own parallelism, renamed into it
(the query sees all of it or nothing, so one batch is one micro-batch and the order of batches comes
from the runs, never from file times), and ``processAllAvailable`` waits for it.  Several tables can be replayed
side by side, each through its own folder, with their batches shifted against each other (``lag``).
A bounded source ends, but append-mode windows only close when the watermark passes them, so an
optional sentinel batch (one row far past the end) moves it past every real window, and is put once more so that a batch
runs with that watermark; the sentinel's own window never closes, so it never reaches the sink. Between batches of a
replay nothing is gained by Spark's batches without data, each of which commits all state: they are switched off for the query.  Source and state are removed when the query has
stopped; the sink holds the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir
from . import jobs

SENTINEL_GAP = "60 days"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


class Feed:
    """A folder that a running stream reads and that gets whole batches."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema, self.n = spark, path.rstrip("/"), schema, 0

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(f"{self.path}/batch-*")

    def put(self, rows: DataFrame) -> None:
        staging = f"{self.path}/.staging-{self.n}"
        rows.write.mode("overwrite").parquet(staging)
        jobs.rename(self.spark, staging, f"{self.path}/batch-{self.n:06d}")
        self.n += 1


def time_batches(rows: DataFrame, n_batches: int, ts: str, sentinel: bool = False, id_col: str | None = None) -> list[DataFrame]:
    """Every row is in exactly one batch; the sentinel, if any, is one more."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi, max_id = rows.agg(F.min(micros), F.max(micros), F.max(id_col) if id_col else F.lit(None)).first()
    if lo is None:  # no timestamps: one batch, and no window to close
        return [rows]
    cuts = [lo + (hi - lo) * i // n_batches for i in range(1, n_batches)]
    out = []
    for i in range(n_batches):
        inside = F.lit(True)
        if i:
            inside = inside & (micros >= cuts[i - 1])
        if i < n_batches - 1:
            inside = inside & (micros < cuts[i])
        out.append(rows.filter(inside if i else inside | F.col(ts).isNull()))
    if sentinel:
        one = rows.orderBy(F.col(ts).desc_nulls_last()).limit(1)
        one = one.withColumn(ts, F.col(ts) + F.expr(f"INTERVAL {SENTINEL_GAP}"))
        out.append(one.withColumn(id_col, F.lit(max_id + 1).cast(rows.schema[id_col].dataType)) if id_col else one)
    return out


def feed(query: StreamingQuery, feeds: Sequence[Feed], batches: Sequence[Sequence[DataFrame]], lag: Sequence[int] | None = None,
         again: bool = False) -> None:
    """Puts the batches of each feed in turn and waits until the query has run each round.  ``lag`` holds a
    feed's batches back by so many rounds; ``again`` puts each feed's last batch once more at the end.  The query is stopped in any case."""
    lag = lag or [0] * len(feeds)
    try:
        for i in range(max(len(b) + k for b, k in zip(batches, lag, strict=True))):
            for f, b, k in zip(feeds, batches, lag, strict=True):
                if 0 <= i - k < len(b):
                    f.put(b[i - k])
            query.processAllAvailable()
        if again:
            for f, b in zip(feeds, batches, strict=True):
                f.put(b[-1])
            query.processAllAvailable()
    finally:
        query.stop()


def _without_empty_batches(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Starts a query with Spark's batches without data switched off (a query keeps the settings it started with)."""
    before = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)


def replay_all(spark: SparkSession, tables: Sequence[tuple[T.StructType, Sequence[DataFrame]]], build: Callable[..., DataFrame], *,
               output_mode: str = "append", keys: list[str] | None = None, lag: Sequence[int] | None = None, sentinel: bool = False,
               workdir: str | None = None, keep: bool = False) -> DataFrame:
    """Runs ``build(stream, ...)`` as one streaming query, a stream for each of ``tables`` (schema, batches), and
    returns the sink's rows: of ``append`` the parquet sink's, of ``complete`` the last micro-batch's
    table, of ``update`` the latest row per ``keys``.  With ``sentinel``, each table's last batch is its sentinel.  ``keep`` leaves
    the sources and the state in place."""
    base = workdir or f"{checkpoint_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
    out, ckpt = f"{base}/sink", f"{base}/state"
    feeds = [Feed(spark, f"{base}/source-{i}", schema) for i, (schema, _) in enumerate(tables)]
    result = build(*[f.stream() for f in feeds])
    query = _without_empty_batches(spark, lambda: jobs.start(
        result, out, f"replay_{uuid.uuid4().hex[:8]}", output_mode=output_mode, keys=keys, trigger={"processingTime": "0 seconds"},
        checkpoint=ckpt))
    feed(query, feeds, [b for _, b in tables], lag, again=sentinel)
    if not keep:
        for path in (*[f.path for f in feeds], ckpt):
            jobs.remove(spark, path)
    if output_mode == "update":
        return jobs.read_latest(spark, out, keys)
    if output_mode == "complete":
        return jobs.read_complete(spark, out)
    return spark.read.schema(result.schema).parquet(out)


def replay(spark: SparkSession, events: DataFrame, build: Callable[[DataFrame], DataFrame], *,
           n_batches: int = 8, output_mode: str = "append", sentinel: bool = True, ts: str = "ts",
           id_col: str = "event_id", keys: list[str] | None = None, workdir: str | None = None,
           keep: bool = False) -> DataFrame:
    """``replay_all`` of one table, cut by ``ts``."""
    batches = time_batches(events, n_batches, ts, sentinel, id_col)
    closed = len(batches) > n_batches  # a table without timestamps has no sentinel
    return replay_all(spark, [(events.schema, batches)], build, output_mode=output_mode, keys=keys, sentinel=closed, workdir=workdir,
                      keep=keep)
