"""Long-running stream jobs: a stream query from ``streaming.queries`` to a durable sink.

State and progress live under the session's checkpoint folder (``spark.checkpoint.dir``), so
a restarted driver or lost executors resume from the last committed micro-batch.  Sinks of changing
results keep each micro-batch in a folder of its own, ``epoch-N``, which a retry of the same batch writes
again; a folder counts once its ``_SUCCESS`` file is there, so readers never see half a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir

COMPACT_EVERY = 16  # epochs of an ``update`` sink between two snapshots


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a finished folder into place, so that readers see all of it or nothing."""
    fs, p = _folder(spark, path)
    if not fs.rename(p, _folder(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def numbered(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the ``kind-N`` folders, ascending."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.rsplit("-", 1)[1]) for n in names if n.startswith(kind + "-"))


def _finished(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete ``kind-N`` folders, ascending."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if name.startswith(kind + "-") and fs.exists(done):
            found.append(int(name.rsplit("-", 1)[1]))
    return sorted(found)


def _name(path: str, kind: str, n: int) -> str:
    return f"{path}/{kind}-{n:010d}"


def start(result: DataFrame, sink_path: str, name: str, *, output_mode: str = "append",
          keys: list[str] | None = None, trigger: dict | None = None,
          checkpoint: str | None = None) -> StreamingQuery:
    """Start ``result`` (a streaming DataFrame) writing parquet at ``sink_path``.

    * ``append``: rows are final when emitted (windowed aggregates after the watermark passes,
      joins, stateless queries).
    * ``complete``: each micro-batch writes the whole (small, keyed) result table anew;
      ``read_complete`` gives the newest complete one, the one before it is kept for running readers.
    * ``update``: each micro-batch writes its changed rows; every ``COMPACT_EVERY`` epochs they are
      reduced to the newest row per key.  ``read_latest`` gives the current value per key.
    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: ``processingTime='1 minute'``).
    """
    spark = result.sparkSession
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = result.writeStream.queryName(name).option("checkpointLocation", ckpt) \
        .trigger(**(trigger or {"processingTime": "1 minute"}))
    if output_mode == "append":
        return w.outputMode("append").format("parquet").option("path", sink_path).start()
    if output_mode == "complete":
        return w.outputMode("complete").foreachBatch(lambda b, n: write_complete(b, sink_path, n)).start()
    if output_mode == "update":
        if not keys:
            raise ValueError("update mode needs the result keys")
        return w.outputMode("update").foreachBatch(lambda b, n: write_update(b, sink_path, n, keys)).start()
    raise ValueError(output_mode)


def write_complete(batch: DataFrame, sink_path: str, epoch: int) -> None:
    batch.write.mode("overwrite").parquet(_name(sink_path, "epoch", epoch))
    for old in _finished(batch.sparkSession, sink_path, "epoch"):
        if old < epoch - 1:
            remove(batch.sparkSession, _name(sink_path, "epoch", old))


def write_update(batch: DataFrame, sink_path: str, epoch: int, keys: list[str], compact_every: int = COMPACT_EVERY) -> None:
    spark = batch.sparkSession
    batch.withColumn("_epoch", F.lit(epoch).cast("bigint")).write.mode("overwrite").parquet(_name(sink_path, "epoch", epoch))
    if epoch and epoch % compact_every == 0:
        before = _finished(spark, sink_path, "snapshot")
        _latest(spark, sink_path, keys, epoch).write.mode("overwrite").parquet(_name(sink_path, "snapshot", epoch))
        # what the snapshot before this one covers is no longer read
        covered = max([n for n in before if n < epoch], default=-1)
        for kind, limit in (("epoch", covered + 1), ("snapshot", covered)):
            for n in _finished(spark, sink_path, kind):
                if n < limit:
                    remove(spark, _name(sink_path, kind, n))


def _latest(spark: SparkSession, sink_path: str, keys: list[str], until: int | None = None) -> DataFrame:
    """Newest row per key, with its epoch, from the newest snapshot and the epochs after it."""
    snapshots = [n for n in _finished(spark, sink_path, "snapshot") if until is None or n < until]
    base = snapshots[-1] if snapshots else -1
    epochs = [n for n in _finished(spark, sink_path, "epoch") if n > base and (until is None or n <= until)]
    paths = [_name(sink_path, "snapshot", base)] * (base >= 0) + [_name(sink_path, "epoch", n) for n in epochs]
    df = spark.read.parquet(*paths)
    values = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), "_epoch").alias("_v"))
    return latest.select(*keys, *[F.col("_v")[c].alias(c) for c in values])


def read_latest(spark: SparkSession, sink_path: str, keys: list[str]) -> DataFrame:
    """Current table of an ``update``-mode sink: the newest row per key."""
    return _latest(spark, sink_path, keys).drop("_epoch")


def read_complete(spark: SparkSession, sink_path: str) -> DataFrame:
    """Current table of a ``complete``-mode sink."""
    return spark.read.parquet(_name(sink_path, "epoch", _finished(spark, sink_path, "epoch")[-1]))
