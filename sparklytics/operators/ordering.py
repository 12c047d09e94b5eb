"""Order-dependent building blocks that stay distributed.

* ``global_rank``: a zero-based position over the whole DataFrame without the single-task
  window that ``row_number().over(Window.orderBy(...))`` plans.  Rows are range-partitioned
  and sorted, the result is checkpointed when the query first runs (so partition contents and order are fixed), each
  partition is counted, and the per-partition start offsets (one row per partition: a
  bounded broadcast) are added to the position inside the partition.
* ``previous_in_group``: the previous row of the same key in a given order (``lag``), with
  hot keys split by a time bucket.  The window runs per (key, bucket); the first row of a
  bucket takes the last row of the key's previous non-empty bucket, found on the small
  per-bucket aggregate.
* ``segmented_scan``: running sums, minima or maxima per key without a window over a whole key. Rows are
  range-partitioned on (key, order), so a hot key spans many partitions; each partition's part of
  a key is scanned by itself, and what the key has in the partitions before (at most one row per
  partition, because only the key that a partition starts with can go on) is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index in partition


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Append ``rank_col`` = 0-based index of each row in ``order`` (which must be total)."""
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=False)
    ided = ranged.withColumn("_mid", F.monotonically_increasing_id())
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = ided.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the prefix sum runs in one task over a bounded number of rows
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    out = ided.join(F.broadcast(offsets), pid == F.col("_pid"))
    return out.select(*[F.col(c) for c in df.columns], (F.col("_off") + pos).alias(rank_col))


def previous_in_group(df: DataFrame, keys: list[str], order: list[str], carry: list[str],
                      bucket: Column, prefix: str = "prev_") -> DataFrame:
    """For each row, the ``carry`` columns of the previous row of the same ``keys`` in ``order``.

    ``bucket`` must be monotone in ``order`` (e.g. the day of the timestamp that leads the order);
    it only limits how much of one key a single task sorts.  Columns ``prefix + c`` are null for
    the first row of a key.
    """
    b = "_bucket"
    x = df.withColumn(b, bucket)
    row = F.struct(*[F.col(c) for c in order + [c for c in carry if c not in order]])
    w = Window.partitionBy(*keys, b).orderBy(*order)
    x = x.withColumn("_prev", F.lag(row, 1).over(w))
    last = x.groupBy(*keys, b).agg(F.max(row).alias("_last"))
    last = last.select(*keys, b, F.lag("_last", 1).over(Window.partitionBy(*keys).orderBy(b)).alias("_bprev"))
    # null-safe: null keys and null buckets form groups of their own
    last = last.select(*[F.col(c).alias("_l" + c) for c in keys + [b]], "_bprev")
    same = F.lit(True)
    for c in keys + [b]:
        same = same & F.col(c).eqNullSafe(F.col("_l" + c))
    y = x.join(last, same, "left")
    prev = F.coalesce(F.col("_prev"), F.col("_bprev"))
    return y.select(*[F.col(c) for c in df.columns], *[prev.getField(c).alias(prefix + c) for c in carry])


_MERGE = {"sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
          "min": (F.min, F.least), "max": (F.max, F.greatest)}


def segmented_scan(df: DataFrame, keys: list[str], order: list[str], scans: dict[str, tuple[str, str]],
                   inclusive: bool = True, descending: bool = False) -> DataFrame:
    """Appends a running aggregate per ``keys`` in ``order`` for each of ``scans``: name -> (how, column).

    ``how`` is ``sum``, ``min`` or ``max``.  Each row's value covers the key's rows up to the row itself
    (``inclusive``) or before it; an empty ``sum`` is 0, an empty ``min`` or ``max`` null.  Null keys are a key of their own and nulls
    lead the order (they end it with ``descending``).  ``order`` must be total within a key, up to equal rows.
    """
    checkpoint_dir(df.sparkSession)
    cols = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    # the partition number is stored with the rows, so later shuffles don't change it
    ranged = df.repartitionByRange(*keys, *cols).withColumn("_part", F.spark_partition_id()).checkpoint(eager=False)
    per = ranged.groupBy("_part", *keys).agg(*[_MERGE[how][0](c).alias(n) for n, (how, c) in scans.items()])
    parts = Window.partitionBy(*keys).orderBy("_part")  # one row per partition that has the key
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(F.col("_part").alias("_cpart"), *[F.col(k).alias("_c" + k) for k in keys],
                       *[_MERGE[how][0](n).over(before).alias("_c" + n) for n, (how, _) in scans.items()],
                       F.lag("_part").over(parts).alias("_from")).filter(F.col("_from").isNotNull())
    same = F.col("_part") == F.col("_cpart")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_c" + k))
    within = Window.partitionBy("_part", *keys).orderBy(*cols).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    out = ranged.join(F.broadcast(carry), same, "left")  # at most one row per partition
    return out.select(*df.columns, *[_MERGE[how][1](F.col("_c" + n), _MERGE[how][0](c).over(within)).alias(n)
                                     for n, (how, c) in scans.items()])
