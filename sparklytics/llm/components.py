"""Connected components of a link table, by stars.

Every round makes the links of each node point at the smallest node it knows: first its larger
neighbours (large star), then its smaller ones and itself (small star).  Paths shrink to about half
their length a round, so a chain of n nodes takes in the order of log2(n) rounds.  A round is two salted
reductions and a written table; the table before it is deleted once the new one is complete.  No task
sees all links of a node, and nothing but two numbers a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.jobs import remove
from .common import parts, release, scratch, with_group_first, written

SHARE = 8  # links are a small part of the texts that partitions are sized for: fewer files a round


def _state(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    both = F.xxhash64("u", "v")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.shiftright(both, 24)), F.bit_xor(both)).first())


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) of every node that a smaller one can be reached from; ``root`` is the smallest of them (and has no row
    of its own).

    ``links`` has two columns of one orderable type (numbers, or structs of them); repeated links, links of a node to
    itself and both directions are allowed, rows with a null are ignored.  A table without links gives no rows."""
    spark = links.sparkSession
    path, few = scratch(spark, "stars"), max(1, parts(spark) // SHARE)
    now = written(links.filter(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct().coalesce(few), path)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (with_group_first(both, ["u"], ["v"], singles=True).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "first.v").alias("v")).distinct())
        small = with_group_first(large, ["u"], ["v"], singles=True)
        least = F.col("v") == F.col("first.v")  # the node itself; the others are handed to the least one
        new = small.select(F.when(least, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("first.v").alias("v")).distinct().coalesce(few)
        before, path = path, scratch(spark, "stars")
        now, last = written(new, path), state
        state = _state(now)
        remove(spark, before)
        if state == last:
            break
    release(spark)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
