"""Iteration over written tables: each round's result is a table in the shared checkpoint folder.

A written round cuts lineage for good (a lost executor re-reads it) and is deleted once the round after it is
complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..streaming.jobs import remove


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeat(state: DataFrame, step: Callable[[DataFrame], DataFrame], active: str, name: str = "round") -> tuple[DataFrame, int]:
    """Applies ``step`` to written tables until no row's ``active`` column is true; (last table, rounds)."""
    spark = state.sparkSession
    path = scratch(spark, name)
    now, rounds = written(state, path), 0
    while not now.filter(F.col(active)).isEmpty():
        before, path = path, scratch(spark, name)
        now, rounds = written(step(now), path), rounds + 1
        remove(spark, before)
    return now, rounds


def jump(links: DataFrame, name: str = "jump", closed: bool = False) -> tuple[DataFrame, int]:
    """Pointer jumping: where a walk along ``links`` (node, next) ends, and after how many steps.

    ``node`` is unique; a null ``next``, or one that is no node, ends the walk there (``closed``: every one is a node, or null,
    so this is not looked up).  Returns (node, last, steps) and the
    number of rounds, which is about log2 of the longest walk: a round replaces each pointer by the
    pointer of its target.  Nodes that have arrived are not joined again.  A target that very many nodes
    point to is one row on its side of the join, so AQE's skew join can split the other side.  Links must be
    free of cycles.
    """
    if closed:
        known = links.withColumn("_known", F.col("next").isNotNull())
    else:
        known = links.join(links.select(F.col("node").alias("next"), F.lit(True).alias("_known")), "next", "left")
    first = (known
             .select("node", F.when(F.col("_known"), F.col("next")).otherwise(F.col("node")).alias("last"),
                     F.when(F.col("_known"), 1).otherwise(0).cast("bigint").alias("steps"),
                     F.coalesce("_known", F.lit(False)).alias("moving")))

    def step(now: DataFrame) -> DataFrame:
        there = now.select(F.col("node").alias("last"), F.col("last").alias("_last"), F.col("steps").alias("_steps"),
                           F.col("moving").alias("_moving"))
        moved = (now.filter("moving").join(there, "last")
                 .select("node", F.col("_last").alias("last"), (F.col("steps") + F.col("_steps")).alias("steps"),
                         # the target had arrived: so has this node, one look later
                         F.col("_moving").alias("moving")))
        return moved.unionByName(now.filter("NOT moving"))
    done, rounds = repeat(first, step, "moving", name)
    return done.select("node", "last", "steps"), rounds
