"""Summary statistics and set comparison of results.

``summary_state`` reduces a column in one pass to a small row: count, mean, sum of squared deviations, smallest, largest and
a KLL quantile sketch.  States are mergeable (``merge_states``), so a table's summary can be kept per day or
per file and combined later; ``describe`` reads the statistics off a state.  ``common_rows`` is the
intersection of two multisets, null-safe, from one aggregation of counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_K = 4096  # ranks are exact up to about this many values, and within 0.1% of the count beyond
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def summary_state(df: DataFrame, column: str, keys: Sequence[str | Column] = (), k: int = SKETCH_K) -> DataFrame:
    """(keys, n, mean, m2, low, high, sketch) of an integral column; nulls are not counted.  A group without values has
    n = 0 and nulls."""
    v = F.col(column).cast("bigint")
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_bigint(v, k).alias("sketch"))


def merge_states(states: DataFrame, keys: Sequence[str | Column] = ()) -> DataFrame:
    """One state per ``keys``.  Deviations are merged pairwise around the means, which does not cancel large values;
    the list folded here has a row per stored state."""
    held = states.filter(F.col("n") > 0)
    part = F.struct("n", "mean", "m2")
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))
    names = [k if isinstance(k, str) else k._jc.toString() for k in keys]
    merged = held.groupBy(*keys).agg(F.aggregate(F.sort_array(F.collect_list(part)), zero, add).alias("_all"), F.min("low").alias("low"),
                                     F.max("high").alias("high"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    none = F.col("_all.n") == 0
    return merged.select(*names, "_all.n", F.when(~none, F.col("_all.mean")).alias("mean"), F.when(~none, F.col("_all.m2")).alias("m2"),
                         "low", "high", "sketch")


def describe(states: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """(keys, count, mean, stddev, min, max and quantiles) of states; ``stddev`` is the sample's, null below two values."""
    quantiles = QUANTILES if quantiles is None else quantiles
    own = [c for c in states.columns if c not in ("n", "mean", "m2", "low", "high", "sketch")]
    has = F.col("n") > 0
    return states.select(
        *own, F.col("n").alias("count"), "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev"),
        F.col("low").alias("min"), F.col("high").alias("max"),
        *[F.when(has, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))).alias(name) for name, q in quantiles.items()])


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns of ``left`` and ``n``: how often each row that both tables have is in their multiset
    intersection (the smaller of its counts).  Nulls equal nulls.  Columns are matched by position and take their
    names from ``left``; a column of ``left`` may have any name but ``in_left__`` and ``in_right__``.

    One aggregation over both: counts are partial before the shuffle, so a row that is there very often is a
    row of each task, and nothing is joined."""
    names = left.columns
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = (left.select(*names, one.alias("in_left__"), none.alias("in_right__"))
            .union(right.toDF(*names).select(*names, none.alias("in_left__"), one.alias("in_right__"))))
    counted = both.groupBy(*names).agg(F.sum("in_left__").alias("in_left__"), F.sum("in_right__").alias("in_right__"))
    return (counted.filter((F.col("in_left__") > 0) & (F.col("in_right__") > 0))
            .select(*names, F.least("in_left__", "in_right__").alias("n")))
