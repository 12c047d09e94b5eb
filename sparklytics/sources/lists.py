"""Integer lists from ``lineitem`` (FIXTURES.md §4.3).

A list is one order: its quantities ordered by the line's file sha (a unique, stable key).
Long form (list_id, pos, value, opt_value) and array form (list_id, xs, oxs); ``opt_value`` /
``oxs`` hold the "optional number" variant (undefined for open lines, status 'O').
The array form groups at most the lines of one order, a bounded group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_linestatus")
    key = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey",
                                                                       "l_linenumber")],
                            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")))
    q = F.col("l_quantity").cast("bigint")
    return li.select(F.col("l_orderkey").alias("list_id"), key.alias("item_key"), q.alias("value"),
                     F.when(F.col("l_linestatus") != "O", q).alias("opt_value"),
                     F.col("l_linestatus").alias("grp"), F.col("l_suppkey").alias("supp"))


def order_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(list_id, xs, oxs, xss): one aggregation per order; ``xss`` nests the values by line status
    (F before O).  Unused columns are pruned by Catalyst, so plain list queries never build ``xss``."""
    items = order_items(spark, sf_dir)
    g = items.groupBy("list_id").agg(F.sort_array(F.collect_list(F.struct("item_key", "value", "opt_value", "grp")))
                                     .alias("_it"))
    groups = F.array_sort(F.array_distinct(F.transform("_it", lambda s: s["grp"])))
    xss = F.transform(groups, lambda gr: F.transform(F.filter("_it", lambda s: s["grp"] == gr), lambda s: s["value"]))
    return g.select("list_id", F.transform("_it", lambda s: s["value"]).alias("xs"),
                    F.transform("_it", lambda s: s["opt_value"]).alias("oxs"), xss.alias("xss"))


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(student_id, pos, grade): a student per order, grade = quantity % 11 (0..10)."""
    items = order_items(spark, sf_dir)
    return items.select(F.col("list_id").alias("student_id"), F.col("item_key").alias("pos"),
                        (F.col("value") % 11).alias("grade"))
