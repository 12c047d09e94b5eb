"""B11 stable 64-bit ids and B12 the developer-repository graph as two DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields


def md5_long_id(s: Column) -> Column:
    """md5 hex of ``s`` without leading zeros, hashed again as a version-3 name UUID;
    the id is the UUID's most significant 64 bits (a signed bigint).

    The UUID's high half is the first 16 hex digits of md5(hex) with the version nibble set to 3.
    """
    h = F.md5(F.regexp_replace(F.md5(s), "^0+", ""))
    top = F.concat(F.substring(h, 1, 12), F.lit("3"), F.substring(h, 14, 3))
    return F.conv(top, 16, -10).cast("bigint")


def _pairs(commits: DataFrame, use_full_name: bool) -> DataFrame:
    pairs = commits.select(F.col("commit.committer.name").alias("developer"),
                           fields.repo_key("url", use_full_name).alias("repository"))
    return pairs.filter(F.col("developer").isNotNull() & F.col("repository").isNotNull()).distinct()


def developer_repo_graph(commits: DataFrame, use_full_name: bool = False) -> tuple[DataFrame, DataFrame]:
    """(vertices(id, kind, name), edges(src, src_kind, dst, dst_kind, relation)); an edge per
    committer -> repository.  A vertex is identified by (id, kind): ``id`` is B11's id of the name alone,
    and a developer and a repository may have the same name."""
    pairs = _pairs(commits, use_full_name)
    devs = pairs.select(F.col("developer").alias("name")).distinct().withColumn("kind", F.lit("developer"))
    repos = pairs.select(F.col("repository").alias("name")).distinct().withColumn("kind", F.lit("repository"))
    vertices = devs.unionByName(repos).select(md5_long_id(F.col("name")).alias("id"), "kind", "name")
    edges = pairs.select(md5_long_id(F.col("developer")).alias("src"), F.lit("developer").alias("src_kind"),
                         md5_long_id(F.col("repository")).alias("dst"), F.lit("repository").alias("dst_kind"),
                         F.lit("committed_to").alias("relation"))
    return vertices, edges


def graph_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree of every vertex of a (vertices, edges) pair (out-degree of developers, in-degree of
    repositories)."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.col("src_kind").alias("kind")),
        F.struct(F.col("dst").alias("id"), F.col("dst_kind").alias("kind")))).alias("v"))
    deg = ends.groupBy("v.id", "v.kind").agg(F.count(F.lit(1)).alias("degree"))
    return vertices.join(deg, ["id", "kind"], "left").select("id", "kind", "name",
                                                             F.coalesce("degree", F.lit(0)).alias("degree"))


def developer_repo_degrees(commits: DataFrame, use_full_name: bool = False) -> DataFrame:
    """B12 as one table: every vertex (id, kind, name) with its degree, from a single pass over the
    distinct committer-repository pairs (each pair counts once for both of its ends)."""
    ends = _pairs(commits, use_full_name).select(F.explode(F.array(
        F.struct(F.col("developer").alias("name"), F.lit("developer").alias("kind")),
        F.struct(F.col("repository").alias("name"), F.lit("repository").alias("kind")))).alias("v"))
    deg = ends.groupBy("v.name", "v.kind").agg(F.count(F.lit(1)).alias("degree"))
    return deg.select(md5_long_id(F.col("name")).alias("id"), "kind", "name", "degree")
