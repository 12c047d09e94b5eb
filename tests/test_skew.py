"""Hot keys are split: measured on the partitions that the window stages produce.

'GitHub' commits 20% of the stand-in commits.  A plain ``lag`` per committer puts all of them
in one shuffle partition; the bucket-split lag (A4) and the bucket-split existence check (C9)
spread a hot key over many partitions.
"""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparklytics.operators.ordering import previous_in_group
from sparklytics.sources.commits import commit_view

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def fixed_partitions(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _max_share(df, used: str) -> float:
    """Largest share of rows in one partition of ``df``; ``used`` is aggregated too so Catalyst
    cannot prune the stage that produces it."""
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(used)).collect()
    return max(r["n"] for r in per) / sum(r["n"] for r in per)


def test_hot_committer_is_split(spark, fixed_partitions):
    rows = commit_view(spark, SF).select(F.col("commit.committer.name").alias("name"),
                                         F.col("commit.committer.date").alias("date"), "sha")
    naive = rows.withColumn("prev", F.lag("date").over(Window.partitionBy("name").orderBy("date", "sha")))
    ours = previous_in_group(rows, ["name"], ["date", "sha"], ["date"], F.date_trunc("day", F.col("date")))
    assert _max_share(naive, "prev") >= 0.2
    assert _max_share(ours, "prev_date") < 0.08


def test_hot_file_is_reduced_map_side_and_exact(spark, fixed_partitions):
    from sparklytics.sources.commits import events_to_commits
    from sparklytics.streaming import queries as sq
    from .helpers import added_removed_pairs
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # every file event of the month on one (repository, filename): the hottest possible key
    hot = events_to_commits(ev).withColumn("url", F.lit("https://api.github.com/repos/o/r/commits/x")) \
        .withColumn("files", F.transform("files", lambda f: f.withField("filename", F.lit("hot.py"))))
    plan = sq.added_then_removed(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan.replace("window", "")
    for within in ("1 hour", "2 days"):
        assert sq.added_then_removed(hot, within).count() == added_removed_pairs(hot, within).count()
