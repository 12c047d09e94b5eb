
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields
from .ordering import previous_in_group

_CDATE = "commit.committer.date"
_CNAME = "commit.committer.name"


def commits_by_authors(commits: DataFrame, authors: Sequence[str] | DataFrame) -> DataFrame:
    """A1: (committer, sha, timestamp) of commits whose committer is listed, oldest first."""
    rows = commits.select(F.col(_CNAME).alias("committer"), "sha", F.col(_CDATE).alias("timestamp"))
    return fields.keep_names(rows, "committer", authors).orderBy("timestamp", "sha")


def weekly_commits_per_repo(commits: DataFrame, iso_year: bool = False, use_full_name: bool = False) -> DataFrame:
    """A2: (repository, week, year, count); ISO week with calendar year unless ``iso_year``."""
    ts = F.col(_CDATE)
    year = F.extract(F.lit("YEAROFWEEK"), ts) if iso_year else F.year(ts)
    return (commits.select(fields.repo_key("url", use_full_name).alias("repository"),
                           F.weekofyear(ts).alias("week"), year.alias("year"))
            .groupBy("repository", "week", "year").agg(F.count(F.lit(1)).alias("count")))


def _epoch(snapshot) -> int:
    if isinstance(snapshot, str):
        snapshot = _dt.datetime.fromisoformat(snapshot.replace("Z", "+00:00"))
    if snapshot.tzinfo is None:
        snapshot = snapshot.replace(tzinfo=_dt.timezone.utc)
    return int(snapshot.timestamp())


def commit_age_seconds(commits: DataFrame, snapshot) -> DataFrame:
    """A3: the input plus ``age`` = snapshot epoch seconds - commit epoch seconds."""
    return commits.withColumn("age", F.lit(_epoch(snapshot)).cast("bigint") - F.unix_seconds(F.col(_CDATE)))


def days_since_previous_commit(commits: DataFrame, author: str | None = None, id_col: str = "sha",
                               bucket: str = "day") -> DataFrame:
    """A4: ($oid, name, date, time_diff): calendar days since the same committer's previous commit.

    ``author=None`` computes it for every committer.  The lag is split by ``bucket`` of the date so
    that one very active committer is not sorted in a single task.
    """
    rows = commits.select(F.col(id_col).alias("$oid"), F.col(_CNAME).alias("name"),
                          F.col(_CDATE).alias("date"), F.col("sha").alias("_sha"))
    if author is not None:
        rows = rows.filter(F.col("name") == author)
    with_prev = previous_in_group(rows, keys=["name"], order=["date", "_sha"], carry=["date"],
                                  bucket=F.date_trunc(bucket, F.col("date")))
    diff = F.coalesce(F.datediff(F.to_date("date"), F.to_date("prev_date")), F.lit(0))
    return (with_prev.select("$oid", "name", "date", diff.alias("time_diff"), "_sha")
            .orderBy("date", "_sha").drop("_sha"))


def commits_per_weekday(commits: DataFrame) -> DataFrame:
    """A5: (day, commits_per_day), Sunday = 1 ... Saturday = 7."""
    return (commits.select(F.dayofweek(F.col(_CDATE)).alias("day"))
            .groupBy("day").agg(F.count(F.lit(1)).alias("commits_per_day")))


def author_committer_lag_seconds(commits: DataFrame) -> DataFrame:
    """The input plus ``commit_time_diff`` = committer epoch seconds - author epoch seconds."""
    return commits.withColumn("commit_time_diff", F.unix_seconds(F.col(_CDATE))
                              - F.unix_seconds(F.col("commit.author.date")))


def _parent_edges(commits: DataFrame, *extra) -> DataFrame:
    return commits.select(F.col("sha").alias("child_sha"), *extra,
                          F.explode(F.col("parents.sha")).alias("parent_sha"))


def branch_points(commits: DataFrame) -> DataFrame:
    """(sha, times_parent) for commits of the input that are parent of more than one commit.

    One scan: each commit yields a presence row (its sha) and an edge row per parent (parent sha,
    child), grouped together, so "is the parent in the input" needs no join.  The distinct count shuffles by
    (sha, child) first and counts per sha partially, so a parent with many children is split.
    """
    me = F.struct(F.col("sha").alias("sha"), F.lit(None).cast("string").alias("child"), F.lit(True).alias("present"))
    ups = F.transform("parents", lambda p: F.struct(p["sha"].alias("sha"), F.col("sha").alias("child"),
                                                    F.lit(False).alias("present")))
    rows = commits.select(F.explode(F.concat(F.array(me), ups)).alias("r")).select("r.*")
    per = rows.groupBy("sha").agg(F.countDistinct("child").alias("times_parent"), F.max("present").alias("present"))
    return per.filter(F.col("present") & (F.col("times_parent") > 1)).select("sha", "times_parent")


def fork_points(commits: DataFrame) -> DataFrame:
    """(repo_name, child_repo_name, parent_sha, child_sha): parent and child in different repos.

    Both sides are made distinct before the join, so its rows are, and nothing above the join needs
    the rows of one parent together: its shuffles carry no other operator and AQE's skew join can
    split a parent with very many children."""
    edges = _parent_edges(commits, fields.full_name("url").alias("child_repo_name")).distinct()
    parents = commits.select(F.col("sha").alias("parent_sha"), fields.full_name("url").alias("repo_name")).distinct()
    return (edges.join(parents, "parent_sha")
            .filter(F.col("repo_name") != F.col("child_repo_name"))
            .select("repo_name", "child_repo_name", "parent_sha", "child_sha"))
