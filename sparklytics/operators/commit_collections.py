
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import fields
from ..sources.commits import MONTH_COLUMN

_CDATE = "commit.committer.date"


def avg_additions(commits: DataFrame) -> DataFrame:
    """Integer average of additions over commits that have stats."""
    adds = F.col("stats.additions")
    return (commits.filter(F.col("stats").isNotNull())
            .agg(F.sum(adds).alias("_s"), F.count(adds).alias("_n"))
            .select(F.expr("_s div _n").alias("avg_additions")))


def peak_js_hour(commits: DataFrame) -> DataFrame:
    """(hour, files): the UTC hour of day in which most ``.js`` files were changed."""
    f = fields.file_rows(commits).select(F.hour(F.col(_CDATE)).alias("hour"),
                                         F.col("file.filename").alias("filename"))
    per = f.filter(F.col("filename").endswith(K.JS_SUFFIX)).groupBy("hour").agg(F.count(F.lit(1)).alias("files"))
    return per.orderBy(F.col("files").desc(), F.col("hour").asc()).limit(1)


def top_committer_of_repo(commits: DataFrame, repository: str) -> DataFrame:
    """D3: (name, commits) of the committer with most commits to ``repository``
    (matched exactly as ``repo`` or ``owner/repo``, D18); ties by name."""
    r = commits.filter((fields.repo("url") == repository) | (fields.full_name("url") == repository))
    per = r.groupBy(F.col("commit.committer.name").alias("name")).agg(F.count(F.lit(1)).alias("commits"))
    return per.orderBy(F.col("commits").desc(), F.col("name").asc()).limit(1)


def commits_per_repo_in_year(commits: DataFrame, year: int) -> DataFrame:
    """(repository = owner/repo, commits) for commits in ``year`` (UTC); inactive repos absent.

    A range predicate on the timestamp instead of ``year(ts) = y`` so it can reach the scan; on a
    month-partitioned table (``sources.commits.write_commit_table``) whole partitions are skipped.
    """
    lo = _dt.datetime(year, 1, 1, tzinfo=_dt.timezone.utc)
    hi = _dt.datetime(year + 1, 1, 1, tzinfo=_dt.timezone.utc)
    ts = F.col(_CDATE)
    r = commits.filter((ts >= F.lit(lo)) & (ts < F.lit(hi)))
    if MONTH_COLUMN in commits.columns:  # stored table: also prune whole month partitions
        r = r.filter(F.col(MONTH_COLUMN).between(f"{year:04d}-01", f"{year:04d}-12"))
    return r.groupBy(fields.full_name("url").alias("repository")).agg(F.count(F.lit(1)).alias("commits"))


def top_file_formats(commits: DataFrame, k: int = K.TOP_FORMATS) -> DataFrame:
    """The ``k`` most frequent file formats (text after the last '.'), most frequent first."""
    names = fields.file_rows(commits).select(F.col("file.filename").alias("filename")) \
        .filter(F.col("filename").isNotNull())
    per = names.groupBy(fields.last_dot_part(F.col("filename")).alias("extension")).agg(
        F.count(F.lit(1)).alias("count"))
    return per.orderBy(F.col("count").desc(), F.col("extension").asc()).limit(k)
