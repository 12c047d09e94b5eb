"""

All of them are ``groupBy().agg()`` plans: Catalyst adds the map-side partial aggregate that
``reduceByKey``/``aggregateByKey`` gave, and prunes the nested columns each one reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import fields
from .ordering import global_rank

FILE_SALTS = 64  # B9: tasks that one file's commits are spread over
_CNAME = "commit.committer.name"
_ANAME = "commit.author.name"


def commit_count(commits: DataFrame) -> DataFrame:
    """B1: one row, ``commits`` = number of commits."""
    return commits.agg(F.count(F.lit(1)).alias("commits"))


def file_extension_counts(commits: DataFrame) -> DataFrame:
    """B2: (extension, count) over all files; no name or no extension -> ``unknown``."""
    names = fields.file_rows(commits).select(F.col("file.filename").alias("filename"))
    return (names.groupBy(fields.extension_or_unknown(F.col("filename")).alias("extension"))
            .agg(F.count(F.lit(1)).alias("count")))


def author_rank(commits: DataFrame) -> DataFrame:
    """(rank, author, commits); rank 0 = most commits, ties by name."""
    per = commits.groupBy(F.col(_ANAME).alias("author")).agg(F.count(F.lit(1)).alias("commits"))
    ranked = global_rank(per, [F.col("commits").desc(), F.col("author").asc_nulls_last()])
    return ranked.select("rank", "author", "commits")


def _stats_sums(prefix: str = "") -> list:
    return [F.sum(fields.stat(f)).alias(prefix + f) for f in ("total", "additions", "deletions")]


def committer_stats_totals(commits: DataFrame, users: Sequence[str] | DataFrame) -> DataFrame:
    """(committer, total, additions, deletions) for listed committers; absent stats = 0.  Takes
    commits, or rows that each carry a part of their commit's stats (``commit_stats_view``)."""
    rows = commits.select(F.col(_CNAME).alias("committer"), "stats")
    return fields.keep_names(rows, "committer", users).groupBy("committer").agg(*_stats_sums())


def exclusive_owners_or_authors(commits: DataFrame) -> DataFrame:
    """Names that only author commits or only own repositories (symmetric difference, D8).

    One aggregation over the union of both roles instead of two distincts and a full outer join.
    """
    roles = commits.select(F.explode(F.array(
        F.struct(F.col(_ANAME).alias("name"), F.lit(1).alias("a"), F.lit(0).alias("o")),
        F.struct(fields.owner("url").alias("name"), F.lit(0).alias("a"), F.lit(1).alias("o")))).alias("r"))
    per = (roles.select("r.*").filter(F.col("name").isNotNull())
           .groupBy("name").agg(F.max("a").alias("a"), F.max("o").alias("o")))
    return per.filter(F.col("a") + F.col("o") == 1).select("name")


def longest_revert_streak(commits: DataFrame) -> DataFrame:
    """(author, longest, how_often) over messages starting with ``Revert``."""
    msg = F.col("commit.message")
    streaks = (commits.filter(msg.startswith(K.REVERT_WORD))
               .select(F.col(_ANAME).alias("author"), F.regexp_count(msg, F.lit(K.REVERT_WORD)).alias("streak")))
    per = streaks.groupBy("author", "streak").agg(F.count(F.lit(1)).alias("n"))
    best = per.groupBy("author").agg(F.max(F.struct("streak", "n")).alias("b"))
    return best.select("author", F.col("b.streak").cast("bigint").alias("longest"),
                       F.col("b.n").alias("how_often"))


def repo_commits_and_committers(commits: DataFrame, use_full_name: bool = False, nested: bool = False) -> DataFrame:
    """The committers of each repository and how much each committed.

    Flat by default, (repository, committer, commits); ``nested=True`` gives the upstream shape
    (repository, commits, committers sorted) with one array per repository."""
    pairs = (commits.groupBy(fields.repo_key("url", use_full_name).alias("repository"),
                             F.col(_CNAME).alias("committer"))
             .agg(F.count(F.lit(1)).alias("commits")))
    if not nested:
        return pairs
    return pairs.groupBy("repository").agg(F.sum("commits").alias("commits"),
                                           F.array_sort(F.collect_list("committer")).alias("committers"))


def repo_commit_totals(commits: DataFrame, use_full_name: bool = False) -> DataFrame:
    """B7, totals: (repository, commits, committers), the number of distinct named committers."""
    pairs = repo_commits_and_committers(commits, use_full_name)
    return pairs.groupBy("repository").agg(F.sum("commits").alias("commits"), F.count("committer").alias("committers"))


def latest_files_per_repo(commits: DataFrame, use_full_name: bool = False, nested: bool = False) -> DataFrame:
    """Per (repository, filename) the newest file record by author date.

    Ties: larger commit sha, then larger file sha.  Flat rows by default; ``nested=True`` gathers
    each repository's files into one array (one row per repository, as upstream returns it).
    """
    f = (fields.file_rows(commits)
         .select(fields.repo_key("url", use_full_name).alias("repository"),
                 F.col("commit.author.date").alias("date"), F.col("sha").alias("commit_sha"), "file")
         .filter(F.col("file.filename").isNotNull()))
    newest = (f.groupBy("repository", F.col("file.filename").alias("filename"))
              .agg(F.max_by("file", F.struct("date", "commit_sha", F.col("file.sha"))).alias("file")))
    if nested:
        return newest.groupBy("repository").agg(F.collect_list("file").alias("files"))
    return newest.select("repository", "file.*")


def repo_file_overview(commits: DataFrame, repository: str, use_full_name: bool = False,
                       nested: bool = False) -> DataFrame:
    """For one repository, every file with its commit SHAs and Stats (total = sum of changes).

    Flat by default: one row per (filename, sha) carrying the file's totals, so a file touched by
    millions of commits is never gathered into one row.  ``nested=True`` gives the upstream shape
    (filename, shas sorted, total, additions, deletions) with one array per file.
    """
    f = (fields.file_rows(commits).filter(fields.repo_key("url", use_full_name) == repository)
         .select("sha", "file")
         .filter(F.col("file.filename").isNotNull())
         .select(F.col("file.filename").alias("filename"), "sha", F.col("file.changes").alias("total"),
                 F.col("file.additions").alias("additions"), F.col("file.deletions").alias("deletions")))
    names = ("total", "additions", "deletions")
    sums = [F.sum(c).alias(c) for c in names]
    if nested:
        return f.groupBy("filename").agg(F.array_sort(F.collect_set("sha")).alias("shas"), *sums)
    # Both sides of the join below come from this aggregate, so its shuffle runs once.  Totals are
    # built per (filename, salt) first and go back by (filename, salt): a file that most commits
    # touch is spread over ``FILE_SALTS`` tasks.
    per_commit = (f.groupBy("filename", "sha").agg(*sums)
                  .withColumn("salt", F.pmod(F.xxhash64("sha"), F.lit(FILE_SALTS))))
    per_file = (per_commit.groupBy("filename", "salt").agg(*sums)
                .groupBy("filename").agg(*sums, F.collect_list("salt").alias("salts"))
                .select("filename", F.explode("salts").alias("salt"), *names))
    return (per_commit.select("filename", "sha", "salt").join(per_file, ["filename", "salt"])
            .select("filename", "sha", *names))


def committer_repo_stats(commits: DataFrame, use_full_name: bool = False) -> DataFrame:
    """(committer, repository, stats); stats null only when every commit lacks stats."""
    g = commits.groupBy(F.col(_CNAME).alias("committer"),
                        fields.repo_key("url", use_full_name).alias("repository")).agg(
        F.count("stats").alias("_with"), *[F.sum("stats." + f).alias(f) for f in ("total", "additions", "deletions")])
    stats = F.when(F.col("_with") > 0, F.struct(*[F.coalesce(F.col(f), F.lit(0)).alias(f)
                                                  for f in ("total", "additions", "deletions")]))
    return g.select("committer", "repository", stats.alias("stats"))
