"""A8 in its documented form: the first commit of every fork (ancestor search on the commit graph).

The graph is followed along first parents, the line that a branch is made of; other parents are merges into it.  That
graph is a forest, so ancestor questions are answered by pointer jumping (``rounds.jump``), in rounds
that grow with the logarithm of the longest line, and not by walking it commit by commit:

1. *Runs*: consecutive commits of one repository on a line.  Jumping along parents in the same repository finds every commit's
   run, named by the run's first commit.
2. *Forest of runs*: the parent of a run's first commit, in another repository, belongs to the run above it.
3. *Tour*: the walk around each tree that enters every run before and leaves it after all runs below it, as a list of
   (run, enter or exit) with successors (first child, next sibling, parent).  Jumping along the list gives
   positions; run a is an ancestor of run b exactly if a is entered before b and left after it.
4. Per tree and repository, in order of entry, a run has an ancestor of its own repository exactly if one of those before it
   is left after it: a running minimum (``ordering.segmented_scan``), with no window over a whole repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields
from .ordering import segmented_scan
from .rounds import jump, scratch, written


def first_parents(commits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (node, next), one row per commit and repository, and heads (node, sha, repo, up, up_sha, up_repo).

    ``node`` is a number, so that what follows shuffles no names.  ``next`` is the first parent in the commit's own repository.  Commits
    without one are heads; ``up`` is the first parent in another repository: the first by name of those that have it.  A
    parent that the input lacks is null, as is that of a commit that names itself.  Of rows that repeat a commit in a
    repository with different parents, the smallest parent counts.  Commits without sha or repository are left out."""
    spark = commits.sparkSession
    own = (commits.select("sha", fields.full_name("url").alias("repo"), F.try_element_at(F.col("parents.sha"), F.lit(1)).alias("parent"))
           .filter("sha IS NOT NULL AND repo IS NOT NULL").groupBy("sha", "repo").agg(F.min("parent").alias("parent")))
    # numbers are stored with the rows, so a task that is run again doesn't change them
    own = written(own.select(F.monotonically_increasing_id().alias("node"), "sha", "repo",
                             F.when(F.col("parent") != F.col("sha"), F.col("parent")).alias("parent")), scratch(spark, "first-parents"))
    here = own.select(F.col("sha").alias("parent"), "repo", F.col("node").alias("next"))
    names = [F.when(F.col("next").isNull(), F.col(c)).alias(c) for c in ("sha", "repo", "parent")]  # of heads only
    nodes = written(own.join(here, ["parent", "repo"], "left").select("node", "next", *names), scratch(spark, "links"))
    heads = nodes.filter("next IS NULL").drop("next")
    wanted = heads.select("parent").filter("parent IS NOT NULL").distinct()
    elsewhere = (own.select(F.col("sha").alias("parent"), "repo", "node").join(wanted, "parent")
                 .groupBy("parent").agg(F.min(F.struct("repo", "node")).alias("above")))
    linked = heads.join(elsewhere, "parent", "left").select(
        "node", "sha", "repo", F.col("above.node").alias("up"), F.when(F.col("above").isNotNull(), F.col("parent")).alias("up_sha"),
        F.col("above.repo").alias("up_repo"))
    return nodes.select("node", "next"), written(linked, scratch(spark, "heads"))


def tour(forest: DataFrame) -> tuple[DataFrame, int]:
    """(node, root, entered, left) of a forest (node, up) of numbers: steps from entering and from leaving a node to the end of its
    tree's tour, so ``entered`` falls as the tour goes on.  ``root`` names the tree."""
    spark = forest.sparkSession
    forest = written(forest, scratch(spark, "forest"))
    below = forest.filter("up IS NOT NULL")
    first = below.groupBy(F.col("up").alias("node")).agg(F.min("node").alias("child"))
    # the next sibling: the least of the larger ones, that is of those before it in descending order
    ordered = segmented_scan(below, ["up"], ["node"], {"sibling": ("min", "node")}, inclusive=False, descending=True)
    enter = forest.join(first, "node", "left").select(
        _enter("node").alias("node"), F.coalesce(_enter("child"), _exit("node")).alias("next"))
    leave = forest.join(ordered.select("node", "sibling"), "node", "left").select(
        _exit("node").alias("node"), F.coalesce(_enter("sibling"), _exit("up")).alias("next"))
    at, rounds = jump(enter.unionByName(leave), "tour", closed=True)
    entering = F.col("node") % 2 == 0
    place = at.select(F.shiftright("node", 1).alias("node"), F.when(entering, F.col("steps")).alias("entered"),
                      F.when(~entering, F.col("steps")).alias("left"), F.col("last").alias("root"))
    return place.groupBy("node").agg(F.max("entered").alias("entered"), F.max("left").alias("left"), F.max("root").alias("root")), rounds


def _enter(node: str) -> Column:
    return F.col(node) * 2


def _exit(node: str) -> Column:
    return F.col(node) * 2 + 1


def fork_first_commits(commits: DataFrame) -> DataFrame:
    """A8, documented form: (repo_name, child_repo_name, parent_sha, child_sha), one row per forked branch.

    ``child_sha`` is the first commit that occurs in the forked branch and ``parent_sha`` the commit of ``repo_name`` from
    which the fork was made.  A merge from another repository is no fork (its first parent is its own), and a
    line that comes back to a repository after passing through others starts no new fork of it.  Cycles of
    parents, which no commit graph has, are not allowed."""
    links, heads = first_parents(commits)
    found, _ = jump(links, "runs", closed=True)
    above = found.select(F.col("node").alias("up"), F.col("last").alias("run_above"))
    forest = heads.select("node", "up").join(above, "up", "left").select("node", F.col("run_above").alias("up"))
    where, _ = tour(forest)
    forks = heads.join(where, "node")
    # entered falls along the tour: negated, it orders runs as they are entered
    checked = segmented_scan(forks.withColumn("entry", -F.col("entered")), ["root", "repo"], ["entry"],
                             {"least_left": ("min", "left")}, inclusive=False)
    again = F.col("least_left") < F.col("left")
    return (checked.filter(F.col("up").isNotNull() & ~F.coalesce(again, F.lit(False)))
            .select(F.col("up_repo").alias("repo_name"), F.col("repo").alias("child_repo_name"), F.col("up_sha").alias("parent_sha"),
                    F.col("sha").alias("child_sha")))
