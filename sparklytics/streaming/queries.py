"""

Every function takes a commit DataFrame that may be static or streaming and returns the same
plan either way.  Event time is ``commit.committer.date``; ``watermark`` is the allowed
lateness (``0 seconds`` matches an ascending-timestamp source).  On static input the
watermark is a no-op and windows are plain grouping keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import fields

TS = "commit.committer.date"
DAY_FMT = K.DAY_FORMAT


def _timed(commits: DataFrame, *cols, watermark: str | None = "0 seconds") -> DataFrame:
    df = commits.select(F.col(TS).alias("ts"), *cols)
    return df.withWatermark("ts", watermark) if watermark is not None else df


def _files(commits: DataFrame, *cols) -> DataFrame:
    return commits.select(*cols, F.explode("files").alias("f"))


def commit_shas(commits: DataFrame) -> DataFrame:
    """The SHA of every commit (stateless, append)."""
    return commits.select("sha")


def large_additions(commits: DataFrame, min_additions: int = K.LARGE_ADDITIONS) -> DataFrame:
    """SHA of commits with at least ``min_additions`` additions."""
    return commits.filter(F.col("stats.additions") >= min_additions).select("sha")


def large_deletion_files(commits: DataFrame, min_deletions: int = K.LARGE_DELETIONS) -> DataFrame:
    """Names of files with more than ``min_deletions`` deletions."""
    f = _files(commits)
    return f.filter(F.col("f.filename").isNotNull() & (F.col("f.deletions") > min_deletions)) \
        .select(F.col("f.filename").alias("filename"))


def _ext_files(commits: DataFrame, exts) -> DataFrame:
    f = _files(commits)
    name = F.col("f.filename")
    cond = F.lit(False)
    for e in exts:
        cond = cond | name.endswith("." + e)
    return f.filter(name.isNotNull() & cond).select(fields.last_dot_part(name).alias("extension"),
                                                    F.col("f.status").alias("status"))


def extension_counts(commits: DataFrame, exts=K.COUNTED_EXTENSIONS) -> DataFrame:
    """Running (extension, count) of files ending in the given extensions (update/complete mode)."""
    return _ext_files(commits, exts).groupBy("extension").agg(F.count(F.lit(1)).alias("count"))


def extension_status_counts(commits: DataFrame, exts=K.STATUS_EXTENSIONS) -> DataFrame:
    """C4: running (extension, status, count) (D12: keyed by both)."""
    f = _ext_files(commits, exts).filter(F.col("status").isNotNull())
    return f.groupBy("extension", "status").agg(F.count(F.lit(1)).alias("count"))


def daily_commits(commits: DataFrame, watermark: str = "0 seconds") -> DataFrame:
    """(date dd-MM-yyyy, count) per UTC day; one non-keyed tumbling window."""
    w = _timed(commits, watermark=watermark).groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("count"))
    return w.select(F.date_format("window.start", DAY_FMT).alias("date"), "count")


def size_class(total: Column, small_max: int = K.SMALL_COMMIT_MAX) -> Column:
    return F.when((total >= 0) & (total <= small_max), F.lit("small")).otherwise(F.lit("large"))


def size_class_counts(commits: DataFrame, watermark: str = "0 seconds", length: str = K.SIZE_WINDOW,
                      slide: str = K.SIZE_SLIDE) -> DataFrame:
    """(window_end, size_class, count) over the last ``length`` every ``slide``;
    small = 0..20 total changes, absent stats count as 0."""
    t = _timed(commits, size_class(fields.stat("total")).alias("size_class"), watermark=watermark)
    w = t.groupBy(F.window("ts", length, slide), "size_class").agg(F.count(F.lit(1)).alias("count"))
    return w.select(F.col("window.end").alias("window_end"), "size_class", "count")


def daily_repo_summary(commits: DataFrame, watermark: str = "0 seconds", min_commits: int = K.SUMMARY_MIN_COMMITS,
                       max_committers: int = K.SUMMARY_MAX_COMMITTERS) -> DataFrame:
    """Per owner/repo and UTC day: commits, distinct committers, total changes and the top
    committer(s) (alphabetical, comma-joined); kept when commits > ``min_commits`` and committers
    <= ``max_committers``.  Two chained aggregations (append mode on streams).

    With at most two committers, the smallest and the largest (count, name) name them all, so days
    with many committers are never gathered.  A larger ``max_committers`` gathers each day's list."""
    t = _timed(commits, fields.full_name("url").alias("repo"), F.col("commit.committer.name").alias("committer"),
               fields.stat("total").alias("changes"), watermark=watermark)
    per_person = t.groupBy(F.window("ts", "1 day").alias("w"), "repo", "committer").agg(
        F.count(F.lit(1)).alias("n"), F.sum("changes").alias("changes"))
    person = F.struct("n", "committer")
    people = ([F.min(person).alias("_low"), F.max(person).alias("_high")] if max_committers <= 2
              else [F.collect_list(person).alias("_people")])
    per_repo = per_person.groupBy("w", "repo").agg(
        F.sum("n").alias("amountOfCommits"), F.count(F.lit(1)).alias("amountOfCommitters"),
        F.sum("changes").alias("totalChanges"), F.max("n").alias("_top"), *people)
    named = F.array_distinct(F.array("_low", "_high")) if max_committers <= 2 else F.col("_people")
    top = F.array_join(F.array_sort(F.transform(F.filter(named, lambda p: p["n"] == F.col("_top")),
                                                lambda p: p["committer"])), ",")
    return (per_repo.filter((F.col("amountOfCommits") > min_commits) & (F.col("amountOfCommitters") <= max_committers))
            .select("repo", F.date_format("w.start", DAY_FMT).alias("date"), "amountOfCommits",
                    "amountOfCommitters", "totalChanges", top.alias("topCommitter")))


def java_changes(commits: DataFrame) -> Column:
    """Sum of ``changes`` over a commit's ``.java`` files (D24: by suffix, not last dot part)."""
    java = F.filter("files", lambda f: f["filename"].endswith(K.JAVA_SUFFIX))
    return F.aggregate(java, F.lit(0).cast("bigint"), lambda a, f: a + F.coalesce(f["changes"], F.lit(0)))


def weekly_java_changes_by_continent(commits: DataFrame, geo: DataFrame, before: str = K.GEO_BEFORE,
                                     after: str = K.GEO_AFTER, watermark: str = "0 seconds",
                                     geo_watermark: str = "0 seconds") -> DataFrame:
    """Join each commit with its geo event (same sha, geo time within [ts - before, ts + after]),
    then the weekly (epoch-aligned 7-day windows on commit time) sum of java changes per continent, > 0 only.
    Both sides carry a watermark so the join state is evicted."""
    c = _timed(commits, "sha", java_changes(commits).alias("java"), watermark=watermark)
    g = geo.select(F.col("sha").alias("g_sha"), F.col("createdAt").alias("g_ts"), "continent")
    if geo_watermark is not None:
        g = g.withWatermark("g_ts", geo_watermark)
    j = c.join(g, (F.col("sha") == F.col("g_sha"))
               & (F.col("g_ts") >= F.col("ts") - F.expr(f"INTERVAL {before}"))
               & (F.col("g_ts") <= F.col("ts") + F.expr(f"INTERVAL {after}")))
    w = j.groupBy(F.window("ts", "7 days"), "continent").agg(F.sum("java").alias("amount"))
    return w.filter(F.col("amount") > 0).select(F.col("window.start").alias("week_start"), "continent", "amount")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """``'1 day'``, ``'30 minutes'``, ``'2 hours 15 minutes'`` -> seconds."""
    parts = text.split()
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        total += int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]
    return total


def added_then_removed(commits: DataFrame, within: str = K.ADDED_REMOVED_WITHIN, watermark: str | None = "0 seconds",
                       dedupe: str = "watermark") -> DataFrame:
    """(repository, filename) of files removed less than ``within`` (H) after being added
    (strictly later, D16), one row per pair of names.  Static or streaming input.

    No add x remove pairs are formed.  Every qualifying pair has its addition in the first half of
    exactly one sliding window of length 2H and slide H (the one starting at the addition's
    H-bucket), so it suffices to check, per (file, window), with four conditional min/max
    aggregates (partial aggregation: a hot file is reduced map-side):

    * within the first half: the earliest addition precedes the latest removal;
    * across the halves: the earliest removal of the second half comes less than H after the
      latest addition of the first half.

    On a stream the windows are emitted once the watermark passes them (append mode).  Names are
    deduplicated within the watermark delay (``dedupe="watermark"``), so state stays bounded and a name
    may come again from a later window; ``"global"`` keeps every name of the result as state for ever.
    """
    h = interval_seconds(within)
    h_us = F.lit(h * 1_000_000)
    f = _files(commits, fields.full_name("url").alias("repository"), F.col(TS).alias("ts"))
    f = f.select("repository", F.col("f.filename").alias("filename"), F.col("f.status").alias("status"), "ts")
    if watermark is not None:  # before the status filter, so every commit moves event time on
        f = f.withWatermark("ts", watermark)
    ev = f.filter(F.col("filename").isNotNull() & F.col("status").isin("added", "removed"))
    ev = ev.select("repository", "filename", "ts", (F.col("status") == "removed").alias("removed"),
                   F.window("ts", f"{2 * h} seconds", f"{h} seconds").alias("w"))
    us = F.unix_micros("ts")
    first = us < F.unix_micros(F.col("w.start")) + h_us
    add, rem = ~F.col("removed"), F.col("removed")
    per = ev.groupBy("repository", "filename", "w").agg(
        F.min(F.when(add & first, us)).alias("a_min"), F.max(F.when(add & first, us)).alias("a_max"),
        F.max(F.when(rem & first, us)).alias("r_max"), F.min(F.when(rem & ~first, us)).alias("r_min"))
    hit = per.filter((F.col("a_min") < F.col("r_max")) | (F.col("r_min") < F.col("a_max") + h_us))
    names = hit.select("repository", "filename")
    if commits.isStreaming:
        if dedupe == "watermark":  # window_time keeps the event time's watermark
            timed = hit.select("repository", "filename", F.window_time("w").alias("_t"))
            return timed.dropDuplicatesWithinWatermark(["repository", "filename"]).select("repository", "filename")
        return names.dropDuplicates(["repository", "filename"]).select("repository", "filename")
    return names.select("repository", "filename").distinct()


def added_then_removed_stream(commits: DataFrame, within: str = K.ADDED_REMOVED_WITHIN, watermark: str = "0 seconds",
                              dedupe: str = "watermark") -> DataFrame:
    """C9 on a stream (same plan as ``added_then_removed``; kept as the streaming entry point)."""
    return added_then_removed(commits, within, watermark, dedupe)
