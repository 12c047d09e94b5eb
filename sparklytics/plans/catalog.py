"""

Inputs come from ``sparklytics.sources`` (views over the given tables), parameters are fixed
here, outputs are flattened by ``output.flat``.  Nothing is sampled or capped: each query reads
whole tables; limits appear only where the analytic is a top-k / first-n.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import commit_collections as coll
from ..operators import commit_frames as frames
from ..operators import commit_pairs as pairs
from ..operators import graph, lineage, nested, summary
from ..operators import lists as L
from ..operators import logs, rounds, text
from ..sources import lists as list_src
from ..sources import text as text_src
from ..session import pin_utc
from ..sources.commits import (commit_file_view, commit_stats_view, commit_view, event_commit_view, events_to_commits,
                               events_to_geo, geo_view, lineitem_files)
from ..sources.tables import read_table
from ..streaming import queries as sq
from ..streaming import jobs, late, running, sequence
from ..streaming.replay import Feed, replay, replay_all, time_batches
from ..streaming.replay import feed as feed_all
from .output import flat

# Fixed parameters of the registered queries.
AUTHORS = ["own1", "own7", "GitHub"]
SNAPSHOT = "2002-01-01T00:00:00Z"
FOCUS_COMMITTER = "GitHub"
USERS = ["GitHub", "own3", "own17", "nobody"]
FOCUS_REPO = "repo3"
FOCUS_YEAR = 1997

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Registers a query.  Here, and only here, the session is set to UTC: the registered queries define
    dates and day windows, and their callers hand over a session for them."""
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark, d):
            pin_utc(spark)
            return fn(spark, d)
        QUERIES[name] = run
        return run
    return deco


# ---- A: DataFrame family -------------------------------------------------------------------
@query("commits_by_authors")
def _a1(spark, d):
    return flat(frames.commits_by_authors(commit_view(spark, d), AUTHORS))


@query("weekly_commits_per_repo")
def _a2(spark, d):
    return flat(frames.weekly_commits_per_repo(commit_view(spark, d)))


@query("commit_age_seconds")
def _a3(spark, d):
    r = frames.commit_age_seconds(commit_view(spark, d), SNAPSHOT)
    return flat(r.select("sha", F.col("commit.committer.date").alias("date"), "age"))


@query("days_since_previous_commit")
def _a4(spark, d):
    return flat(frames.days_since_previous_commit(commit_view(spark, d), FOCUS_COMMITTER))


@query("days_since_previous_commit_all")
def _a4_all(spark, d):
    return flat(frames.days_since_previous_commit(commit_view(spark, d), None))


@query("commits_per_weekday")
def _a5(spark, d):
    return flat(frames.commits_per_weekday(commit_view(spark, d)))


@query("author_committer_lag_seconds")
def _a6(spark, d):
    return flat(frames.author_committer_lag_seconds(commit_view(spark, d)).select("sha", "commit_time_diff"))


@query("branch_points")
def _a7(spark, d):
    return flat(frames.branch_points(commit_view(spark, d)))


@query("fork_points")
def _a8(spark, d):
    return flat(frames.fork_points(commit_view(spark, d)))


@query("fork_first_commits")
def _a8_first(spark, d):
    return flat(lineage.fork_first_commits(commit_view(spark, d)))


@query("time_diff_summary")
def _a4_summary(spark, d):
    """Summary of A4, merged from one state per year."""
    diffs = frames.days_since_previous_commit(commit_view(spark, d), FOCUS_COMMITTER).select(F.year("date").alias("year"), "time_diff")
    s = summary.describe(summary.merge_states(summary.summary_state(diffs, "time_diff", ["year"])))
    return flat(s.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6)))


@query("common_committers")
def _common_committers(spark, d):
    """Commits that repositories' committers have in common before and since the focus year."""
    c = commit_view(spark, d).select(F.year("commit.committer.date").alias("year"), F.substring_index("url", "/commits/", 1).alias("repo_url"),
                                     F.col("commit.committer.name").alias("committer"))
    rows = lambda when: c.filter(when).select("repo_url", "committer")
    return flat(summary.common_rows(rows(F.col("year") < FOCUS_YEAR), rows(F.col("year") >= FOCUS_YEAR)))


# ---- B: pair-RDD family --------------------------------------------------------------------
@query("commit_count")
def _b1(spark, d):
    return flat(pairs.commit_count(commit_view(spark, d)))


@query("file_extension_counts")
def _b2(spark, d):
    return flat(pairs.file_extension_counts(lineitem_files(spark, d)))


@query("author_rank")
def _b3(spark, d):
    return flat(pairs.author_rank(commit_view(spark, d)))


@query("committer_stats_totals")
def _b4(spark, d):
    return flat(pairs.committer_stats_totals(commit_stats_view(spark, d), USERS))


@query("exclusive_owners_or_authors")
def _b5(spark, d):
    return flat(pairs.exclusive_owners_or_authors(commit_view(spark, d)))


@query("longest_revert_streak")
def _b6(spark, d):
    return flat(pairs.longest_revert_streak(commit_view(spark, d)))


@query("repo_commits_and_committers")
def _b7(spark, d):
    return flat(pairs.repo_commits_and_committers(commit_view(spark, d)))


@query("repo_commit_totals")
def _b7_totals(spark, d):
    return flat(pairs.repo_commit_totals(commit_view(spark, d)))


@query("latest_files_per_repo")
def _b8(spark, d):
    return flat(pairs.latest_files_per_repo(commit_file_view(spark, d))
                .select("repository", "filename", "sha", "status", "additions", "deletions", "changes"))


@query("repo_file_overview")
def _b9(spark, d):
    return flat(pairs.repo_file_overview(commit_file_view(spark, d), FOCUS_REPO))


@query("committer_repo_stats")
def _b10(spark, d):
    return flat(pairs.committer_repo_stats(commit_view(spark, d)).select("committer", "repository", "stats.*"))


@query("md5_long_id")
def _b11(spark, d):
    return flat(commit_view(spark, d).select("sha", graph.md5_long_id(F.col("sha")).alias("id")))


@query("developer_repo_graph")
def _b12(spark, d):
    return flat(graph.developer_repo_degrees(commit_view(spark, d)))


@query("developer_repo_vertices")
def _b12_vertices(spark, d):
    return flat(graph.developer_repo_graph(commit_view(spark, d))[0])


@query("developer_repo_edges")
def _b12_edges(spark, d):
    return flat(graph.developer_repo_graph(commit_view(spark, d))[1])


# ---- D: collection family ------------------------------------------------------------------
@query("avg_additions")
def _d1(spark, d):
    return flat(coll.avg_additions(commit_view(spark, d)))


@query("peak_js_hour")
def _d2(spark, d):
    return flat(coll.peak_js_hour(commit_file_view(spark, d)))


@query("top_committer_of_repo")
def _d3(spark, d):
    return flat(coll.top_committer_of_repo(commit_view(spark, d), FOCUS_REPO))


@query("commits_per_repo_in_year")
def _d4(spark, d):
    return flat(coll.commits_per_repo_in_year(commit_view(spark, d), FOCUS_YEAR))


@query("top_file_formats")
def _d5(spark, d):
    return flat(coll.top_file_formats(lineitem_files(spark, d)))


# ---- E: logs and text ----------------------------------------------------------------------
ERROR_NEEDLE = K.MISSING_FILE_TEXT


@query("lines_containing")
def _e2(spark, d):
    return flat(logs.lines_containing(text_src.error_log_lines(spark, d), ERROR_NEEDLE))


@query("first_quoted_requests")
def _e3(spark, d):
    return flat(logs.first_quoted_requests(text_src.access_log_lines(spark, d), "line_no"))


@query("post_requests")
def _e4(spark, d):
    return flat(logs.post_requests(text_src.access_log_lines(spark, d)))


@query("largest_post_response")
def _e5(spark, d):
    return flat(logs.largest_post_response(text_src.access_log_lines(spark, d)))


@query("top_post_client")
def _e6(spark, d):
    return flat(logs.top_post_client(text_src.access_log_lines(spark, d)))


@query("access_log_to_csv")
def _e7(spark, d):
    return flat(logs.access_log_to_csv(text_src.access_log_lines(spark, d)))


@query("top_words")
def _e8(spark, d):
    return flat(text.top_words(text_src.book_documents(spark, d)))


@query("first_sentences")
def _e9(spark, d):
    return flat(text.first_sentences(text_src.book_documents(spark, d), "doc_id"))


@query("fix_lowercase_i")
def _e10(spark, d):
    return flat(text.fix_lowercase_i(text_src.book_documents(spark, d)))


# ---- F: lists ------------------------------------------------------------------------------
def _lists(spark, d, expr_fn, name="result"):
    ls = list_src.order_lists(spark, d)
    return flat(ls.select("list_id", expr_fn(ls).alias(name)))


FOLD_INIT = 7
FOLD_MOD = 1_000_000_007  # order-sensitive, bounded fold step: (acc * 31 + x) mod p


@query("array_map")
def _f1(spark, d):
    return _lists(spark, d, lambda ls: L.array_map("xs", lambda x: x + 1))


@query("array_filter")
def _f2(spark, d):
    return _lists(spark, d, lambda ls: L.array_filter("xs", lambda x: x > 25))


@query("array_flatten_deep")
def _f3(spark, d):
    lists = list_src.order_lists(spark, d)
    mixed = F.concat(F.lit("["), F.to_json("xss"), F.lit(","), F.to_json("xs"), F.lit("]"))
    return flat(lists.select("list_id", L.json_flatten_deep(mixed, "bigint").alias("result")))


@query("array_flatten_typed")
def _f3_typed(spark, d):
    lists = list_src.order_lists(spark, d)
    return flat(lists.select("list_id", L.array_flatten_deep(lists, "xss").alias("result")))


@query("array_flatten_variant")
def _f3_variant(spark, d):
    lists = list_src.order_lists(spark, d)
    mixed = F.concat(F.lit("["), F.to_json("xss"), F.lit(","), F.to_json("xs"), F.lit("]"))
    return flat(nested.flattened(nested.flatten_variant(lists, "list_id", mixed), "list_id", "bigint"))


@query("array_fold_left")
def _f4(spark, d):
    return _lists(spark, d, lambda ls: L.array_fold_left("xs", F.lit(FOLD_INIT).cast("bigint"),
                                                         lambda acc, x: (acc * 31 + x) % FOLD_MOD))


@query("array_fold_right")
def _f5(spark, d):
    return _lists(spark, d, lambda ls: L.array_fold_right("xs", F.lit(FOLD_INIT).cast("bigint"),
                                                          lambda x, acc: (acc * 31 + x) % FOLD_MOD))


@query("array_zip_shortest")
def _f6(spark, d):
    def pairs(ls):
        z = L.array_zip_shortest("xs", F.slice("xs", 2, F.size("xs")))
        return F.transform(z, lambda p: F.concat_ws(":", p["0"].cast("string"), p["1"].cast("string")))
    return _lists(spark, d, pairs)


@query("array_first_n")
def _f7(spark, d):
    return _lists(spark, d, lambda ls: L.array_first_n("xs", 3))


@query("list_max")
def _f8(spark, d):
    return _lists(spark, d, lambda ls: L.list_max("xs"))


@query("list_sum")
def _f9(spark, d):
    return _lists(spark, d, lambda ls: L.list_sum("xs"))


@query("list_sum_defined")
def _f10(spark, d):
    return _lists(spark, d, lambda ls: L.list_sum_defined("oxs"))


@query("list_first_divisible")
def _f11(spark, d):
    return _lists(spark, d, lambda ls: L.list_first_divisible("xs", 7))


@query("list_even_defined")
def _f12(spark, d):
    return _lists(spark, d, lambda ls: L.list_even_defined("oxs"))


@query("list_avg_first_n_above")
def _f13(spark, d):
    return _lists(spark, d, lambda ls: L.list_avg_first_n_above("xs", 25, 3))


@query("list_sum_first_n_above")
def _f14(spark, d):
    items = list_src.order_items(spark, d).select(F.col("supp").alias("list_id"), F.col("item_key").alias("pos"),
                                                  "value")
    return flat(L.sum_first_n_above(items))


@query("passing_students")
def _f15(spark, d):
    return flat(L.passing_students(list_src.grades(spark, d)))


@query("first_head_sums_tail")
def _f16(spark, d):
    return flat(L.first_head_sums_tail(list_src.order_lists(spark, d)))


@query("fizzbuzz_label")
def _f17(spark, d):
    q = read_table(spark, d, "lineitem", "l_quantity").select(F.col("l_quantity").cast("bigint").alias("q"))
    return flat(q.groupBy(L.fizzbuzz_label("q").alias("label")).agg(F.count(F.lit(1)).alias("n")))


# ---- C: streams (static evaluation of the stream functions; *_replay keys run the stream) ------
def _ec(spark, d):
    return event_commit_view(spark, d)


@query("stream_commit_shas")
def _c0(spark, d):
    return flat(sq.commit_shas(_ec(spark, d)))


@query("stream_large_additions")
def _c1(spark, d):
    return flat(sq.large_additions(_ec(spark, d)))


@query("stream_large_deletion_files")
def _c2(spark, d):
    return flat(sq.large_deletion_files(_ec(spark, d)))


@query("stream_extension_counts")
def _c3(spark, d):
    return flat(sq.extension_counts(_ec(spark, d)))


@query("stream_extension_status_counts")
def _c4(spark, d):
    return flat(sq.extension_status_counts(_ec(spark, d)))


@query("stream_daily_commits")
def _c5(spark, d):
    return flat(sq.daily_commits(_ec(spark, d)))


@query("stream_size_class_counts")
def _c6(spark, d):
    return flat(sq.size_class_counts(_ec(spark, d)))


@query("stream_daily_repo_summary")
def _c7(spark, d):
    return flat(sq.daily_repo_summary(_ec(spark, d)))


@query("stream_weekly_java_changes_by_continent")
def _c8(spark, d):
    return flat(sq.weekly_java_changes_by_continent(_ec(spark, d), geo_view(spark, d)))


@query("stream_added_then_removed")
def _c9(spark, d):
    return flat(sq.added_then_removed(_ec(spark, d)))


ADDED_REMOVED_SHORT = "1 hour"   # a selective horizon at sf0.01 (FIXTURES.md §4.2)


@query("stream_added_then_removed_1h")
def _c9_short(spark, d):
    return flat(sq.added_then_removed(_ec(spark, d), within=ADDED_REMOVED_SHORT))


def _events(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


GEO_LATENESS = "2 hours"  # geo events of the stand-in come up to 91 minutes out of order
REPLAY_BATCHES = 4  # micro-batches per replay (plus the sentinel batch for windowed queries)


@query("stream_commit_shas_replay")
def _c0_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.commit_shas(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES, sentinel=False))


@query("stream_large_additions_replay")
def _c1_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.large_additions(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES, sentinel=False))


@query("stream_large_deletion_files_replay")
def _c2_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.large_deletion_files(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES, sentinel=False))


@query("stream_daily_commits_replay")
def _c5_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.daily_commits(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES))


@query("stream_size_class_counts_replay")
def _c6_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.size_class_counts(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES))


@query("stream_daily_repo_summary_replay")
def _c7_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.daily_repo_summary(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES))


@query("stream_weekly_java_changes_by_continent_replay")
def _c8_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.weekly_java_changes_by_continent(
        events_to_commits(ev), events_to_geo(ev), geo_watermark=GEO_LATENESS), n_batches=REPLAY_BATCHES))


@query("stream_added_then_removed_replay")
def _c9_stream(spark, d):
    # a name may be emitted again by a later window (bounded dedupe state): distinct at the end
    return flat(replay(spark, _events(spark, d), lambda ev: sq.added_then_removed_stream(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES).distinct())


@query("stream_extension_status_counts_replay")
def _c4_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.extension_status_counts(events_to_commits(ev)),
                       output_mode="complete", n_batches=REPLAY_BATCHES, sentinel=False))


@query("stream_extension_counts_replay")
def _c3_stream(spark, d):
    return flat(replay(spark, _events(spark, d), lambda ev: sq.extension_counts(events_to_commits(ev)),
                       output_mode="update", keys=["extension"], n_batches=REPLAY_BATCHES, sentinel=False))


@query("stream_running_extension_counts")
def _c3_running(spark, d):
    return flat(running.running_extension_counts(_ec(spark, d)))


@query("stream_running_extension_status_counts")
def _c4_running(spark, d):
    return flat(running.running_extension_status_counts(_ec(spark, d)))


@query("stream_running_extension_counts_replay")
def _c3_running_stream(spark, d):
    ev = _events(spark, d)
    sink = rounds.scratch(spark, "running")
    feed = Feed(spark, f"{sink}-source", ev.schema)
    q = running.start(running.extension_events(events_to_commits(feed.stream())), sink, "running_extension_counts", ["extension"],
                      trigger={"processingTime": "0 seconds"}, checkpoint=f"{sink}-state")
    feed_all(q, [feed], [time_batches(ev, REPLAY_BATCHES, "ts")])
    return flat(running.read(spark, sink))


@query("stream_added_then_removed_keyed_replay")
def _c9_keyed_stream(spark, d):
    # a file may be reported again once its state has expired: distinct at the end
    return flat(replay(spark, _events(spark, d), lambda ev: sequence.added_then_removed_keyed(events_to_commits(ev)),
                       n_batches=REPLAY_BATCHES, sentinel=False).distinct())


@query("stream_weekly_java_changes_by_continent_two_sources_replay")
def _c8_two_sources(spark, d):
    """Geo events come from a folder of their own, a batch after the commits."""
    ev, geo = _events(spark, d), geo_view(spark, d)
    tables = [(ev.schema, time_batches(ev, REPLAY_BATCHES, "ts", True, "event_id")),
              (geo.schema, time_batches(geo, REPLAY_BATCHES, "createdAt", True))]
    return flat(replay_all(spark, tables, lambda e, g: sq.weekly_java_changes_by_continent(events_to_commits(e), g), lag=[0, 1],
                           sentinel=True))


# Fixed parameters of the late-row replays: every 13th event arrives three days after it happened.
LATE_EVERY, LATE_BY, LATENESS = 13, "3 days", "1 day"


def _split(spark, d) -> tuple[str, DataFrame]:
    """The events in order of arrival through the split of late rows, with a row far ahead at the end."""
    ev = _events(spark, d)
    by = F.when(F.col("event_id") % LATE_EVERY == 0, F.expr(f"INTERVAL {LATE_BY}")).otherwise(F.expr("INTERVAL 0 days"))
    arriving = ev.withColumn("arrival", F.col("ts") + by)
    batches = time_batches(arriving, REPLAY_BATCHES, "arrival")
    batches.append(time_batches(arriving, 1, "ts", True, "event_id")[1])
    sink = rounds.scratch(spark, "late")
    feed = Feed(spark, f"{sink}-source", arriving.schema)
    q = late.split(feed.stream(), sink, "late_events", "ts", LATENESS, trigger={"processingTime": "0 seconds"}, checkpoint=f"{sink}-state")
    feed_all(q, [feed], [batches])
    return sink, arriving


@query("stream_late_rows_replay")
def _late_rows(spark, d):
    sink, arriving = _split(spark, d)
    rows = late.late_rows(spark, sink, arriving.schema)
    return flat(events_to_commits(rows).select("sha", F.col("commit.committer.date").alias("ts")))


@query("stream_daily_commits_on_time_replay")
def _on_time_days(spark, d):
    """C5 behind the split: the late rows are in the side table, and no row is dropped."""
    sink, arriving = _split(spark, d)
    out = f"{sink}-daily"
    q = jobs.start(sq.daily_commits(events_to_commits(late.on_time(spark, sink, arriving.schema))), out, "on_time_days",
                   trigger={"processingTime": "0 seconds"}, checkpoint=f"{sink}-daily-state")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return flat(spark.read.parquet(out))
