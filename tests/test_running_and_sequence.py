"""Running counts per event, keyed sequence matching and two-source replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparklytics.sources.commits import event_commit_view, events_to_commits
from sparklytics.streaming import jobs, running, sequence
from sparklytics.streaming import queries as sq
from sparklytics.streaming.replay import Feed, feed, time_batches

from .helpers import added_removed_pairs, commit, commits_df, file

SF = "/root/testdata/sf0.001"
NOW = {"processingTime": "0 seconds"}
T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


# ---- C3, C4: one record per event ----------------------------------------------------------------
def test_running_counts_of_a_small_history(spark):
    day = "2020-01-0{}T00:00:00Z".format
    rows = [commit("b", date=day(2), files=[file("x.java"), file("y.scala"), file("z.java"), file(None), file("java")]),
            commit("a", date=day(2), files=[file("q.java")]), commit("c", date=day(1), files=[file("w.java")]), commit("d", date=day(3))]
    got = running.running_extension_counts(commits_df(spark, rows)).orderBy("ts", "sha", "position").collect()
    assert [(r["sha"], r["position"], r["extension"], r["count"]) for r in got] == [
        ("c", 0, "java", 1), ("a", 0, "java", 2), ("b", 0, "java", 3), ("b", 1, "scala", 1), ("b", 2, "java", 4)]
    assert running.running_extension_counts(commits_df(spark, rows).limit(0)).collect() == []


def test_running_status_counts_leave_out_files_without_status(spark):
    rows = [commit("a", files=[file("x.js", status="added"), file("y.js", status=None), file("z.py", status="added"), file("u.js", status="added")])]
    got = running.running_extension_status_counts(commits_df(spark, rows)).collect()
    assert sorted((r["extension"], r["status"], r["position"], r["count"]) for r in got) == [
        ("js", "added", 0, 1), ("js", "added", 3, 2), ("py", "added", 2, 1)]


def test_a_hot_key_is_spread(spark):
    """All events have one key: a window over the key would be one task."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which merges tables as small as this
    events = spark.range(20_000).select(F.lit("java").alias("extension"), F.col("id").alias("ts"))
    out = running.running_counts(events, ["extension"], ["ts"]).cache()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.filter(F.col("count") != F.col("ts") + 1).isEmpty() and max(sizes) < 10_000
    out.unpersist()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_counts_on_a_stream_with_a_retry(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    source, sink = Feed(spark, str(tmp_path / "source"), ev.schema), str(tmp_path / "sink")
    q = running.start(running.extension_events(events_to_commits(source.stream())), sink, "running", ["extension"], trigger=NOW,
                      checkpoint=str(tmp_path / "ck"))
    feed(q, [source], [time_batches(ev, 5, "ts")])
    want = running.running_extension_counts(event_commit_view(spark, SF))
    rows = sorted(map(tuple, running.read(spark, sink).collect()))
    assert rows == sorted(map(tuple, want.collect())) and jobs.numbered(spark, sink, "epoch") == [0, 1, 2, 3, 4]
    running.write_running(want.drop("count"), sink, 4, ["extension"], running.ORDER)  # complete already: nothing happens
    assert sorted(map(tuple, running.read(spark, sink).collect())) == rows


# ---- C9: keyed state -----------------------------------------------------------------------------
def history(seed, n, hours):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = (T0 + dt.timedelta(seconds=r.randrange(hours * 3600))).strftime("%Y-%m-%dT%H:%M:%SZ")
        rows.append(commit(f"s{i}", repo=f"r{r.randrange(2)}", date=t,
                           files=[file(r.choice(["a", "b", "c", None]) and f"f{r.randrange(12)}", status=r.choice(["added", "removed", "modified", None]))]))
    return rows


def streamed(spark, tmp_path, commits, within, batches, lateness="0 seconds"):
    source = Feed(spark, str(tmp_path / "source"), commits.schema)
    q = jobs.start(sequence.added_then_removed_keyed(source.stream(), within, lateness), str(tmp_path / "out"), "keyed", trigger=NOW,
                   checkpoint=str(tmp_path / "ck"))
    feed(q, [source], [batches])
    out = spark.read.schema(sequence.OUT).parquet(str(tmp_path / "out"))
    return sorted(map(tuple, out.distinct().collect())), q


@pytest.mark.parametrize("within", ["1 hour", "1 day"])
def test_keyed_match_equals_all_pairs(spark, tmp_path, within):
    df = commits_df(spark, history(1, 250, 60)).withColumn("at", F.col("commit.committer.date")).cache()
    got, _ = streamed(spark, tmp_path, df, within, time_batches(df, 6, "at"))
    assert got == sorted(map(tuple, added_removed_pairs(df, within).collect()))
    assert got == sorted(map(tuple, sq.added_then_removed(df, within).collect()))


def test_out_of_order_within_the_lateness(spark, tmp_path):
    df = commits_df(spark, history(2, 200, 20)).cache()
    batches = [df.filter(F.pmod(F.hash("sha"), F.lit(3)) == i) for i in range(3)]  # in no order of time at all
    got, _ = streamed(spark, tmp_path, df, "3 hours", batches, "30 hours")
    assert got == sorted(map(tuple, added_removed_pairs(df, "3 hours").collect()))


def test_a_match_leaves_before_any_window_closes(spark, tmp_path):
    rows = [commit("a", date="2024-03-01T00:00:00Z", files=[file("f", status="added")]),
            commit("b", date="2024-03-01T00:10:00Z", files=[file("f", status="removed")])]
    df = commits_df(spark, rows)
    got, _ = streamed(spark, tmp_path, df, "1 day", [df])
    assert got == [("o/r", "f")]


def test_state_is_bounded_and_expires(spark, tmp_path):
    """A hot file with thousands of additions keeps a few numbers; quiet files' state goes by timer."""
    hot = [commit(f"h{i}", date=(T0 + dt.timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ"), files=[file("hot", status="added")]) for i in range(1500)]
    cold = [commit(f"c{i}", date=T0.strftime("%Y-%m-%dT%H:%M:%SZ"), files=[file(f"cold{i}", status="added")]) for i in range(200)]
    later = [commit("end", date=(T0 + dt.timedelta(days=9)).strftime("%Y-%m-%dT%H:%M:%SZ")), commit("end2", date=(T0 + dt.timedelta(days=10)).strftime("%Y-%m-%dT%H:%M:%SZ"))]
    batches = [commits_df(spark, x) for x in (hot + cold, later[:1], later[1:])]
    got, q = streamed(spark, tmp_path, batches[0], "1 hour", batches)
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert got == [] and max(rows) == 201 and rows[-1] == 0


def test_buckets_stay_few():
    buckets = {}
    for us in range(0, 50_000_000, 7):
        sequence.merge(buckets, us // 10_000_000, [us, us, None, None])
        if len(buckets) > 3:
            buckets = {b: t for b, t in buckets.items() if (b + 2) * 10_000_000 > us}
    assert len(buckets) <= 3 and not sequence.matches(buckets, set(buckets), 10_000_000)
