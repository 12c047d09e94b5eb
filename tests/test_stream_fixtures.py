"""Stream analytics on hand-made commits (static evaluation) and stream == batch replays."""

import datetime as dt

from pyspark.sql import functions as F

from sparklytics.streaming import queries as sq
from sparklytics.streaming.replay import replay
from sparklytics.sources.commits import events_to_commits, events_to_geo

from .helpers import commit, commits_df, file, ts


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect())


def test_c1_c2_c3_c4_null_safe(spark):
    df = commits_df(spark, [
        commit("1", stats=(25, 25, 0), files=[file("a.java"), file(None, deletions=40), file("b.scala", deletions=31)]),
        commit("2", stats=(1, 1, 0), files=[file("c.js", status="added"), file("d.py"), file("e.js", status="added")]),
    ])
    assert rows(sq.large_additions(df)) == [("1",)]
    assert rows(sq.large_deletion_files(df)) == [("b.scala",)]  # D13: a nameless file is skipped
    assert rows(sq.extension_counts(df)) == [("java", 1), ("scala", 1)]
    assert rows(sq.extension_status_counts(df)) == [("js", "added", 2), ("py", "modified", 1)]
    assert rows(sq.commit_shas(df)) == [("1",), ("2",)]


def test_c5_c6_windows(spark):
    df = commits_df(spark, [commit("1", date="2019-06-26T01:00:00Z", stats=(5, 5, 0)),
                            commit("2", date="2019-06-26T23:00:00Z", stats=(50, 50, 0)),
                            commit("3", date="2019-06-27T00:00:00Z")])
    assert rows(sq.daily_commits(df)) == [("26-06-2019", 2), ("27-06-2019", 1)]
    got = rows(sq.size_class_counts(df), "window_end", "size_class", "count")
    # every commit lands in 48h / 12h = 4 windows
    assert sum(c for _, _, c in got) == 12
    small = {e.strftime("%d %H"): c for e, k, c in got if k == "small"}  # commits 1 and 3 (no stats = 0)
    assert small == {"26 12": 1, "27 00": 1, "27 12": 2, "28 00": 2, "28 12": 1, "29 00": 1}


def test_d15_daily_repo_summary(spark):
    rows_ = []
    day = "2019-06-26T{:02d}:00:00Z"
    rows_ += [commit(f"a{i}", repo="one", committer="a", date=day.format(i % 24), stats=(1, 1, 0)) for i in range(11)]
    rows_ += [commit(f"b{i}", repo="one", committer="b", date=day.format(i % 24)) for i in range(11)]
    rows_ += [commit(f"c{i}", repo="two", committer="a", date=day.format(i % 24)) for i in range(20)]
    rows_ += [commit(f"d{i}", repo="three", committer=f"p{i % 3}", date=day.format(i % 24)) for i in range(21)]
    got = [tuple(r) for r in sq.daily_repo_summary(commits_df(spark, rows_)).collect()]
    assert got == [("o/one", "26-06-2019", 22, 2, 11, "a,b")]


def test_d16_added_then_removed(spark):
    t = "2019-06-26T00:00:00Z"
    df = commits_df(spark, [
        commit("1", repo="x", date=t, files=[file("f", status="added")]),
        commit("2", repo="x", date="2019-06-26T23:59:00Z", files=[file("f", status="removed")]),
        commit("3", repo="y", date=t, files=[file("g", status="added")]),
        commit("4", repo="y", date="2019-06-27T00:00:00Z", files=[file("g", status="removed")]),
        commit("5", repo="z", date=t, files=[file("h", status="removed")]),
        commit("6", repo="z", date="2019-06-26T01:00:00Z", files=[file("h", status="added")]),
        commit("7", repo="w", date="2019-06-26T22:00:00Z", files=[file("k", status="added")]),
        commit("8", repo="w", date="2019-06-27T03:00:00Z", files=[file("k", status="removed")]),
    ])
    assert rows(sq.added_then_removed(df)) == [("o/w", "k"), ("o/x", "f")]
    assert rows(sq.added_then_removed(df, within="1 hour")) == []


def test_c8_interval_join_bounds(spark):
    base = ts("2019-06-26T12:00:00Z")
    commits = commits_df(spark, [commit(s, date="2019-06-26T12:00:00Z", files=[file("A.java", additions=2)])
                                 for s in "abcd"] + [commit("e", files=[file("java", additions=5)])])
    offsets = {"a": -60, "b": 30, "c": -61, "d": 31, "e": 0}
    geo = spark.createDataFrame([(s, base + dt.timedelta(minutes=m), "eu") for s, m in offsets.items()],
                                "sha string, createdAt timestamp, continent string")
    got = rows(sq.weekly_java_changes_by_continent(commits, geo), "continent", "amount")
    assert got == [("eu", 4)]  # a and b match; the file literally named 'java' does not count (D24)


def _events(spark, d="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{d}/events.parquet")


def test_stream_equals_batch(spark):
    ev = _events(spark, "/root/testdata/sf0.01")
    static = events_to_commits(ev)
    for build in (sq.daily_commits, sq.size_class_counts, sq.daily_repo_summary):
        streamed = replay(spark, ev, lambda s: build(events_to_commits(s)), n_batches=5)
        assert rows(streamed) == rows(build(static))
    streamed = replay(spark, ev, lambda s: sq.weekly_java_changes_by_continent(events_to_commits(s), events_to_geo(s),
                                                                                     geo_watermark="2 hours"), n_batches=5)
    assert rows(streamed) == rows(sq.weekly_java_changes_by_continent(static, events_to_geo(ev)))
    streamed = replay(spark, ev, lambda s: sq.added_then_removed_stream(events_to_commits(s)), n_batches=5)
    assert rows(streamed.distinct()) == rows(sq.added_then_removed(static))


def test_append_windows_need_sentinel(spark):
    ev = _events(spark, "/root/testdata/sf0.01")
    without = replay(spark, ev, lambda s: sq.daily_commits(events_to_commits(s)), n_batches=4, sentinel=False)
    full = sq.daily_commits(events_to_commits(ev))
    assert without.count() < full.count()


def test_order_independence(spark):
    ev = _events(spark, "/root/testdata/sf0.01")
    c = events_to_commits(ev)
    for fn in (sq.daily_repo_summary, sq.added_then_removed, sq.extension_status_counts):
        assert rows(fn(c.repartition(1))) == rows(fn(c.repartition(7, F.rand(3))))


def test_c9_horizons_match_pairs(spark):
    from sparklytics.sources.commits import events_to_commits
    from .helpers import added_removed_pairs
    c = events_to_commits(_events(spark, "/root/testdata/sf0.01"))
    for within in ("3 days", "90 minutes", "1 day", "7 seconds"):
        assert rows(sq.added_then_removed(c, within)) == rows(added_removed_pairs(c, within)), within
