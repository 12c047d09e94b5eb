"""One fixture per decision row of FIXTURES.md §5 (batch commit analytics)."""

import hashlib

from pyspark.sql import functions as F

from sparklytics.operators import commit_collections as coll
from sparklytics.operators import commit_frames as frames
from sparklytics.operators import commit_pairs as pairs
from sparklytics.operators import graph

from .helpers import commit, commits_df, file


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect())


def test_d2_week_and_calendar_year(spark):
    df = commits_df(spark, [commit("c1", date="2018-12-31T10:00:00Z")])
    assert rows(frames.weekly_commits_per_repo(df)) == [("r", 1, 2018, 1)]
    assert rows(frames.weekly_commits_per_repo(df, iso_year=True)) == [("r", 1, 2019, 1)]


def test_d4_branch_points_only_present_parents(spark):
    df = commits_df(spark, [commit("c1"), commit("c2", parents=["c1"]), commit("c3", parents=["c1"]),
                            commit("c4", parents=["missing"]), commit("c5", parents=["missing"])])
    assert rows(frames.branch_points(df)) == [("c1", 2)]


def test_d5_fork_points(spark):
    df = commits_df(spark, [commit("p", owner="a"), commit("c", owner="b", parents=["p"]),
                            commit("s", owner="a", parents=["p"])])
    assert rows(frames.fork_points(df)) == [("a/r", "b/r", "p", "c")]


def test_d6_extensions(spark):
    names = ["a.b.c", "Makefile", "foo.", "...", ".gitignore", None, "a.b/Makefile"]
    df = commits_df(spark, [commit("c1", files=[file(n, sha=f"s{i}") for i, n in enumerate(names)])])
    got = dict(rows(pairs.file_extension_counts(df)))
    assert got == {"c": 1, "unknown": 5, "gitignore": 1}


def test_d7_rank_ties_by_name(spark):
    data = [("b", 2), ("a", 2), ("c", 5)]
    df = commits_df(spark, [commit(f"{n}{i}", author=n) for n, k in data for i in range(k)])
    assert [tuple(r) for r in pairs.author_rank(df).orderBy("rank").collect()] == [(0, "c", 5), (1, "a", 2), (2, "b", 2)]


def test_b3_global_rank_matches_single_task_window(spark):
    from pyspark.sql import Window
    from sparklytics.operators.ordering import global_rank
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("n"), F.concat(F.lit("u"), F.col("id")).alias("name"))
    df = df.repartition(7)
    order = [F.col("n").desc(), F.col("name").asc()]
    a = global_rank(df, order).select("rank", "name")
    b = df.select((F.row_number().over(Window.orderBy(*order)) - 1).alias("rank"), "name")
    assert rows(a) == rows(b)


def test_d8_symmetric_difference(spark):
    df = commits_df(spark, [commit("1", author="x", owner="y"), commit("2", author="y", owner="z")])
    assert rows(pairs.exclusive_owners_or_authors(df)) == [("x",), ("z",)]


def test_d9_longest_revert_streak(spark):
    msgs = ["Revert a", 'Revert "Revert b', 'Revert "Revert c', "Oops, Revert"]
    df = commits_df(spark, [commit(str(i), author="p", message=m) for i, m in enumerate(msgs)])
    assert rows(pairs.longest_revert_streak(df)) == [("p", 2, 2)]


def test_d10_latest_file_per_repo(spark):
    df = commits_df(spark, [
        commit("1", repo="r1", date="2019-01-01T00:00:00Z", files=[file("f.txt", additions=1)]),
        commit("2", repo="r1", date="2019-02-01T00:00:00Z", files=[file("f.txt", additions=2)]),
        commit("3", repo="r2", date="2019-03-01T00:00:00Z", files=[file("f.txt", additions=3)]),
        commit("4", repo="r2", date="2019-01-01T00:00:00Z", files=[file("f.txt", additions=4), file(None)]),
    ])
    assert rows(pairs.latest_files_per_repo(df), "repository", "filename", "additions") == [
        ("r1", "f.txt", 2), ("r2", "f.txt", 3)]
    nested = pairs.latest_files_per_repo(df, nested=True)
    assert sorted((r["repository"], len(r["files"])) for r in nested.collect()) == [("r1", 1), ("r2", 1)]


def test_d11_optional_stats_per_committer_and_repo(spark):
    df = commits_df(spark, [commit("1", committer="n", stats=None), commit("2", committer="n", stats=None),
                            commit("3", committer="z", stats=(0, 0, 0))])
    got = {r["committer"]: r["stats"] for r in pairs.committer_repo_stats(df).collect()}
    assert got["n"] is None and tuple(got["z"]) == (0, 0, 0)


def test_b4_stats_totals_absent_stats_zero(spark):
    df = commits_df(spark, [commit("1", committer="u", stats=(3, 2, 1)), commit("2", committer="u"),
                            commit("3", committer="v", stats=(9, 9, 0))])
    assert rows(pairs.committer_stats_totals(df, ["u", "ghost"])) == [("u", 3, 2, 1)]


def test_b7_b9_repo_overviews(spark):
    df = commits_df(spark, [commit("1", committer="x", files=[file("a", additions=1, deletions=2)]),
                            commit("2", committer="y", files=[file("a", additions=3, deletions=0)]),
                            commit("3", committer="x", repo="q")])
    assert rows(pairs.repo_commits_and_committers(df, nested=True), "repository", "commits") == [("q", 1), ("r", 2)]
    assert rows(pairs.repo_commit_totals(df), "repository", "commits") == [("q", 1), ("r", 2)]
    r = pairs.repo_file_overview(df, "r", nested=True).collect()[0]
    assert (r["filename"], r["shas"], r["total"], r["additions"], r["deletions"]) == ("a", ["1", "2"], 6, 4, 2)
    assert rows(pairs.repo_file_overview(df, "r")) == [("a", "1", 6, 4, 2), ("a", "2", 6, 4, 2)]


def _jdk_name_uuid_msb(s: str) -> int:
    hexdigest = hashlib.md5(s.encode("utf-8")).hexdigest().lstrip("0")
    b = bytearray(hashlib.md5(hexdigest.encode("ascii")).digest())
    b[6] = (b[6] & 0x0F) | 0x30
    b[8] = (b[8] & 0x3F) | 0x80
    return int.from_bytes(bytes(b[:8]), "big", signed=True)


def test_b11_md5_long_id(spark):
    names = ["", "Näzell", "GitHub", "repo3"]
    zero = next(f"x{i}" for i in range(10000) if hashlib.md5(f"x{i}".encode()).hexdigest().startswith("0"))
    names.append(zero)
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = {r["s"]: r["id"] for r in df.select("s", graph.md5_long_id(F.col("s")).alias("id")).collect()}
    assert got == {n: _jdk_name_uuid_msb(n) for n in names}


def test_b12_graph(spark):
    df = commits_df(spark, [commit("1", committer="x", repo="r"), commit("2", committer="x", repo="q"),
                            commit("3", committer="y", repo="r")])
    v, e = graph.developer_repo_graph(df)
    assert v.count() == 4 and e.count() == 3
    deg = {r["name"]: r["degree"] for r in graph.graph_degrees(v, e).collect()}
    assert deg == {"x": 2, "y": 1, "r": 2, "q": 1}
    one_pass = {(r["id"], r["kind"], r["name"], r["degree"]) for r in graph.developer_repo_degrees(df).collect()}
    assert one_pass == {(r["id"], r["kind"], r["name"], r["degree"]) for r in graph.graph_degrees(v, e).collect()}


def test_d17_avg_additions_only_with_stats(spark):
    df = commits_df(spark, [commit("1"), commit("2", stats=(10, 10, 0)), commit("3", stats=(15, 15, 0))])
    assert rows(coll.avg_additions(df)) == [(12,)]


def test_d18_top_committer_exact_repo(spark):
    df = commits_df(spark, [commit("1", repo="r", committer="a"), commit("2", repo="rr", committer="b"),
                            commit("3", repo="rr", committer="b")])
    assert rows(coll.top_committer_of_repo(df, "r")) == [("a", 1)]
    assert rows(coll.top_committer_of_repo(df, "o/rr")) == [("b", 2)]


def test_d25_oid_column(spark):
    df = commits_df(spark, [commit("s1", _id="m1", date="2019-01-01T00:00:00Z"),
                            commit("s2", _id="m2", date="2019-01-04T00:00:00Z")])
    got = rows(frames.days_since_previous_commit(df, "a", id_col="_id"), "$oid", "time_diff")
    assert got == [("m1", 0), ("m2", 3)]
    assert rows(frames.days_since_previous_commit(df, "a"), "$oid") == [("s1",), ("s2",)]


def test_a4_lag_across_buckets_equals_plain_lag(spark):
    from pyspark.sql import Window
    data = [commit(f"s{i}", committer=f"p{i % 3}", date=f"2019-0{1 + i % 3}-{1 + (i * 7) % 27:02d}T{i % 24:02d}:00:00Z")
            for i in range(60)]
    df = commits_df(spark, data)
    got = rows(frames.days_since_previous_commit(df, None, bucket="month"), "$oid", "time_diff")
    flat = df.select(F.col("sha").alias("oid"), F.col("commit.committer.name").alias("n"),
                     F.col("commit.committer.date").alias("d"))
    w = Window.partitionBy("n").orderBy("d", "oid")
    ref = flat.select("oid", F.coalesce(F.datediff(F.to_date("d"), F.to_date(F.lag("d").over(w))), F.lit(0)).alias("t"))
    assert got == rows(ref)


def test_d26_repo_name_vs_full_name(spark):
    df = commits_df(spark, [commit("1", owner="o1"), commit("2", owner="o2")])
    assert rows(frames.weekly_commits_per_repo(df), "repository", "count") == [("r", 2)]
    assert rows(frames.weekly_commits_per_repo(df, use_full_name=True), "repository") == [("o1/r",), ("o2/r",)]


def test_a1_a3_a6(spark):
    df = commits_df(spark, [commit("2", author="x", date="2019-01-02T00:00:00Z", author_date="2019-01-01T23:59:00Z"),
                            commit("1", author="y", date="2019-01-01T00:00:00Z")])
    assert [r["sha"] for r in frames.commits_by_authors(df, ["x", "y"]).collect()] == ["1", "2"]
    assert rows(frames.commits_by_authors(df, ["x"] + [f"n{i}" for i in range(20000)]), "sha") == [("2",)]
    age = {r["sha"]: r["age"] for r in frames.commit_age_seconds(df, "2019-01-02T00:00:10Z").collect()}
    assert age == {"1": 86410, "2": 10}
    lag = {r["sha"]: r["commit_time_diff"] for r in frames.author_committer_lag_seconds(df).collect()}
    assert lag == {"1": 0, "2": 60}


def test_a5_weekday_sunday_is_one(spark):
    df = commits_df(spark, [commit("1", date="2019-06-02T12:00:00Z"), commit("2", date="2019-06-08T12:00:00Z")])
    assert rows(frames.commits_per_weekday(df)) == [(1, 1), (7, 1)]


def test_d2_d4_d5_collection_family(spark):
    df = commits_df(spark, [
        commit("1", date="2019-05-01T13:30:00Z", files=[file("a.js"), file("b.js", sha="x"), file("Makefile")]),
        commit("2", date="2018-05-01T14:30:00Z", files=[file("c.js"), file("d.py")]),
    ])
    assert rows(coll.peak_js_hour(df)) == [(13, 2)]
    assert rows(coll.commits_per_repo_in_year(df, 2019)) == [("o/r", 1)]
    assert [tuple(r) for r in coll.top_file_formats(df, 2).collect()] == [("js", 3), ("Makefile", 1)]


def test_order_independence_batch(spark):
    from sparklytics.sources.commits import commit_view
    c = commit_view(spark, "/root/testdata/sf0.001")
    for fn in (pairs.author_rank, pairs.latest_files_per_repo, frames.fork_points,
               lambda df: frames.days_since_previous_commit(df, None)):
        assert rows(fn(c.repartition(1))) == rows(fn(c.repartition(7, F.rand(5))))


def test_checkpoint_dir_comes_from_the_session(spark):
    from sparklytics.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_flat_file_view_equals_exploded_commit_view(spark):
    from sparklytics.functions.fields import file_rows
    from sparklytics.sources.commits import commit_file_view, commit_view
    d = "/root/testdata/sf0.001"
    cols = ["sha", "url", F.col("commit.committer.date").alias("d"), F.col("commit.author.name").alias("a"), "file"]
    a = file_rows(commit_view(spark, d)).select(*cols)
    b = commit_file_view(spark, d).select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
