"""Nulls, odd inputs, skewed keys, readers and sinks: one fixture per corrected case."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sparklytics.operators import commit_frames as frames
from sparklytics.operators import commit_pairs as pairs
from sparklytics.operators import graph, lists, logs
from sparklytics.operators.ordering import previous_in_group
from sparklytics.sources import commits as src
from sparklytics.streaming import jobs
from sparklytics.streaming import queries as sq
from sparklytics.streaming.replay import replay

from .helpers import commit, commits_df

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_committers_and_dates_have_predecessors(spark):
    day = [dt.datetime(2020, 1, d, 12) for d in (1, 5, 5)]
    df = spark.createDataFrame([(None, day[0], "a"), (None, day[1], "b"), ("x", day[0], "c"), ("x", day[2], "d"),
                                ("x", None, "e"), ("x", None, "f")], "name string, date timestamp, sha string")
    got = {r["sha"]: r["prev_date"] for r in previous_in_group(
        df, ["name"], ["date", "sha"], ["date"], F.date_trunc("day", "date")).collect()}
    assert got["b"] == got["d"] == day[0] and got["a"] is None


def test_same_name_of_developer_and_repository(spark):
    df = commits_df(spark, [commit("1", repo="spring", committer="spring"), commit("2", repo="q", committer="spring"),
                            commit("3", repo="spring", committer="ann")])
    v, e = graph.developer_repo_graph(df)
    assert v.select("id", "kind").distinct().count() == v.count() == 4
    deg = {(r["name"], r["kind"]): r["degree"] for r in graph.graph_degrees(v, e).collect()}
    assert deg[("spring", "developer")] == deg[("spring", "repository")] == 2
    assert rows(graph.graph_degrees(v, e)) == rows(graph.developer_repo_degrees(df))


def test_odd_log_line_does_not_stop_the_job(spark):
    line = '10.0.0.1 - - [10/Mar/2004:12:02:59 +0000] "POST /a b HTTP/1.1" 200 99'
    df = spark.createDataFrame([(0, line)], "line_no long, value string")
    assert [tuple(r)[3:] for r in logs.post_requests(df).collect()] == [(None, 200)]


def test_deep_flatten_of_nulls_and_objects(spark):
    df = spark.createDataFrame([("[1,[null,2],\"null\"]",), ('[{"a":1}]',), ('["{x"]',), (None,)], "j string")
    got = [r[0] for r in df.select(lists.json_flatten_deep("j", "bigint")).collect()]
    assert got == [[1, None, 2, None], None, [None], None]
    assert df.select(lists.json_flatten_deep("j")).first()[0] == ["1", "null", "2", '"null"']


def test_average_truncates_toward_zero(spark):
    df = spark.createDataFrame([([-3, -4],), ([2 ** 60, 2 ** 60 + 1],)], "xs array<bigint>")
    assert [r[0] for r in df.select(lists.list_avg_first_n_above("xs", -10, 3)).collect()] == [-3, 2 ** 60]


def test_every_list_keeps_a_total(spark):
    df = spark.createDataFrame([("a", 1, 30), ("a", 2, 40), ("b", 1, 3), ("c", 1, None)], "list_id string, pos int, value int")
    assert rows(lists.sum_first_n_above(df)) == [("a", 70), ("b", 0), ("c", 0)]


def test_names_as_a_table(spark):
    df = commits_df(spark, [commit("1", committer="x"), commit("2", committer="y")])
    names = spark.createDataFrame([("x",), ("x",), (None,)], "n string")
    assert [r["sha"] for r in frames.commits_by_authors(df, names).collect()] == ["1"]
    assert "Broadcast" not in frames.commits_by_authors(df, [f"n{i}" for i in range(20_000)])._jdf.queryExecution().toString()


def test_stats_view_sums_like_commits(spark):
    users = ["GitHub", "own3", "own17"]
    flat = pairs.committer_stats_totals(src.commit_stats_view(spark, SF), users)
    assert rows(flat) == rows(pairs.committer_stats_totals(src.commit_view(spark, SF), users))
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index(" IN ") if " IN " in plan else "In" in plan


@pytest.fixture()
def small_partitions(spark):
    new = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_parent_is_split(spark, small_partitions, tmp_path):
    made = [commit("p", owner="o", repo="up")] + [commit(f"c{i}", owner=f"o{i}", repo="fork", parents=["p"] if i % 10 else [f"c{i - 1}"])
                                                for i in range(1, 1500)]
    commits_df(spark, made).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    out = frames.fork_points(stored)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 1499


def test_hot_file_overview_is_spread(spark, small_partitions):
    made = commits_df(spark, [commit(f"c{i}", files=[{"sha": "s", "filename": "hot" if i % 10 else f"f{i}", "status": "added",
                                                     "additions": 1, "deletions": 0, "changes": 1}]) for i in range(1000)])
    out = pairs.repo_file_overview(made, "r")
    per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max("total")).collect()
    assert max(r["n"] for r in per) < 0.4 * sum(r["n"] for r in per)
    assert {r["total"] for r in out.filter("filename = 'hot'").collect()} == {900}


def test_daily_summary_gathers_nobody(spark):
    plan = sq.daily_repo_summary(commits_df(spark, []))._jdf.queryExecution().toString()
    assert "collect_list" not in plan


# ---- readers --------------------------------------------------------------------------------------
def test_plain_object_id_and_broken_documents(spark, tmp_path):
    good = {"_id": {"$oid": "5ce6"}, "sha": "a"}
    (tmp_path / "x.json").write_text(json.dumps(good) + "\n" + json.dumps({"_id": "plain", "sha": "b"}) + "\n")
    df = src.read_commits(spark, str(tmp_path))
    assert rows(df.select("sha", "_id")) == [("a", "5ce6"), ("b", "plain")]
    (tmp_path / "y.json").write_text('{"sha": "c", "stats": \n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        src.read_commits(spark, str(tmp_path)).collect()
    kept = src.read_commits(spark, str(tmp_path), quarantine=True).select("sha", src.CORRUPT).collect()
    assert len(kept) == 3 and sum(r[src.CORRUPT] is not None for r in kept) == 1


def test_geo_reader(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"sha": "a", "createdAt": "2019-06-26T11:00:00Z", "continent": "eu"}\n')
    assert src.read_geo(spark, str(tmp_path)).first()["continent"] == "eu"
    q = (src.read_geo_stream(spark, str(tmp_path)).writeStream.format("memory").queryName("geo_rows")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("geo_rows").first()["sha"] == "a"


# ---- replay and sinks -----------------------------------------------------------------------------
def _with_null_times(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return ev.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.col("ts")))


def test_replay_keeps_rows_without_a_timestamp(spark):
    ev = _with_null_times(spark)
    out = replay(spark, ev, lambda s: sq.commit_shas(src.events_to_commits(s)), n_batches=3, sentinel=False)
    assert out.count() == ev.count()
    nothing = ev.withColumn("ts", F.lit(None).cast(ev.schema["ts"].dataType))
    assert replay(spark, nothing, lambda s: sq.commit_shas(src.events_to_commits(s)), n_batches=3).count() == ev.count()


def test_replay_in_another_time_zone(spark):
    from sparklytics.plans.catalog import QUERIES
    expected = rows(QUERIES["stream_daily_commits"](spark, SF))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            src.event_commit_view(spark, SF)
        assert rows(QUERIES["stream_daily_commits_replay"](spark, SF)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_replay_leaves_only_the_sink(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    replay(spark, ev, lambda s: sq.commit_shas(src.events_to_commits(s)), n_batches=2, sentinel=False, workdir=str(tmp_path / "w"))
    assert [p.name for p in (tmp_path / "w").iterdir()] == ["sink"]


def test_sinks_survive_a_crash_and_a_retry(spark, tmp_path):
    def batch(*pairs_):
        return spark.createDataFrame(list(pairs_), "extension string, count long")
    out = str(tmp_path / "complete")
    jobs.write_complete(batch(("a", 1)), out, 0)
    jobs.write_complete(batch(("a", 2), ("b", 1)), out, 1)
    half = tmp_path / "complete" / "epoch-0000000002"  # the writer died before it committed
    half.mkdir()
    (half / "part-x.parquet").write_text("broken")
    assert rows(jobs.read_complete(spark, out)) == [("a", 2), ("b", 1)]
    jobs.write_complete(batch(("a", 3)), out, 2)  # the restarted job runs the batch again
    assert rows(jobs.read_complete(spark, out)) == [("a", 3)]

    out = str(tmp_path / "update")
    for n in range(9):
        jobs.write_update(batch(("a", n), (f"k{n}", n)), out, n, ["extension"], compact_every=3)
        jobs.write_update(batch(("a", n), (f"k{n}", n)), out, n, ["extension"], compact_every=3)  # a retry
    assert rows(jobs.read_latest(spark, out, ["extension"])) == sorted([("a", 8), *((f"k{n}", n) for n in range(9))])
    assert len(list((tmp_path / "update").iterdir())) < 9
