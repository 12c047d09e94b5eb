"""Late rows: what the windowed analytics see and the side table are together the input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparklytics.sources.commits import event_commit_view, events_to_commits, events_to_geo
from sparklytics.streaming import jobs, late, sequence
from sparklytics.streaming import queries as sq
from sparklytics.streaming.replay import Feed, feed

SF = "/root/testdata/sf0.001"
NOW = {"processingTime": "0 seconds"}
T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def planted(spark):
    """Three batches of events: the last one has rows of the first day again, long after it."""
    ev = spark.read.parquet(f"{SF}/events.parquet").orderBy("event_id").limit(300)
    rows = ev.withColumn("ts", F.lit(T0).cast("timestamp").cast(ev.schema["ts"].dataType)
                         + F.make_dt_interval(F.lit(0), F.col("event_id").cast("int"), F.lit(0)))
    first, second = rows.filter("event_id < 100"), rows.filter("event_id BETWEEN 100 AND 199")
    behind = F.col("event_id") % 4 == 0
    third = rows.filter("event_id >= 200").withColumn("ts", F.when(behind, F.col("ts") - F.expr("INTERVAL 200 hours"))
                                                      .when(F.col("event_id") == 203, None).otherwise(F.col("ts")))
    end = rows.limit(1).withColumn("event_id", F.lit(10_000).cast("bigint")).withColumn("ts", F.col("ts") + F.expr("INTERVAL 200 days"))
    return rows.schema, [first, second, third, end]


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("late")
    schema, batches = planted(spark)
    source = Feed(spark, str(base / "source"), schema)
    sink = str(base / "split")
    q = late.split(source.stream(), sink, "split", "ts", "10 hours", trigger=NOW, checkpoint=str(base / "state"))
    feed(q, [source], [batches])
    return base, schema, sink


def test_side_table_has_exactly_the_planted_rows(spark, split):
    _, schema, sink = split
    side = late.late_rows(spark, sink, schema)
    assert {(r["event_id"], r["epoch"]) for r in side.collect()} == {(i, 2) for i in range(200, 300, 4)}
    assert side.columns == [*schema.names, "epoch"]
    per = [(r["epoch"], r["rows"], r["late_rows"]) for r in late.counts(spark, sink).orderBy("epoch").collect()]
    assert per == [(0, 100, 0), (1, 100, 0), (2, 100, 25), (3, 1, 0)]


BUILT = {
    "C5": lambda ev: sq.daily_commits(events_to_commits(ev)),
    "C6": lambda ev: sq.size_class_counts(events_to_commits(ev)),
    "C7": lambda ev: sq.daily_repo_summary(events_to_commits(ev), min_commits=0, max_committers=99),
    "C8": lambda ev: sq.weekly_java_changes_by_continent(events_to_commits(ev), events_to_geo(ev), geo_watermark="2 hours"),
    "C9": lambda ev: sq.added_then_removed_stream(events_to_commits(ev)),
    "C9 keyed": lambda ev: sequence.added_then_removed_keyed(events_to_commits(ev)),
}


@pytest.mark.parametrize("name", BUILT)
def test_nothing_behind_the_split_is_dropped(spark, split, name):
    base, schema, sink = split
    key = name.replace(" ", "_")
    rows = late.on_time(spark, sink, schema)
    q = jobs.start(BUILT[name](rows), str(base / f"out-{key}"), f"on_time_{key}", trigger=NOW, checkpoint=str(base / f"ck-{key}"))
    try:
        q.processAllAvailable()
        assert late.dropped_rows(q) == 0
    finally:
        q.stop()
    out = spark.read.parquet(str(base / f"out-{key}"))
    late_n = late.late_rows(spark, sink, schema).count()
    whole = 100 + 100 + 100  # but for the row far ahead, whose windows stay open
    no_time = 1  # belongs to no window
    if name == "C5":
        assert out.agg(F.sum("count")).first()[0] + late_n + no_time == whole
    if name == "C6":  # four windows have each row
        assert out.agg(F.sum("count")).first()[0] == 4 * (whole - late_n - no_time)
    if name == "C7":
        assert out.agg(F.sum("amountOfCommits")).first()[0] + late_n + no_time == whole
    if name.startswith("C9"):
        seen = spark.read.schema(schema).parquet(f"{sink}/epoch-*/rows/{late.BEHIND}=false")
        want = sq.added_then_removed(events_to_commits(seen))
        assert sorted(map(tuple, out.distinct().collect())) == sorted(map(tuple, want.collect()))


def test_without_a_split_drops_are_counted(spark, tmp_path):
    schema, batches = planted(spark)
    source = Feed(spark, str(tmp_path / "source"), schema)
    listener = late.DropCounter()
    spark.streams.addListener(listener)
    q = jobs.start(sq.daily_commits(events_to_commits(source.stream()), watermark="10 hours"), str(tmp_path / "out"), "unsplit", trigger=NOW,
                   checkpoint=str(tmp_path / "ck"))
    feed(q, [source], [batches])
    kept = spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).first()[0]
    # counts are of pre-aggregated rows where Spark combines before it drops, so at least one, and never none
    assert late.dropped_rows(q) > 0 and kept < 299
    import time
    for _ in range(50):
        if listener.dropped["unsplit"]:
            break
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    assert listener.dropped["unsplit"] == late.dropped_rows(q)


def test_a_retry_of_an_epoch_changes_nothing(spark, tmp_path):
    sink = str(tmp_path / "split")
    ev = event_commit_view(spark, SF).select("sha", F.col("commit.committer.date").alias("ts"))
    late.write_split(ev, sink, 0, "ts", "0 seconds")
    late.write_split(ev.limit(5), sink, 1, "ts", "0 seconds")
    before = late.counts(spark, sink).orderBy("epoch").collect()
    late.write_split(ev.limit(5), sink, 1, "ts", "0 seconds")
    assert late.counts(spark, sink).orderBy("epoch").collect() == before and len(before) == 2
    assert late.late_rows(spark, str(tmp_path / "nothing"), ev.schema).count() == 0
