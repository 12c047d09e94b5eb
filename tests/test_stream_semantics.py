"""Watermark semantics (late rows) and a two-source interval join, on JSON commit streams."""

import json

from pyspark.sql import functions as F

from sparklytics.schemas import COMMIT_GEO
from sparklytics.sources.commits import read_commit_stream
from sparklytics.streaming import jobs
from sparklytics.streaming import queries as sq

from .helpers import commit


def _dump(path, rows):
    def enc(o):
        return o.isoformat().replace("+00:00", "Z")
    path.write_text("\n".join(json.dumps(r, default=enc) for r in rows))


def _run(spark, src, out, ck, build, watermark):
    stream = read_commit_stream(spark, str(src), max_files_per_trigger=1)
    q = jobs.start(build(stream, watermark), str(out), f"late_{watermark.split()[0]}",
                   trigger={"availableNow": True}, checkpoint=str(ck))
    q.awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(str(out)).collect())


def test_late_rows_follow_the_watermark(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    # one file per micro-batch, in arrival order.  A micro-batch evicts windows with the
    # watermark of the previous batch and drops late rows with the one before that (Spark
    # keeps that lag so chained stateful operators agree), hence the extra batch 2.
    _dump(src / "1.json", [commit("a", date="2019-06-26T10:00:00Z"), commit("b", date="2019-06-27T12:00:00Z")])
    _dump(src / "2.json", [commit("c", date="2019-06-27T13:00:00Z")])
    _dump(src / "3.json", [commit("late", date="2019-06-26T11:00:00Z")])
    _dump(src / "4.json", [commit("sentinel", date="2019-09-01T00:00:00Z")])
    import os
    import time
    for i, name in enumerate(("1.json", "2.json", "3.json", "4.json")):  # distinct modification times
        os.utime(src / name, (time.time() + i, time.time() + i))
    strict = _run(spark, src, tmp_path / "o1", tmp_path / "c1", lambda s, w: sq.daily_commits(s, watermark=w),
                  "0 seconds")
    lenient = _run(spark, src, tmp_path / "o2", tmp_path / "c2", lambda s, w: sq.daily_commits(s, watermark=w),
                   "14 hours")
    # 0 s: the watermark reached 27-06 12:00 and day 26 was closed, the late row is dropped.
    # 14 h: the watermark is at most 26-06 23:00, day 26 is still open, the late row is counted.
    assert strict == [("26-06-2019", 1), ("27-06-2019", 2)]
    assert lenient == [("26-06-2019", 2), ("27-06-2019", 2)]


def test_interval_join_of_two_streams(spark, tmp_path):
    csrc, gsrc = tmp_path / "commits", tmp_path / "geo"
    csrc.mkdir()
    gsrc.mkdir()
    commits = [commit(s, date="2019-06-26T12:00:00Z", files=[{"sha": s, "filename": "A.java", "status": "added",
                                                              "additions": 2, "deletions": 0, "changes": 2}])
               for s in ("a", "b", "c")]
    commits.append(commit("end", date="2019-09-01T00:00:00Z"))
    _dump(csrc / "c.json", commits)
    geo = [{"sha": "a", "createdAt": "2019-06-26T11:00:00Z", "continent": "eu"},
           {"sha": "b", "createdAt": "2019-06-26T12:30:00Z", "continent": "eu"},
           {"sha": "c", "createdAt": "2019-06-26T12:31:00Z", "continent": "eu"},
           {"sha": "end", "createdAt": "2019-09-01T00:00:00Z", "continent": "x"}]
    (gsrc / "g.json").write_text("\n".join(json.dumps(g) for g in geo))
    cs = read_commit_stream(spark, str(csrc))
    gs = spark.readStream.schema(COMMIT_GEO).json(str(gsrc))
    out = tmp_path / "out"
    q = jobs.start(sq.weekly_java_changes_by_continent(cs, gs), str(out), "two_streams",
                   trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(str(out)).select("continent", "amount").collect()]
    assert got == [("eu", 4)]  # a (-60 min) and b (+30 min) match, c (+31 min) does not
