"""Readers: commit JSON (multi-line and JSON lines), commit JSON as a stream, ordered lines."""

import json

from sparklytics.operators import commit_frames as frames
from sparklytics.operators import commit_pairs as pairs
from sparklytics.sources.commits import read_commit_stream, read_commits
from sparklytics.streaming import queries as sq


def _doc(sha, name, date, files=(), stats=None):
    return {"_id": "x" + sha, "sha": sha, "url": f"https://api.github.com/repos/own/rep/commits/{sha}",
            "commit": {"author": {"name": name, "email": "e", "date": date},
                       "committer": {"name": name, "email": "e", "date": date},
                       "message": "Revert x", "tree": {"sha": "t"}, "comment_count": 0,
                       "verification": {"verified": False, "reason": "unsigned"}},
            "parents": [], "stats": stats, "files": list(files), "unknown_field": 1}


DOCS = [_doc("a", "n1", "2019-01-27T07:09:13.000Z", [{"filename": "x.py", "additions": 1, "deletions": 0,
                                                      "changes": 1, "status": "added"}], {"total": 1, "additions": 1,
                                                                                          "deletions": 0}),
        _doc("b", "n1", "2019-01-28T08:00:00Z"),
        _doc("c", "n2", "2019-01-28T09:30:00.000Z")]


def test_read_commits_multiline_and_lines(spark, tmp_path):
    (tmp_path / "multi.json").write_text(json.dumps(DOCS, indent=2))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "part.json").write_text("\n".join(json.dumps(d) for d in DOCS))
    for df in (read_commits(spark, str(tmp_path / "multi.json"), multi_line=True),
               read_commits(spark, str(tmp_path / "lines"))):
        assert df.count() == 3
        # 2019-01-27 is the Sunday closing ISO week 4
        assert sorted(tuple(r) for r in frames.weekly_commits_per_repo(df).collect()) == [
            ("rep", 4, 2019, 1), ("rep", 5, 2019, 2)]
        assert [tuple(r) for r in pairs.file_extension_counts(df).collect()] == [("py", 1)]
        first = df.orderBy("sha").first()
        assert first["commit"]["committer"]["date"].isoformat().startswith("2019-01-27T07:09:13")


def test_read_commit_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps(d) for d in DOCS))
    stream = read_commit_stream(spark, str(src), max_files_per_trigger=1)
    q = (sq.extension_status_counts(stream).writeStream.outputMode("complete").format("memory")
         .queryName("ext_status_check").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [tuple(r) for r in spark.table("ext_status_check").collect()] == [("py", "added", 1)]


def test_stream_job_on_commit_json(spark, tmp_path):
    from sparklytics.streaming import jobs
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps(d) for d in DOCS))
    stream = read_commit_stream(spark, str(src))
    q = jobs.start(sq.daily_commits(stream), str(tmp_path / "out"), "daily_check",
                   trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    # the last day stays open in append mode until later data moves the watermark
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("27-01-2019", 1)]
    later = _doc("d", "n3", "2019-02-05T00:00:00Z")
    (src / "b.json").write_text(json.dumps(later))
    q = jobs.start(sq.daily_commits(read_commit_stream(spark, str(src))), str(tmp_path / "out"), "daily_check2",
                   trigger={"availableNow": True}, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("27-01-2019", 1), ("28-01-2019", 2)]


def test_read_commits_with_inferred_schema(spark, tmp_path):
    (tmp_path / "multi.json").write_text(json.dumps(DOCS, indent=2))
    df = read_commits(spark, str(tmp_path / "multi.json"), multi_line=True, infer_schema=True)
    assert dict(df.select("commit.committer.date").dtypes)["date"] == "timestamp"
    assert sorted(tuple(r) for r in frames.weekly_commits_per_repo(df).collect()) == [
        ("rep", 4, 2019, 1), ("rep", 5, 2019, 2)]
