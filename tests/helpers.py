"""Hand-made commit records for edge-case fixtures."""

from __future__ import annotations

import datetime as dt

from sparklytics import schemas

UTC = dt.timezone.utc


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s.replace("Z", "+00:00")).astimezone(UTC)


def file(filename, status="modified", additions=1, deletions=0, changes=None, sha=None):
    return {"sha": sha or f"f-{filename}-{additions}-{deletions}", "filename": filename, "status": status,
            "additions": additions, "deletions": deletions,
            "changes": additions + deletions if changes is None else changes}


def commit(sha, *, owner="o", repo="r", author="a", committer=None, date="2019-01-01T00:00:00Z",
           author_date=None, message="m", parents=(), stats=None, files=(), _id=None):
    committer = committer or author
    return {
        "_id": _id, "node_id": None, "sha": sha,
        "url": f"https://api.github.com/repos/{owner}/{repo}/commits/{sha}",
        "commit": {"author": {"name": author, "email": None, "date": ts(author_date or date)},
                   "committer": {"name": committer, "email": None, "date": ts(date)},
                   "message": message, "tree": {"sha": sha}, "comment_count": 0,
                   "verification": {"verified": False, "reason": None, "signature": None, "payload": None}},
        "author": None, "committer": None,
        "parents": [{"sha": p} for p in parents],
        "stats": None if stats is None else dict(zip(("total", "additions", "deletions"), stats)),
        "files": list(files),
    }


def commits_df(spark, rows):
    return spark.createDataFrame(rows, schemas.COMMIT)


def status_events(commits):
    """Brute-force helper: (repository, filename, ts, removed) for every added/removed file."""
    from pyspark.sql import functions as F
    f = commits.select(F.regexp_extract("url", r"/repos/([^/]+/[^/]+)/commits", 1).alias("repository"),
                       F.col("commit.committer.date").alias("ts"), F.explode("files").alias("f"))
    return f.filter(F.col("f.filename").isNotNull() & F.col("f.status").isin("added", "removed")).select(
        "repository", F.col("f.filename").alias("filename"), "ts", (F.col("f.status") == "removed").alias("removed"))


def added_removed_pairs(commits, within):
    """Brute force C9: all (add, remove) pairs, then distinct names (tests only, small inputs)."""
    from pyspark.sql import functions as F
    e = status_events(commits)
    a = e.filter(~F.col("removed")).select(F.col("repository").alias("r"), F.col("filename").alias("f"),
                                           F.col("ts").alias("ta"))
    r = e.filter(F.col("removed"))
    return r.join(a, (r.repository == a.r) & (r.filename == a.f) & (r.ts > a.ta)
                  & (r.ts < a.ta + F.expr(f"INTERVAL {within}"))).select("repository", "filename").distinct()
