"""Forks by ancestor search, pointer jumping and running aggregates, against plain definitions."""

import random

import pytest
from pyspark.sql import functions as F

from sparklytics.operators import lineage, rounds
from sparklytics.operators.ordering import segmented_scan

from .helpers import commit, commits_df


def commits(spark, rows):
    """Commits from (sha, repo, parents)."""
    made = [commit(s, owner=r.split("/")[0], repo=r.split("/")[1], parents=p) for s, r, p in rows]
    return commits_df(spark, made).repartition(5)


def got(spark, rows):
    return sorted(map(tuple, lineage.fork_first_commits(commits(spark, rows)).collect()))


def expected(rows):
    """Walks every line of first parents."""
    repos, parent = {}, {}
    for s, r, p in rows:
        repos.setdefault(s, set()).add(r)
        first = p[0] if p else None
        old = parent.get((s, r))
        parent[(s, r)] = min(x for x in (old, first) if x is not None) if old is not None or first is not None else None

    def up(node):
        p = parent[node]
        if p is None or p == node[0] or p not in repos:
            return None
        return (p, node[1] if node[1] in repos[p] else min(repos[p]))
    out = []
    for node in parent:
        u = up(node)
        if u is None or u[1] == node[1]:
            continue
        at, again = u, False
        while at is not None:
            again |= at[1] == node[1]
            at = up(at)
        if not again:
            out.append((u[1], node[1], u[0], node[0]))
    return sorted(out)


A, B, C = "up/a", "fork/a", "else/a"


def test_first_commit_of_a_fork_is_not_every_crossing_edge(spark):
    rows = [("a1", A, []), ("a2", A, ["a1"]), ("a3", A, ["a2"]),
            ("b1", B, ["a2"]), ("b2", B, ["b1"]),
            ("b3", B, ["b2", "a3"]),   # merges from upstream: no fork
            ("c1", C, ["b2"]),         # a fork of the fork
            ("b4", B, ["c1"]),         # the line comes back to B: no new fork of it
            ("b9", B, ["a1"]),         # another branch of B, forked earlier
            ("x1", "x/x", ["gone"]), ("s1", A, ["s1"])]
    want = [(A, B, "a1", "b9"), (A, B, "a2", "b1"), (B, C, "b2", "c1")]
    assert expected(rows) == sorted(want)
    assert got(spark, rows) == sorted(want)


def test_random_forests(spark):
    r = random.Random(4)
    rows = [("r0", A, [])]
    for i in range(1, 250):
        p = r.choice(rows)[0] if r.random() < 0.95 else None
        repo = r.choice([A, B, C, "d/d"]) if r.random() < 0.3 else next((x[1] for x in rows if x[0] == p), A)
        rows.append((f"r{i}", repo, [p] if p else []))
    rows += [("r5", "d/d", ["r4"]), ("r7", B, ["r3"]), ("r7", B, ["r2"])]  # one sha in two repositories, a repeated row
    assert got(spark, rows) == expected(rows)


def test_nulls_and_empty_input(spark):
    rows = [("a1", A, []), ("b1", B, ["a1"])]
    df = commits(spark, rows)
    odd = df.unionByName(df.withColumn("sha", F.lit(None).cast("string"))).unionByName(df.withColumn("url", F.lit(None).cast("string"))
                                                                                      .withColumn("parents", F.lit(None).cast(df.schema["parents"].dataType)))
    assert [tuple(x) for x in lineage.fork_first_commits(odd).collect()] == [(A, B, "a1", "b1")]
    assert lineage.fork_first_commits(df.limit(0)).collect() == []


def test_hot_upstream_commit(spark):
    """A third and more of all runs hang on one commit."""
    rows = [("a1", A, [])] + [(f"f{i}", f"u{i}/a", ["a1"]) for i in range(300)]
    assert got(spark, rows) == expected(rows)


def test_rounds_carry_numbers_and_no_names(spark, monkeypatch):
    """What is written and joined once a round is a few numbers a row, however long the names are."""
    seen, plain = [], rounds.written
    monkeypatch.setattr(rounds, "written", lambda df, path: (seen.append(df.schema), plain(df, path))[1])
    rows = [("a1" * 50, A, []), ("a2" * 50, A, ["a1" * 50]), ("b1" * 50, B, ["a2" * 50]), ("b2" * 50, B, ["b1" * 50])]
    assert got(spark, rows) == expected(rows)
    assert len(seen) > 3 and {f.dataType.simpleString() for schema in seen for f in schema} <= {"bigint", "boolean"}


def test_rounds_grow_with_the_logarithm_of_the_line(spark):
    n = 100_000
    links = spark.range(n).select(F.col("id").cast("string").alias("node"),
                                  F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("next"))
    at, k = rounds.jump(links)
    assert k <= 18
    assert at.filter((F.col("last") != "0") | (F.col("steps") != F.col("node").cast("bigint"))).isEmpty()
    assert at.count() == n


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_segmented_scan(spark, inclusive, descending):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), i if i % 50 else None, r.choice([None, 1, 2, 5])) for i in range(1, 400)]
    seen = set()
    data = [x for x in data if (x[0], x[1]) not in seen and not seen.add((x[0], x[1]))]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(7)
    out = segmented_scan(df, ["k"], ["o"], {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")}, inclusive, descending)
    want = []
    for k in ("a", "b", None):
        rows = sorted((x for x in data if x[0] == k), key=lambda x: (x[1] is not None, x[1] or 0), reverse=descending)
        for i, x in enumerate(rows):
            vs = [y[2] for y in rows[:i + inclusive] if y[2] is not None]
            want.append((*x, sum(vs), min(vs, default=None), max(vs, default=None)))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_segmented_scan_spreads_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which merges tables as small as this
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    out = segmented_scan(df.withColumn("one", F.lit(1)), ["k"], ["id"], {"n": ("sum", "one")}).cache()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 12_000 and out.filter("k = 'hot'").agg(F.max("n")).first()[0] == out.filter("k = 'hot'").count()
    out.unpersist()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
