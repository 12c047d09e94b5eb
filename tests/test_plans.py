"""Plan checks: no Python in any plan, partial aggregation, pushdown into the scan, no
single-task sort of raw rows, top-k as a bounded operator."""

import pytest

from sparklytics.operators import commit_collections as coll
from sparklytics.operators import commit_frames as frames
from sparklytics.plans.catalog import QUERIES
from sparklytics.sources.commits import commit_view

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "executed" else \
        df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if not k.endswith("_replay")))
def test_no_python_in_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(n in text for n in PYTHON_NODES), name


@pytest.mark.parametrize("name", ["weekly_commits_per_repo", "file_extension_counts", "top_words",
                                  "repo_commits_and_committers", "committer_stats_totals"])
def test_partial_aggregation(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "partial_" in text


@pytest.mark.parametrize("name", ["top_file_formats", "top_words", "first_sentences", "peak_js_hour"])
def test_topk_is_bounded(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["days_since_previous_commit", "days_since_previous_commit_all",
                                  "stream_added_then_removed"])
def test_no_single_partition_exchange(spark, name):
    physical = plan(QUERIES[name](spark, SF)).split("== Physical Plan ==")[-1]
    assert "SinglePartition" not in physical


def test_filters_reach_a_nested_parquet_scan(spark, tmp_path):
    out = str(tmp_path / "commits")
    commit_view(spark, SF).write.parquet(out)
    stored = spark.read.parquet(out)
    text = plan(coll.commits_per_repo_in_year(stored, 1997))
    assert "PushedFilters: [IsNotNull(commit.committer.date), GreaterThanOrEqual(commit.committer.date" in text
    text = plan(frames.commits_by_authors(stored, ["own1", "GitHub"]))
    assert "In(commit.committer.name" in text
    # nested column pruning: the file list is not read for a commit-level query
    assert "files" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_month_partitioned_commit_table_prunes(spark, tmp_path):
    from sparklytics.sources.commits import read_commit_table, write_commit_table
    out = str(tmp_path / "table")
    write_commit_table(commit_view(spark, SF), out)
    stored = read_commit_table(spark, out)
    q = coll.commits_per_repo_in_year(stored, 1997)
    text = plan(q)
    assert "PartitionFilters: [isnotnull(commit_month" in text and "1997-01" in text
    base = coll.commits_per_repo_in_year(commit_view(spark, SF), 1997)
    assert sorted(tuple(r) for r in q.collect()) == sorted(tuple(r) for r in base.collect())
    # the other analytics read the stored table unchanged
    assert stored.drop("commit_month").count() == commit_view(spark, SF).count()
