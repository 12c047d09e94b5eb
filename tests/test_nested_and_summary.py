"""Deep flatten of variants, mergeable summaries, multiset intersection."""

import json
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparklytics.operators import nested, summary


def plain(x):
    return [z for y in x for z in plain(y)] if isinstance(x, list) else [x]


def deep(n):
    return [n, deep(n - 1), str(n)] if n else ["[bottom]"]


LISTS = {1: [[1], [2, [3, [4]]], 5], 2: [], 3: [[], [[]]], 4: ["[1,2]", ["a,]b", '"]'], "{"], 5: [{"a": [1, [2]]}, [{"b": []}]], 6: deep(50),
         7: [None, [True, [False, 1.5, 2]], 12345678901234567890, 1e300], 8: [[i] for i in range(400)], 9: [1, "1", [1.0, [True]]]}


def test_flatten_keeps_order_types_and_objects(spark):
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in LISTS.items()] + [(20, None), (21, "no json"), (22, '{"a": [1]}'), (23, "7")],
                               "id long, t string")
    out = {r["id"]: [json.loads(v) for v in r["result"]] for r in nested.flattened(nested.flatten_variant(df, "id", "t"), "id").collect()}
    assert out == {i: plain(x) for i, x in LISTS.items() if plain(x)}


def test_flatten_to_a_type_and_paths(spark):
    df = spark.createDataFrame([(1, "[1,[2,[null,\"x\"]],{\"a\":1}]")], "id long, t string")
    long = nested.flatten_variant(df, "id", "t")
    assert nested.flattened(long, "id", "bigint").first()["result"] == [1, 2, None, None, None]
    assert sorted(tuple(r["path"]) for r in long.collect()) == [(0,), (1, 0), (1, 1, 0), (1, 1, 1), (2,)]
    assert nested.flatten_variant(df.limit(0), "id", "t").collect() == []


def rows(seed, n=3000):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), r.choice([None, r.randrange(-1000, 1000), 10**12 + r.randrange(100)])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_states_equal_one_pass_and_plain_statistics(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "k string, v long")
    parts = [summary.summary_state(df.filter(F.pmod(F.hash("v"), F.lit(4)).eqNullSafe(i)), "v", ["k"]) for i in (0, 1, 2, 3)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = {r["k"]: r for r in summary.describe(summary.merge_states(states, ["k"])).collect()}
    for k in ("a", "b", None):
        v = sorted(x for q, x in data if q == k and x is not None)
        r = got[k]
        assert (r["count"], r["min"], r["max"]) == (len(v), v[0], v[-1])
        assert r["mean"] == pytest.approx(statistics.fmean(v)) and r["stddev"] == pytest.approx(statistics.stdev(v))
        for name, q in summary.QUANTILES.items():
            rank = sum(x <= r[name] for x in v) / len(v)
            assert q - 0.01 <= rank and sum(x < r[name] for x in v) / len(v) <= q + 0.01


def test_summary_of_few_values_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1), (3, 1)], "k int, v int")
    got = {r["k"]: tuple(r)[1:] for r in summary.describe(summary.summary_state(df, "v", ["k"])).collect()}
    assert got == {1: (1, 5.0, None, 5, 5, 5, 5, 5), 2: (0, None, None, None, None, None, None, None), 3: (2, 1.0, 0.0, 1, 1, 1, 1, 1)}
    merged = summary.describe(summary.merge_states(summary.summary_state(df.limit(0), "v"))).collect()
    assert [tuple(r) for r in merged] == [(0, None, None, None, None, None, None, None)]


def test_common_rows_with_duplicates_and_nulls(spark):
    r = random.Random(3)
    value = lambda: (r.choice(["x", "y", None]), r.choice([1, 2, None]))
    left, right = [value() for _ in range(200)], [value() for _ in range(90)] + [("only", 1)]
    a, b = spark.createDataFrame(left, "p string, n int"), spark.createDataFrame(right, "q string, w int")
    got = {(x[0], x[1]): x[2] for x in summary.common_rows(a.withColumnRenamed("n", "m"), b).collect()}
    assert got == dict(Counter(left) & Counter(right))
    assert summary.common_rows(a.limit(0).withColumnRenamed("n", "m"), b).collect() == []


def test_common_rows_counts_a_hot_row_partially(spark):
    hot = spark.range(1000).select(F.lit(None).cast("string").alias("k"))
    plan = summary.common_rows(hot, hot)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan
