"""Findings of the round before: linear segment search, plans of any width, equal rows in different batches, long texts."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from sparklytics.llm import op1_ppm, op3_toxicity, op7_fingerprints, op8_substrings
from sparklytics.llm.exchange import dealt

from .helpers import frame


def test_segment_search_is_linear():
    for scores in (np.ones(160_000), np.tile([1.0, -2.0], 80_000), np.random.default_rng(1).normal(-0.1, 1, 160_000)):
        t = time.time()
        op3_toxicity.segments(scores)
        assert time.time() - t < 1.0


def maximal(s, off=0):
    """The definition: the best segment (the shortest of equals), then both sides of it."""
    total = np.r_[0, np.cumsum(s)]
    found = [(total[j] - total[i], i - j, i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1) if total[j] - total[i] > 1e-12]
    if not found:
        return []
    _, _, i, j = max(found)
    return maximal(s[:i], off) + [(i + off, j + off)] + maximal(s[j:], off + j)


def test_segments_equal_the_definition():
    r = np.random.default_rng(2)
    for _ in range(150):
        s = r.integers(-5, 6, r.integers(0, 22)) + r.normal(0, 1e-3, 1)
        s = s + r.normal(0, 1e-3, len(s))
        assert [x[:2] for x in op3_toxicity.segments(s)] == maximal(s)


def test_ranges_of_fingerprints_plan_quickly(spark):
    """8,000 bounds are what 2,000 shuffle partitions have."""
    bounds = list(range(0, 80_000, 10))
    ids = spark.range(80_000)
    t = time.time()
    deal, is_bound = op7_fingerprints._range_of(bounds, F.col("id"))
    dealt_out = ids.select("id", deal.alias("deal"), is_bound.alias("bound"))
    dealt_out._jdf.queryExecution().executedPlan()
    assert time.time() - t < 5
    wrong = (F.col("bound") != (F.col("id") % 10 == 0)) | (F.col("deal") != 7999 - F.ceil(F.col("id") / 10))
    assert dealt_out.filter("id <= 79990").filter(wrong).isEmpty()


def test_a_third_of_the_table_is_one_row(spark):
    """Rows equal in id and text are in different batches, and results stay whole."""
    r = random.Random(1)
    row = (7, " ".join(r.choice("abcdefgh") + str(r.randrange(99)) for _ in range(30_000)))
    rows = [row] * 100 + [(100 + i, " ".join(r.choice("stuvw") + str(r.randrange(99)) for _ in range(25_000))) for i in range(200)]
    docs = frame(spark, rows, clashes=False)
    batches, n = dealt(docs)
    sizes = {x["batch"]: x["s"] for x in batches.groupBy("batch").agg(F.sum(F.octet_length("text")).alias("s")).collect()}
    assert n > 4 and max(sizes.values()) < 2.2 * sum(sizes.values()) / n
    out = op8_substrings.substring_dedup(docs.select("doc_id", "text")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("n_removed").alias("m"))
    found = {x["doc_id"]: (x["n"], x["m"]) for x in out.collect()}
    assert found[7] == (100, 0) and len(found) == 201
    scored = op1_ppm.ppm_scores(docs.select("doc_id", "text")).filter("doc_id = 7").agg(
        F.count(F.lit(1)), F.max("score") - F.min("score"), F.max("n_tokens")).first()
    assert scored[0] == 100 and abs(scored[1]) < 1e-6 * 30_000 and scored[2] == 30_001


def test_toxicity_of_a_text_of_megabytes(spark):
    rows = [(i, "calm words here and there " * (1 + i % 3) + ("vile awful " * 4 if i % 4 == 0 else "")) for i in range(200)]
    docs = frame(spark, rows + [(999, "vile " * 400_000 + "calm words here " * 100_000), (998, ""), (997, None)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = {x["doc_id"]: x["score"] for x in op3_toxicity.toxic_segments(docs, op3_toxicity.fit(docs, labels)).collect()}
    assert got[999] >= 0.5 > got[998] == got[997]
    held = [i for i in range(200)]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95


def test_stage_three_keeps_the_same_copy_of_equal_rows(spark):
    import corpus_pipeline
    long = " ".join(f"word{i}" for i in range(40))
    rows = [(1, long, x, (x or "") * 2) for x in ("d", "b", "c", None, "a")] + [(2, "something else entirely, with words of its own", "z", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    seen = {tuple(sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs.repartition(n, F.rand(n)), "").collect()))) for n in (1, 3, 7)}
    assert len(seen) == 1 and [r[2] for r in next(iter(seen))] == [None, "z"]
