"""Findings of the second review: fixtures that failed before."""

import dataclasses
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparklytics.llm import op3_toxicity as op3
from sparklytics.llm import op4_line_dedup as op4
from sparklytics.llm import op9_quality as op9

from .helpers import corpus, frame, words

LONG = " ".join(f"w{k}" for k in range(60))


def _line_dedup(rows, window, min_words):
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda x: 1 << 63 if x[0] is None else x[0]):
        full = [x for x in t.split("\n") if x]
        gone = set()
        for size in range(1, window + 1):
            for k in range(len(full) - size + 1):
                run = tuple(full[k:k + size])
                if size == window or sum(len(words(x)) for x in run) >= min_words:
                    if run in seen:
                        gone |= set(range(k, k + size))
                    seen.add(run)
        raw, k, kept = t.split("\n"), 0, []
        for x in raw:
            if not (x and k in gone):
                kept.append(x)
            k += bool(x)
        out[(i, t)] = (len(full), len(gone), "\n".join(kept))
    return out


@pytest.mark.parametrize(("window", "min_words"), [(2, 13), (3, 13), (3, 50), (4, 20)])
def test_short_runs_of_enough_words(spark, window, min_words):
    r = random.Random(window)
    few = [" ".join(r.choice("abcd") for _ in range(r.choice((6, 7, 12, 13, 30)))) for _ in range(12)]
    rows = corpus(3)
    rows += [(3000 + i, "\n".join(r.choice([*few, "", LONG]) for _ in range(r.randrange(1, 7)))) for i in range(80)]
    docs = frame(spark, rows, clashes=False)
    got = op4.line_dedup(docs.withColumn("copy", docs.text), window, min_words).collect()
    expected = _line_dedup(rows, window, min_words)
    assert len(got) == len(rows)
    for x in got:
        assert (x["n_lines"], x["n_removed"], x["kept_text"]) == expected[(x["doc_id"], x["copy"] or "")]


def test_pipeline_cuts_long_passages_on_one_line(spark):
    rows = [(1, f"own first\n{LONG}"), (2, LONG), (3, f"{LONG}\nown third"), (4, f"a\n{LONG}\nb\nc\n{LONG}\nd"),
            (5, "short line\nown fifth"), (6, "short line"), (7, f"{LONG} not\nthe same"), (8, f"x x x x x x x\ny y y y y y\n{8}"),
            (9, "x x x x x x x\n\ny y y y y y"), (11, "x x x x x x x\nz z z")]
    out = corpus_pipeline.line_dedup(spark, frame(spark, rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in out} == {
        1: rows[0][1], 3: "own third", 4: "a\nb\nc\nd", 5: rows[4][1], 6: rows[5][1], 7: rows[6][1], 8: rows[7][1],
        11: rows[9][1]}
    assert all(r["n_chars"] == len(r["text"]) for r in out)


@pytest.mark.parametrize("op", [op3, op9])
def test_repeated_ids_count_once_in_the_fit(spark, op):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(("vile", "scum", "tree") if i % 3 else ("tree", "river", "stone")) for _ in range(r.randrange(5, 40))))
            for i in range(240)]
    docs = frame(spark, rows, clashes=False)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 > 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    again = docs.filter("doc_id in (1, 2, 3, 230)").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(90)))).drop("k")
    one, many = op.fit(docs, labels), op.fit(docs.unionByName(again).repartition(3), labels)
    for f in dataclasses.fields(one):
        assert np.allclose(getattr(one, f.name), getattr(many, f.name), rtol=1e-6, atol=1e-9), f.name
