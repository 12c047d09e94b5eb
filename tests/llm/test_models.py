"""Operators 1, 3 and 9: exact probabilities, segments, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklytics.llm import exchange
from sparklytics.llm import op1_ppm as op1
from sparklytics.llm import op3_toxicity as op3
from sparklytics.llm import op9_quality as op9

from .helpers import corpus, frame, low, sort, words

SF = "/root/testdata/sf0.01"


def held(i, folds, which):
    return i is None or zlib.crc32(str(i).encode()) % folds == which


def ppm(rows):
    """(base, score) of each row by the definition."""
    texts = [words(low(t)) for _, t in rows]
    train = [not held(i, 7, 2) for i, _ in rows]
    seqs = [b"\n" * 5 + " ".join(w).encode() + b"\n" for w in texts]
    count = defaultdict(Counter)
    for q, yes in zip(seqs, train, strict=True):
        for j in range(5, len(q) if yes else 0):
            for k in range(6):
                count[q[j - k:j]][q[j]] += 1

    def score(q):
        total = 0.0
        for j in range(5, len(q)):
            out = set()
            for k in range(5, -1, -1):
                seen = count.get(q[j - k:j], {})
                n = sum(v for s, v in seen.items() if s not in out)
                if not n:
                    continue
                if q[j] in seen:
                    total += math.log10((seen[q[j]] - 0.5) / n)
                    break
                total += math.log10((len(seen) - len(out)) / 2 / n)
                out = set(seen)
            else:
                total -= math.log10(256 - len(count.get(b"", ())))
        return total
    c = Counter(w for t, yes in zip(texts, train, strict=True) if yes for w in t)
    docs = sum(train)
    tokens, kinds = sum(c.values()) + docs, len(c) + bool(docs)
    base = [sum(math.log10((c[w] + 1) / (tokens + kinds + 1)) for w in t) + math.log10((docs + 1) / (tokens + kinds + 1)) for t in texts]
    known = [sum(c[w] > 0 for w in t) + bool(docs) for t in texts]
    return [(i, len(t) + 1, k, tokens, round(b, 6), round(score(q), 2))
            for (i, _), t, k, b, q in zip(rows, texts, known, base, seqs, strict=True)]


@pytest.mark.parametrize("batch_bytes", [1 << 22, 4000])
def test_ppm_against_the_definition(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(exchange, "BATCH_BYTES", batch_bytes)
    monkeypatch.setattr(op1, "GROUP", 2)
    rows = corpus(1, 30)
    got = op1.ppm_scores(frame(spark, rows)).collect()
    a = sort((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    expected = ppm(rows)
    assert a == sort(x[:5] for x in expected)
    by = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 4)): r["score"] for r in got}
    for x in expected:
        assert by[(x[0], x[1], round(x[4], 4))] == pytest.approx(x[5], rel=1e-3, abs=0.02)


def test_ppm_without_training_rows_and_of_nothing(spark):
    assert op1.ppm_scores(frame(spark, [])).count() == 0
    r = op1.ppm_scores(frame(spark, [(None, "ab")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (2, 0, 0, 0.0)
    assert r["score"] == pytest.approx(-3 * math.log10(256), rel=1e-6)


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    key = np.unique(rng.integers(97, 101, (500, 6)).astype(np.uint64) @ (1 << (8 * np.arange(6, dtype=np.uint64))))
    count = rng.integers(1, 5, len(key))
    low_ = np.zeros((256, 256), int)
    np.add.at(low_, ((key >> np.uint64(40)).astype(int), (key & np.uint64(255)).astype(int)), count)
    ctx = key[0] >> np.uint64(8)
    every = np.unique(np.r_[key, (ctx << np.uint64(8)) | np.arange(256, dtype=np.uint64)])
    n = np.zeros(len(every))
    n[np.searchsorted(every, key)] = count
    p = 10 ** op1.log10_probabilities(every, n, low_)
    assert p[every >> np.uint64(8) == ctx].sum() == pytest.approx(1, abs=1e-9)


def test_segments_are_maximal():
    def best(s):  # recursive definition: the best segment, then left and right of it
        if not len(s):
            return []
        total = np.r_[0, np.cumsum(s)]
        top = max(((total[j] - total[i], -(j - i), -i) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0,))
        if top[0] <= 0:
            return []
        i, j = -top[2], -top[2] - top[1]
        return best(s[:i]) + [(i, j, top[0])] + [(a + j, b + j, v) for a, b, v in best(s[j:])]
    r = random.Random(2)
    for _ in range(300):
        s = np.array([r.choice([-0.37, -1.13, 2.71, 0.59, -3.01]) * (1 + r.random()) for _ in range(r.randrange(0, 14))])
        got = op3.segments(s)
        want = best(s)
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in want])


def test_toxicity_held_out(spark):
    p = op3.op3_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    m = p[p["held_out"]].merge(labels, on="doc_id")
    assert (m["predicted"] == m["toxic"]).mean() > 0.96
    assert m["predicted"][m["toxic"] == 0].mean() < 0.01
    assert p["score"].between(0, 1).all() and len(p) == 10_000


def test_toxicity_edges(spark):
    docs = frame(spark, corpus(3, 20))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = op3.fit(docs, none)
    got = op3.toxic_segments(docs, model).collect()
    assert len(got) == docs.count() and all(r["score"] < 1e-6 and r["passages"] == [] for r in got)
    one = spark.createDataFrame([(1, 1), (1, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    assert op3.toxic_segments(docs, op3.fit(docs, one)).select(F.min("score")).first()[0] > 0.99
    assert op3.toxic_segments(frame(spark, []), model).count() == 0


def test_quality_learns(spark):
    p = op9.op9_quality(spark, SF).toPandas()
    m = p.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    assert m["kept"][m["quality"] == 1].mean() > 0.98 and m["kept"][m["quality"] == 0].mean() < 0.1


def test_co_training_passes_labels_on():
    rng = np.random.default_rng(0)
    y = (rng.random(600) < 0.7).astype(int)
    a = np.c_[y + rng.normal(0, 0.4, 600), rng.normal(size=600)].astype(np.float32)
    b = np.c_[y + rng.normal(0, 0.6, 600), rng.normal(size=600)].astype(np.float32)
    label = y.copy()
    label[40:] = -1
    m = op9.co_train(a, b, label, rounds=3, per_round=50)
    assert ((op9.score(a, b, m) >= 0.5) == y).mean() > 0.9


def test_quality_edges(spark):
    docs = frame(spark, corpus(5, 20))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = op9.quality(docs, op9.fit(docs, none), "q")
    assert out.columns == [*docs.columns, "q"] and out.filter("q = 1.0").count() == docs.count()
    labels = spark.createDataFrame([(i * 3, i % 2, None) for i in range(20)], "doc_id long, quality int, toxic int")
    scored = op9.quality(docs.drop("lang", "n_chars"), op9.fit(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r[-1] <= 1 for r in scored)
    assert op9.quality(frame(spark, []), 1.0).count() == 0
