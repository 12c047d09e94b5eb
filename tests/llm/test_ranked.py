"""Operator 11 against a plain definition and DuckDB."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparklytics.llm import op11_ranked as op

from .helpers import corpus, frame, low

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(low(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 100 - 90 + 90 * sum(b.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 8 * m))
                    for w in set(TERM.findall(low(text))) if w in b)
            if s > 0:
                found.append((-s, i is None, i or 0))
        found.sort()
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


def got(spark, docs, items, k=10):
    frame_items = spark.createDataFrame([(*x, "clash", 1) for x in items], "item_id bigint, text string, rank string, term int")
    return sorted((tuple(r) for r in op.ranked(frame(spark, docs), frame_items, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def queries(docs, n=25, seed=1):
    r = random.Random(seed)
    texts = [t for _, t in docs if t and len(t) > 40]
    out = []
    for i in range(n):
        w = TERM.findall(r.choice(texts)) or ["x"]
        out.append((i * 2, " ".join(r.choice(w) for _ in range(r.randrange(1, 20))) + r.choice(["", "!", " zzz-unknown"])))
    return out


ODD = [(90, None), (91, ""), (92, "...—"), (93, "nothing-of-this-occurs"), (94, "ONE one"), (94, "ONE one"), (None, "one")]


@pytest.mark.parametrize("k", [1, 10])
def test_whole_operator(spark, k):
    docs = corpus(3, 90)
    items = queries(docs) + ODD
    assert got(spark, docs, items, k) == expected(docs, items, k)


def test_small_trees_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ITEMS", 4)
    docs = corpus(9, 200)
    items = queries(docs, 11)
    assert got(spark, docs, items) == expected(docs, items)


def test_ties_repeated_rows_long_text(spark):
    r = random.Random(7)
    long = " ".join(r.choice(["alpha", "beta", "Gamma", "été", "日本"]) for _ in range(300_000))
    docs = [(i, "alpha beta") for i in range(40)] + [(5, "alpha beta")] * 100 + [(None, "alpha beta"), (200, long), (201, "delta")]
    items = [(1, "alpha"), (2, "gamma été"), (3, "日本 alpha delta")]
    assert got(spark, docs, items) == expected(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []
    assert got(spark, [(1, None), (2, " ")], [(1, "a")]) == []


def test_traversal_is_exact_and_prunes():
    """Random vectors: the dual-tree search finds what scoring everything finds, with fewer leaf visits."""
    r = np.random.default_rng(5)
    size, n = 400, 3000
    group = r.integers(0, 20, n)
    vectors = [np.unique(np.r_[r.integers(g * 20, g * 20 + 20, 6), r.integers(0, size, 2)]) for g in group.tolist()]
    start = np.r_[0, np.cumsum([len(v) for v in vectors])]
    term, value = np.concatenate(vectors), r.integers(1, 1000, start[-1])
    weight = r.integers(1, 500, size)
    wanted = [np.unique(r.integers(g * 20, g * 20 + 20, 5)) for g in range(20) for _ in range(4)]
    items = op.Items(wanted, weight)
    docs = op.Documents(list(range(n)), start, term, value, weight)
    visits = []
    scores = docs.scores
    docs.scores = lambda leaf, w: visits.append(leaf) or scores(leaf, w)
    best = op.Best(np.ones(len(items.order)), 10)
    op._traverse(docs, items, weight, best)
    for i, o in enumerate(items.order):
        full = np.zeros(size, np.int64)
        full[wanted[o]] = weight[wanted[o]]
        all_scores = np.add.reduceat(full[term] * value, start[:-1])
        want = sorted((-int(s), False, d) for d, s in enumerate(all_scores) if s > 0)[:10]
        assert best.found[i] == want
    assert len(visits) < len(items.order) * len(docs.levels[0]) / 3
