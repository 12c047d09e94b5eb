"""Operator 13 and the connected components it uses, against plain definitions."""

import random

import numpy as np
import pytest
import xxhash

from sparklytics.llm import op13_simhash as op
from sparklytics.llm.components import components

from .helpers import corpus, frame, low, sort, words


def fingerprint(text):
    w = words(low(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(values, budget=4):
    """The smallest reachable position of each value."""
    up = list(range(len(values)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def expected(rows):
    rows = [(i, t, fingerprint(t)) for i, t in rows]
    root = reach([f for _, _, f in rows])
    ids = {}
    for (i, _, _), r in zip(rows, root, strict=True):
        ids[r] = min(ids.get(r, op.LAST), op.LAST if i is None else i)
    return [(i, f"{f:016x}", None if ids[r] == op.LAST else ids[r]) for (i, _, f), r in zip(rows, root, strict=True)]


def got(spark, rows, **kw):
    from pyspark.sql import functions as F
    out = op.simhash_components(frame(spark, rows), **kw)
    return [tuple(r) for r in out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()]


def test_whole_operator(spark):
    rows = corpus(5, 80)
    assert sort(got(spark, rows)) == sort(expected(rows))


def test_empty_table(spark):
    assert got(spark, []) == []


def test_only_nulls_and_ties(spark):
    rows = [(None, None), (None, ""), (7, " \t"), (7, " \t"), (None, "a b c"), (None, "A  b\nc")]
    assert sort(got(spark, rows)) == sort(expected(rows))


def test_repeated_row_and_long_text(spark):
    r = random.Random(3)
    long = " ".join(r.choice("abcdefgh") + str(r.randrange(50)) for _ in range(200_000))  # above HASHES shingles
    rows = [(1, long), (2, long + " end")] + [(5, "same text in a third of the rows")] * 300 + corpus(6, 30)
    assert sort(got(spark, rows)) == sort(expected(rows))


def near_values(seed, n, flips):
    """Random fingerprints, chains and clusters of near ones."""
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(n)}
    for base in list(out)[:n // 10]:
        x = base
        for _ in range(12):
            for _ in range(r.randrange(1, flips + 1)):
                x ^= 1 << r.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("budget", [2, 4])
def test_trie_join_in_a_task(budget):
    v = near_values(1, 300, budget + 1)
    fp = np.array(v, np.uint64)
    assert op.trie_join(fp, np.array([[0, len(fp), 0, len(fp)]]), budget).tolist() == reach(v, budget)
    half = len(fp) // 2
    across = op.trie_join(fp, np.array([[0, half, half, len(fp)]]), budget)
    ok = {(i, j) for i in range(half) for j in range(half, len(v)) if (v[i] ^ v[j]).bit_count() <= budget}
    for i, j in ok:
        assert across[i] == across[j]


def test_dense_cluster_costs_few_comparisons():
    base = 0x0123456789ABCDEF
    v = sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)} | {base})
    fp = np.array(v, np.uint64)
    assert set(op.trie_join(fp, np.array([[0, len(fp), 0, len(fp)]]), 4).tolist()) == {0}


@pytest.mark.parametrize("unit", [4, 40, 1 << 16])
def test_links_with_split_units(spark, unit):
    v = near_values(2, 120, 5) + sorted({0xFF << 30 ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(a)})
    signed = [(op._signed(x),) for x in v]
    fps = spark.createDataFrame(signed, "fp bigint")
    root = {r["node"]: r["root"] for r in components(op.links(fps, len(v), 4, unit)).collect()}
    want = reach(v)
    groups = {}
    for x, r in zip(v, want, strict=True):
        groups.setdefault(r, set()).add(op._signed(x))
    mine = {}
    for x, in signed:
        mine.setdefault(root.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_more_tries_for_more_fingerprints():
    assert len(op.tries(1000, 4)) == 5 and len(op.tries(10**7, 4)) == 15 and len(op.tries(10**12, 4)) == 70
    for n in (1000, 10**7, 10**12):  # four differing bits anywhere leave one root path whole
        r = random.Random(n)
        for _ in range(200):
            x = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not x & m for m in op.tries(n, 4))


def test_components_of_chains_stars_and_odd_rows(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    links = spark.createDataFrame(chain + [(b, a) for a, b in chain[:50]] + star + star + [(-5, 9000), (7000, 7000), (None, 1)],
                                  "u bigint, v bigint").repartition(5)
    out = {r["node"]: r["root"] for r in components(links).collect()}
    assert out == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}, 9000: -5}
    assert components(links.limit(0)).collect() == []
