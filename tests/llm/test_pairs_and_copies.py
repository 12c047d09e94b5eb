"""Operators 4, 5, 8 and 10 against their plain definitions."""

import hashlib
import os
import random

import pytest

from sparklytics.llm import common
from sparklytics.llm import op4_line_dedup as op4
from sparklytics.llm import op5_exact_dedup as op5
from sparklytics.llm import op8_substrings as op8
from sparklytics.llm import op10_jaccard as op10

from sparklytics.session import checkpoint_dir

from .helpers import corpus, frame, low, sort, words

LAST = 1 << 63


def key(i):
    return LAST if i is None else i


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("rows", [corpus(1), [], [(None, None)]])
def test_exact_dedup(spark, tmp_path, rows):
    index = op5.DigestIndex(spark, str(tmp_path / "index"), 4)
    got = op5.exact_dedup(frame(spark, rows), index, salts=3).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(low(t)), []).append(i)
    assert sort((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == sort(
        (i, max([j for j in groups[sha(low(t))] if j is not None], default=None), len(groups[sha(low(t))]), sha(low(t))) for i, t in rows)
    kept = [r for r in got if r["kept"]]
    assert sorted(r["text_sha256"] for r in kept) == sorted(groups)  # one row of each text
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_index_persists_and_takes_batches(spark, tmp_path):
    path = str(tmp_path / "index")
    first = [(1, "a"), (2, "A"), (3, "b")]
    op5.exact_dedup(frame(spark, first), op5.DigestIndex(spark, path, 4)).count()
    index = op5.DigestIndex(spark, path)  # as another session opens it
    assert index.buckets == 4 and index.rows().count() == 2
    again = op5.exact_dedup(frame(spark, [(9, "a"), (10, "c"), (11, "C")]), index).collect()
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again} == {9: (2, False), 10: (11, False), 11: (11, True)}
    retry = op5.exact_dedup(frame(spark, [(9, "a"), (10, "c"), (11, "C")]), index).collect()
    assert sort(map(tuple, retry)) == sort(map(tuple, again)) and index.rows().count() == 3
    plan = index.rows().join(index.rows().withColumnRenamed("keep_id", "k").hint("merge"), "digest")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_exact_dedup_is_native(spark, tmp_path):
    df = op5.exact_dedup(frame(spark, corpus(2)), op5.DigestIndex(spark, str(tmp_path / "i"), 4))
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("window", [2, 3])
@pytest.mark.parametrize("seed", [1, 4])
def test_line_dedup(spark, seed, window):
    rows = corpus(seed)
    seen = set()
    expected = {}
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda x: (key(x[0]), 0)):
        full = [x for x in t.split("\n") if x]
        at = [tuple(full[k:k + window]) for k in range(len(full) - window + 1)]
        gone = set()
        for k, run in enumerate(at):
            if run in seen:
                gone |= set(range(k, k + window))
            seen.add(run)
        raw, k, kept = t.split("\n"), 0, []
        for x in raw:
            if not (x and k in gone):
                kept.append(x)
            k += bool(x)
        expected[(i, t)] = (len(full), len(gone), "\n".join(kept))
    # rows without an id come last, in no order among themselves: the fixture has one text for them
    docs = frame(spark, rows).withColumnsRenamed({"n_removed": "was_removed", "kept_text": "was_kept"})
    got = op4.line_dedup(docs.withColumn("copy", docs.text), window).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_lines"], r["n_removed"], r["kept_text"]) == expected[(r["doc_id"], r["copy"] or "")]
    assert any(r["n_removed"] for r in got)
    assert op4.line_dedup(frame(spark, []), window).count() == 0


@pytest.mark.parametrize("seed", [1, 4])
def test_substring_dedup(spark, seed):
    rows = corpus(seed)
    low_id = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            low_id[g] = min(low_id.get(g, LAST + 1), key(i))
    expected = []
    for i, t in rows:
        w, gone = words(t), set()
        for k in range(len(w) - 12):
            if low_id[tuple(w[k:k + 13])] < key(i):
                gone |= set(range(k, k + 13))
        expected.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = op8.substring_dedup(frame(spark, rows).select("doc_id", "text", "batch", "shard", "row"))
    assert sort((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got.collect()) == sort(expected)
    assert any(x[2] for x in expected)
    assert op8.substring_dedup(frame(spark, [])).count() == 0


def test_substring_dedup_over_many_shards(spark, monkeypatch):
    from sparklytics.llm import exchange
    rows = corpus(7)
    whole = sort(map(tuple, op8.substring_dedup(frame(spark, rows, False)).collect()))
    monkeypatch.setattr(exchange, "BATCH_BYTES", 3000)
    assert sort(map(tuple, op8.substring_dedup(frame(spark, rows, False)).collect())) == whole


def test_index_finds_what_a_scan_finds():
    import random

    import numpy as np
    r = random.Random(3)
    text = np.array([r.randrange(1, 5) for _ in range(400)] + [0])
    index = op8.FMIndex(text, 6)
    plain = text.tolist()
    for _ in range(200):
        k = r.randrange(1, 7)
        pattern = np.array([r.randrange(1, 5) for _ in range(k)])
        hits = [i for i in range(len(plain) - k + 1) if plain[i:i + k] == pattern.tolist()]
        length, lo, hi = index.match(pattern, np.array([k]), np.array([k]))
        assert (length[0] == k) == bool(hits)
        if hits:
            assert sorted(index.suffix[lo[0]:hi[0]].tolist()) == hits
            if k == 6:
                assert index.suffix[lo[0]] == hits[0]  # ties by position


def components(rows, k, num, den):
    def shingles(t):
        w = words(low(t))
        return {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
                    up[find(a)] = find(b)
    groups = {}
    for a, (i, _) in enumerate(rows):
        groups.setdefault(find(a), []).append(i)
    low_id = {g: min([i for i in v if i is not None], default=None) for g, v in groups.items()}
    return [(i, len(sets[a]), low_id[find(a)]) for a, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("k,num,region,seed", [(3, 90, 2048, 1), (5, 80, 2048, 2), (3, 80, 3, 3)])
def test_jaccard_components(spark, k, num, region, seed):
    rows = corpus(seed, 80)
    got = op10.jaccard_components(frame(spark, rows), k, (num, 100), region)
    found = got.collect()
    expected = components(rows, k, num, 100)
    assert sort((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sort(expected)
    assert len({x[2] for x in expected}) < len({i for i, _ in rows})
    # of each component with an id, its smallest document stays
    assert {r["doc_id"] for r in found if r["stays"] and r["doc_id"] is not None} == {x[2] for x in expected if x[2] is not None}


def test_jaccard_disk(spark, tmp_path, monkeypatch):
    """Six near copies of each document: bytes of shuffle files and tables, after every table and at the end."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 9))) for _ in range(4000)]
    base = [[r.choice(vocabulary) for _ in range(500)] for _ in range(200)]
    rows = [(200 * k + i, " ".join(r.choice(vocabulary) if r.random() < 0.004 else w for w in ws)) for k in range(6) for i, ws in enumerate(base)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    tops = [*spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString(),
            checkpoint_dir(spark).removeprefix("file:")]

    def files(*tops):
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for top in tops for d, _, names in os.walk(top) for f in names
                if not f.startswith("broadcast_")}
    source = sum(files(str(tmp_path / "documents")).values())
    common.release(spark)
    start, used = files(*tops), []

    def measure():
        now = files(*tops)
        used.append(sum(now[f] for f in now.keys() - start.keys()) / source)

    def cut(df, name, own=op10.cut):
        out = own(df, name)
        measure()
        return out
    monkeypatch.setattr(op10, "cut", cut)
    found = op10.jaccard_components(docs, 5, (80, 100))
    measure()
    assert max(used) < 3 and used[-1] < 0.6, used
    assert {(x["doc_id"], x["component_id"], x["stays"]) for x in found.collect()} == {(i, i % 200, i < 200) for i, _ in rows}


def test_jaccard_of_nothing(spark):
    assert op10.jaccard_components(frame(spark, [])).count() == 0
    got = op10.jaccard_components(frame(spark, [(1, None), (2, ""), (None, None)])).collect()
    assert sort((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sort([(1, 0, 1), (2, 0, 2), (None, 0, None)])


def test_cells_find_every_link():
    import random

    import numpy as np
    r = random.Random(9)
    for _ in range(20):
        base = [r.sample(range(1000), 30) for _ in range(3)]
        members = []
        for _ in range(40):
            s = set(r.choice(base))
            for _ in range(r.randrange(5)):
                s.discard(r.choice(sorted(s)))
                s.add(r.randrange(1000))
            members.append(np.array(sorted(s), np.uint64))
        plain = [set(m.tolist()) for m in members]
        up = list(range(40))
        for a in range(40):
            for b in range(a):
                if 100 * len(plain[a] & plain[b]) >= 85 * len(plain[a] | plain[b]):
                    x, y = up[a], up[b]
                    up = [min(x, y) if u in (x, y) else u for u in up]
        assert op10.components(members, 85, 100) == up
        hist = op10.close_histograms([op10.histogram(m) for m in members], np.array([len(m) for m in members]), 85, 100)
        assert all(hist[a] == hist[b] for a in range(40) for b in range(a) if up[a] == up[b])
