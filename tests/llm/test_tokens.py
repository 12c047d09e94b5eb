"""Operators 2, 6 and 7, and the pipeline."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sparklytics.llm import op2_packing as op2
from sparklytics.llm import op6_pieces as op6
from sparklytics.llm import op7_fingerprints as op7

from .helpers import corpus, frame, low, sort, words

SF = "/root/testdata/sf0.001"


def test_packing_is_exact(spark):
    rows = corpus(1, 40) + [(5000, "tok en " * 3000), (5001, "<|endoftext|> a<|startoftext|>b <|")]
    got = op2.pack(op2.pieces(frame(spark, rows), limit=100), limit=100).collect()
    tok = op2._tokenizer(op2.tokenizer_path())
    expected = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 100):
            part = np.array(ids[k:k + 100], "<u4")
            expected.append((i, k // 100, k, len(part), zlib.crc32(part)))
    assert sort((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sort(expected)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 100
    assert len(seqs) <= -(-sum(x[3] for x in expected) // 100) * 1.03 + 1
    assert op2.pack(op2.pieces(frame(spark, []))).count() == 0


def test_pieces_with_ids_round_trip(spark):
    r = op2.pieces(frame(spark, [(1, "Hello there, world!")]), with_ids=True).first()
    tok = op2._tokenizer(op2.tokenizer_path())
    assert r["ids"] == tok.encode("Hello there, world!", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    limit = 64
    hist = np.r_[0, rng.integers(0, 40, limit)] * (rng.random(limit + 1) < (0.2, 0.5, 1, 0.05)[seed])
    slots = op2.plan(hist, limit)
    taken = np.zeros(limit + 1, int)
    fill = {}
    for length, rank, n, first, offset in slots.tolist():
        assert rank == taken[length]
        taken[length] += n
        for s in range(first, first + n):
            fill.setdefault(s, []).append((offset, length))
    assert (taken == hist).all()
    for parts in fill.values():
        assert sum(v for _, v in parts) <= limit
        assert all(a + b == c for (a, b), (c, _) in zip(sorted(parts), sorted(parts)[1:], strict=False))
    least = -(-int((hist * np.arange(limit + 1)).sum()) // limit)
    assert len(fill) <= max(least * 1.1 + 2, (np.arange(limit + 1) > limit / 2) @ hist)


def test_words_are_encoded_without_offsets():
    """Plain words take the tokenizer's call that keeps no offsets, and get the ids of the other one."""
    class Spy:
        def __init__(self, tokenizer):
            self.tokenizer, self.slow = tokenizer, 0

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode(self, *a, **k):
            self.slow += 1
            return self.tokenizer.encode(*a, **k)

    cache = op2.WordIds(op2.tokenizer_path())
    plain, cache.tokenizer = cache.tokenizer, Spy(cache.tokenizer)
    some = [f"Wörd{i}'s" for i in range(1500)] + ["日本", "e\u0301", "\u0301x", "\x01", "\u00a0", "<|endoftext|>a"]
    ids, size = cache._encode(some)
    want = [plain.encode(w, add_special_tokens=False).ids for w in some]
    assert size.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert cache.tokenizer.slow == 1  # the word that holds a special token


def test_segmentations_are_lossless_and_reproducible(spark):
    rows = corpus(1, 20) + [(7000, "a  b ▁▁ \x00 é🙂 \t日本 "), (7001, "▁")]
    path = op6.model_path()
    seg = op6.sample_segmentations(frame(spark, rows))
    got = op6.decode_segmentations(seg).collect()
    assert sort((r["doc_id"], r["text"]) for r in got) == sort((i, t or "") for i, t in rows)
    again = op6.sample_segmentations(frame(spark, rows).repartition(1)).collect()
    assert sort((r["doc_id"], r["ids"]) for r in got) == sort((r["doc_id"], r["ids"]) for r in again)
    other = op6.sample_segmentations(frame(spark, rows), seed=5).collect()
    assert sort((r["doc_id"], r["ids"]) for r in got) != sort((r["doc_id"], r["ids"]) for r in other)
    assert op6.decode([], path) == "" and op6.sample_segmentations(frame(spark, [])).count() == 0


def test_lattices_look_up_no_longer_than_a_piece_can_begin(monkeypatch):
    """A long word of letters that hardly begin pieces costs few look-ups a character, and keeps all its edges."""
    from sparklytics.llm import texthash as th
    v = op6.vocabulary(op6.model_path())
    text = ("qzxjvkwqq" * 50).encode()
    buf, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    looked, plain = [], th.Spans.hash
    monkeypatch.setattr(th.Spans, "hash", lambda self, s, e: (looked.append(len(s)), plain(self, s, e))[1])
    lat = op6.Lattices(buf, off, v, 1.0)
    assert sum(looked) < 5 * len(text)
    known = {x for x, size in zip(v.raw, v.size.tolist(), strict=True) if size}
    one = {i for i in range(len(text)) if text[i:i + 1] in known}
    longest = max(len(x) for x in known)
    want = {(j, j - i) for i in range(len(text)) for j in range(i + 1, min(len(text), i + longest) + 1) if text[i:j] in known}
    want |= {(i + 1, 1) for i in range(len(text)) if i not in one}
    edges = {(n, int(lat.back[e])) for n in range(1, len(text) + 1) for e in range(lat.first[n], lat.last[n] + 1)}
    assert edges == want and len(lat.back) == len(want)


def test_sampling_follows_the_lattice():
    path = op6.model_path()
    v = op6.vocabulary(path)
    text = "there"
    pieces = {v.raw[i].decode(errors="replace"): i for k in v.table for i in v.table[k][1].tolist()}
    weight = {}

    def walk(at, ids, w):
        if at == len(text):
            weight[tuple(ids)] = w
        for j in range(at + 1, len(text) + 1):
            if text[at:j] in pieces:
                i = pieces[text[at:j]]
                walk(j, [*ids, i], w * np.exp(v.log[i]))
    walk(0, [], 1.0)
    n = 20_000
    ids, at = op6.encode(pa.array([text] * n), np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), path)
    seen = {}
    for a, b in zip(at[:-1], at[1:], strict=True):
        s = tuple(ids[a:b].tolist())
        seen[s] = seen.get(s, 0) + 1
    assert set(seen) <= set(weight)
    for s, w in weight.items():
        p = w / sum(weight.values())
        assert abs(seen.get(s, 0) / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_fingerprints(spark):
    rows = corpus(1)
    got = op7.compare_with_edited(frame(spark, rows)).collect()
    order = sorted(((i if i is not None else op7.LAST, i, t or "") for i, t in rows), key=lambda x: (-x[0], x[2]))

    def shingles(t):
        w = words(low(t))
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def near(a, b):
        a, b = shingles(a), shingles(b)
        return len(a & b) / len(a | b) if a | b else 1.0
    expected, exact = [], []
    for k, (_, i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][2]
        third = len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
        exact.append((i, hashlib.sha256(edited.encode()).hexdigest(), near(t, edited), near(t, nxt)))
    assert sort((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sort(expected)
    by = {(r["doc_id"], r["edited_sha256"]): r for r in got}
    for i, h, edited, nxt in exact:
        assert abs(by[(i, h)]["near_edited"] - edited) < 0.2 and abs(by[(i, h)]["near_next"] - nxt) < 0.2
    assert op7.compare_with_edited(frame(spark, [])).count() == 0
    alone = op7.compare_with_edited(frame(spark, [(None, "a b c d e f")])).first()
    assert alone["near_next"] == 1.0 and alone["n_chars"] == 11


def test_fingerprints_merge_and_estimate(spark):
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2)) for _ in range(2))
    both = np.union1d(rng.permutation(a)[:3000], rng.permutation(b)[:1000])
    k = 256
    s, t = a[:k], both[:k]
    assert op7.resemblance(s, t, k) == pytest.approx(len(np.intersect1d(a, both)) / len(np.union1d(a, both)), abs=0.1)
    assert op7.containment(t, s, k) == pytest.approx(len(np.intersect1d(a, both)) / len(both), abs=0.12)
    assert op7.distinct_count(s, k) == pytest.approx(4000, rel=0.2)
    assert (op7.merge(a[:k], b[:k], k) == np.union1d(a, b)[:k]).all()
    rows = corpus(2, 30)
    parts = op7.fingerprints(frame(spark, rows).withColumn("k", F.col("doc_id") % 2)).withColumn("k", F.col("doc_id") % 2)
    merged = {r["k"]: op7.decode(r["fingerprint"]) for r in op7.merge_fingerprints(parts.filter("k is not null"), "k").collect()}
    for g in (0, 1):
        every = np.unique(np.concatenate([op7.decode(r["fingerprint"]) for r in parts.filter(F.col("k") == g).collect()]))
        assert (merged[g] == every[:op7.K]).all()


# ---- pipeline and registry ------------------------------------------------------------------------
def test_pipeline_stages(spark, tmp_path):
    rows = [(i, t) for i, t in corpus(1, 60)]
    docs = frame(spark, rows)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    columns = docs.columns
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        out = str(tmp_path / name)
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.count() <= n
        n = docs.count()
    kept = docs.collect()
    assert len({(r["doc_id"], r["text"]) for r in kept}) == len(kept)
    assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in kept)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= n


def test_pipeline_runs_on_empty_documents(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registry(spark):
    from sparklytics.llm import registry
    q = entry.queries()
    assert set(registry.QUERIES) <= set(q) and set(registry.ORACLE) <= set(registry.QUERIES)
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES if k != "pipeline") == list(range(1, 11))


@pytest.mark.parametrize("name", ["op4_line_dedup", "op5_exact_dedup", "op8_substrings", "op10_jaccard", "op11_ranked"])
def test_matches_oracle(spark, name):
    from sparklytics.llm import registry

    from ..verify import compare, duckdb_connection
    ok, msg = compare(registry.QUERIES[name](spark, SF), duckdb_connection(SF), registry.ORACLE[name])
    assert ok, msg
