"""Operator 3: toxic passages by maximum-scoring segments.

Units are the words of a text (runs of letters, digits and non-ASCII characters, A-Z lower-cased)
and their prefixes of 4, 5 and 6 characters, so that inflected forms share evidence.  Each unit's
log-odds between toxic and clean documents gets a Dirichlet prior proportional to its pooled rate, and
only units whose z-score is beyond ``MIN_Z`` keep their weight; a word scores its most significant
unit, and any other word a small negative drift.  A single pass over a text's words finds all
maximal scoring segments (disjoint, each best within its surroundings).  Word scores of clean
training texts give the decay rate lambda of the extreme-value law (the positive root of
E[exp(lambda s)] = 1) and, from their maxima, its scale K; a segment counts as significant when
lambda S - log(K n) is positive, n the text's words.  A logistic calibration turns the best segment's
value and the significant segments' sum into a probability.

Bounds of the fit (documented parameters): at most ``TRAIN_ROWS`` labelled documents, those of the
smallest id hash, none of them with crc32(doc_id) mod 5 = 0; at most ``MAX_UNITS`` units by |z|.
Every document is scored over its whole text.  Scores use the text alone.

Defined results: null and empty texts have no words and get the calibration's value for no evidence;
without labels of both classes every score is the rate of toxic labels (0 without any); a null
``doc_id`` is held out; repeated rows are scored one by one (the fit sees one row of an id); extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import cut, documents, one_row_each, text_or_empty

TRAIN_ROWS, MAX_UNITS = 20_000, 65_536
PREFIXES = (4, 5, 6)
PRIOR_DOCS, MIN_Z, MIN_DOCS, DRIFT = 100.0, 3.0, 3, 0.3
FOLDS, HELD_OUT = 5, 0
EULER = 0.5772156649015329

_WORD = np.zeros(256, bool)  # letters, digits, non-ASCII bytes
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


@dataclass
class Model:
    units: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    z: np.ndarray = field(default_factory=lambda: np.zeros(0))
    decay: float = 1.0
    scale: float = 1.0
    coef: tuple[float, float, float] = (0.0, 0.0, 0.0)


def _units(col: pa.Array):
    """(row of each word, matrix of unit hashes: whole word, then prefixes; 0 where none)."""
    buf, off = th.flat(col)
    buf = th.LOWER[buf]
    s, e, row = th._edges(_WORD[buf], off)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    first = np.searchsorted(lead, s)
    stops = np.r_[lead, len(buf)]
    out = np.zeros((len(s), 1 + len(PREFIXES)), np.uint64)
    out[:, 0] = th.span_hash(buf, s, e)
    for j, k in enumerate(PREFIXES, 1):
        end = np.minimum(stops[np.minimum(first + k, len(lead))], e)
        part = th.mix64(th.span_hash(buf, s, end) + th.U64(j))
        out[:, j] = np.where(end < e, part, th.mix64(out[:, 0] + th.U64(j)))  # a short word is its own prefix
    return row, out


def _count(batches):
    """Per chunk: unit, number of documents with it, by label."""
    for b in th.chunks(batches, "text"):
        row, units = _units(b.column("text"))
        label = b.column("label").to_numpy(zero_copy_only=False)
        r, u = th.distinct(np.repeat(row, units.shape[1]), units.ravel())
        if not len(u):
            continue
        h, inv = np.unique(u, return_inverse=True)
        toxic = np.bincount(inv, label[r], len(h)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(toxic), pa.array(np.bincount(inv, minlength=len(h)) - toxic)],
            names=["unit", "toxic", "clean"])


def word_scores(units: np.ndarray, model: Model) -> np.ndarray:
    out = np.full(len(units), -DRIFT)
    if not len(model.units) or not len(units):
        return out
    best = np.zeros(len(units))
    for j in range(units.shape[1]):
        at = np.minimum(np.searchsorted(model.units, units[:, j]), len(model.units) - 1)
        strong = (model.units[at] == units[:, j]) & (np.abs(model.z[at]) > best)
        out[strong] = model.weight[at][strong]
        best[strong] = np.abs(model.z[at])[strong]
    return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, word after the last, score), in one pass and linear time: each
    positive word opens a candidate, which swallows the candidates before it as long as that raises its score.
    A candidate points to the nearest one before it that starts from a smaller sum; looking for such
    a one follows these pointers, and what a pointer skips is never looked at again."""
    plus = np.flatnonzero(scores > 0)
    if not len(plus):
        return []
    total = np.r_[0.0, np.cumsum(scores)]
    found: list[tuple[int, int, float, float, int]] = []  # first, end, total before, total after, pointer
    for i, before, after in zip(plus.tolist(), total[plus].tolist(), total[plus + 1].tolist(), strict=True):
        first, end = i, i + 1
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append((first, end, before, after, j))
                break
            first, before = found[j][0], found[j][2]
            up = found[j][4]
            del found[j:]
            j = up
    return [(a, b, after - before) for a, b, before, after, _ in found]


def _features(col: pa.Array, model: Model):
    """Per row: number of words, and its segments."""
    row, units = _units(col)
    s = word_scores(units, model)
    at = th.bounds(row, len(col))
    any_plus = np.zeros(len(col), bool)
    any_plus[row[s > 0]] = True
    return [(int(b - a), segments(s[a:b]) if p else []) for a, b, p in zip(at[:-1], at[1:], any_plus, strict=True)]


def _evidence(n: int, segs, model: Model) -> tuple[float, float]:
    """(best normalised score, log of one plus the sum of significant normalised scores)."""
    if not segs:
        return 0.0, 0.0
    base = np.log(max(model.scale * n, 1e-9))
    x = np.array([model.decay * v - base for _, _, v in segs])
    plus = x[x > 0]
    return float(max(plus.max(), 0.0)) if len(plus) else 0.0, float(np.log1p(plus.sum()))


def probability(n: int, segs, model: Model) -> float:
    best, total = _evidence(n, segs, model)
    c = model.coef
    return float(1 / (1 + np.exp(-np.clip(c[0] + c[1] * best + c[2] * total, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Intercept and weights by Newton's method; the ridge leaves the intercept free."""
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    penalty = ridge * np.r_[1e-6, np.ones(a.shape[1] - 1)]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(h, a.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, max_units: int = MAX_UNITS) -> Model:
    spark = docs.sparkSession
    chosen = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
              .filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect())
    n = np.bincount([r["label"] for r in chosen], minlength=2)[:2]
    model = Model()
    if not n.all():
        rate = n[1] / max(1, n.sum())
        model.coef = (float(np.log(max(rate, 1e-12) / max(1 - rate, 1e-12))), 0.0, 0.0)
        return model
    sample = spark.createDataFrame([(r["doc_id"], r["label"]) for r in chosen], "doc_id bigint, label int")
    text = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
            .join(F.broadcast(sample), "doc_id"))
    text = cut(one_row_each(text, ["doc_id", "label"]).select("text", "label"), "labelled")  # at most ``rows`` rows
    counts = (text.mapInArrow(_count, "unit bigint, toxic bigint, clean bigint")
              .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .filter(F.col("toxic") + F.col("clean") >= MIN_DOCS))
    both = float(n.sum())
    prior = (F.col("toxic") + F.col("clean")) * (PRIOR_DOCS / both)

    def odds(c, total):
        return F.log((c + prior) / F.greatest(F.lit(total + PRIOR_DOCS) - c - prior, F.lit(0.5)))
    weighted = counts.withColumn("weight", odds(F.col("toxic"), float(n[1])) - odds(F.col("clean"), float(n[0])))
    weighted = weighted.withColumn("z", F.col("weight") / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)))
    kept = (weighted.filter(F.abs("z") >= MIN_Z).orderBy(F.abs("z").desc(), "unit").limit(max_units).toPandas())
    h = kept["unit"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    model.units, model.weight, model.z = h[order], kept["weight"].to_numpy()[order], kept["z"].to_numpy()[order]

    def word_values(batches):
        """Word scores of clean texts as (value, number), for the moment equation."""
        for b in th.chunks(batches, "text"):
            row, units = _units(b.column("text"))
            clean = b.column("label").to_numpy(zero_copy_only=False) == 0
            value, count = np.unique(word_scores(units, model)[clean[row]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], names=["value", "n"])

    def scan(batches):
        """Number of words and best segment of each row."""
        for b in th.chunks(batches, "text"):
            found = _features(b.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("label"), pa.array([k for k, _ in found], pa.int64()),
                 pa.array([max((v for _, _, v in segs), default=0.0) for _, segs in found], pa.float64())], names=["label", "n", "best"])

    def evidence(batches):
        for b in th.chunks(batches, "text"):
            x = np.array([_evidence(k, segs, model) for k, segs in _features(b.column("text"), model)])
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["label", "x", "y"])
    # at most one row for each weight of the model and one for words without any
    values = {r["value"]: r["n"] for r in text.mapInArrow(word_values, "value double, n bigint").groupBy("value").agg(
        F.sum("n").alias("n")).collect()}
    model.decay = _decay(values, model, float(n[0]))
    seen = text.mapInArrow(scan, "label int, n bigint, best double").collect()  # three numbers for each of at most ``rows`` rows
    clean = [r for r in seen if r["label"] == 0 and r["n"]]
    rest = [model.decay * r["best"] - np.log(r["n"]) for r in clean if r["best"] > 0]
    # the law's location is the mean less Euler's constant; texts without a positive word lie below
    model.scale = float(np.exp(np.mean(rest) - EULER) * len(rest) / len(clean)) if rest else 1.0 / (1 + sum(values.values()))
    pairs = sorted(tuple(r) for r in text.mapInArrow(evidence, "label int, x double, y double").collect())
    if pairs:
        model.coef = tuple(float(v) for v in _logistic(np.array([p[1:] for p in pairs]), np.array([p[0] for p in pairs], float)))
    return model


def _decay(values: dict[float, int], model: Model, clean_docs: float) -> float:
    """Positive root of the mean of exp(root * score) = 1 over words of clean texts.  One unseen
    occurrence of the strongest unit is added, so that the root exists."""
    v = np.array([*values, float(model.weight.max()) if len(model.weight) else 1.0])
    p = np.array([*values.values(), 1.0])
    v, p = v[:], p / p.sum()
    if not (v > 0).any() or (p @ v) >= 0:
        return 1.0
    lo, hi = 1e-6, 1.0
    while p @ np.exp(np.clip(hi * v, -700, 700)) < 1 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if p @ np.exp(np.clip(mid * v, -700, 700)) < 1 else (lo, mid)
    return hi


def toxic_segments(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_words and the significant passages (first word, word after the last, score)."""
    def run(batches):
        for b in th.chunks(batches, "text"):
            found = _features(b.column("text"), model)
            keep = [[{"first": a, "end": z, "score": v} for a, z, v in segs
                     if model.decay * v > np.log(max(model.scale * n, 1e-9))] for n, segs in found]
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([probability(n, segs, model) for n, segs in found], pa.float64()),
                 pa.array([n for n, _ in found], pa.int64()), pa.array(keep, kind)],
                names=["doc_id", "score", "n_words", "passages"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, score double, n_words bigint, passages array<struct<first:bigint,end:bigint,score:double>>")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic_segments(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_words", F.size("passages").cast("bigint").alias("n_passages"))
