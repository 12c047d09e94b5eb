"""Operator 9: quality classifier by co-training.

Two classifiers see two views of a document: its text (byte frequencies and ratios of case, symbols,
word and line repetition) and its page metadata (source and language by hashed indicators, stored
length, and the page's layout: lines, line lengths, and the gap between stored and real length).
Both start from the same labelled documents.  In each round each of them labels the documents of
an unlabelled pool it is surest of, in the classes' own proportion, and hands them to the other
one, which learns from them as if they were labelled.  After the rounds each view's output is
calibrated on labelled documents that neither was trained on, and a logistic model combines the two
calibrated views into the score of every document.

Bounds of the fit (documented parameters): ``LABELLED`` labelled and ``POOL`` unlabelled documents,
those of the smallest id hash; their feature vectors are the only rows that reach the driver, one for
each id (of rows that repeat an id, the one of the smallest text hash).  Every document is scored over its whole text.

Defined results: null and empty texts have zero text features; a null source, language or length is a
value of its own; without labels of both classes every score is the share of good labels (1 without
any), so nothing is rejected for lack of labels; repeated rows are scored one by one (the fit sees one of them); extra columns
are carried along; metadata columns that are missing count as null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents, one_row_each, text_or_empty

LABELLED, POOL = 12_000, 8_000
ROUNDS, PER_ROUND = 4, 400
CALIBRATION = 4  # every 4th labelled document calibrates instead of training
META_HASH = 64
REJECT_BELOW = 0.5
N_TEXT = 256 + 14
N_META = 2 * META_HASH + 8


def text_view(col: pa.Array) -> np.ndarray:
    """One row of ``N_TEXT`` features per text."""
    n = len(col)
    buf, off = th.flat(col)
    size = np.diff(off)
    out = np.zeros((n, N_TEXT), np.float32)
    hist = np.zeros((n, 256), np.int64)
    for k in range(n):  # by text: one array of 8 bytes a byte less
        hist[k] = np.bincount(buf[off[k]:off[k + 1]], minlength=256)
    length = np.maximum(size, 1)[:, None]
    out[:, :256] = np.sqrt(hist / length)

    def share(*codes):
        return hist[:, list(codes)].sum(1) / length[:, 0]
    upper, lower = share(*range(65, 91)), share(*range(97, 123))
    s, e, r = th.words(buf, off)
    words = np.bincount(r, minlength=n)
    many = np.maximum(words, 1)
    h = th.span_hash(buf, s, e)
    dr, dh = th.distinct(r, h)
    pr, _ = th.distinct(*_pairs(h, r))
    ls, le, lr = th.lines(buf, off)
    lines = np.bincount(lr, minlength=n)
    ldr, _ = th.distinct(lr, th.span_hash(buf, ls, le))
    wlen = e - s
    tail = buf[e - 1] if len(e) else np.zeros(0, np.uint8)
    letter = ((tail | 32) >= 97) & ((tail | 32) <= 122) | (tail >= 128)
    stop = np.isin(tail, np.frombuffer(b".,;:", np.uint8))
    odd = np.bincount(r[~letter & ~stop], minlength=n) / many
    feats = [upper / np.maximum(upper + lower, 1e-6), share(*range(48, 58)), share(*b"#$%&*|@^~_=<>{}[]\\"), share(*b"!?"),
             share(*b".,;:"), share(10), share(32), np.bincount(dr, minlength=n) / many,
             np.bincount(pr, minlength=n) / np.maximum(words - 1, 1), np.bincount(ldr, minlength=n) / np.maximum(lines, 1),
             np.bincount(r, wlen, n) / many / 10, odd, np.bincount(r[wlen <= 1], minlength=n) / many,
             np.log1p(words) / 10]
    out[:, 256:] = np.stack(feats, 1)
    out[size == 0] = 0
    return out


def _pairs(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g, r = th.grams(h, row, 2, short=False)
    return r, g


def _indicator(col: pa.Array, salt: int) -> np.ndarray:
    texts = pa.array([f"{salt}:{v}" for v in col.to_pylist()], pa.string())
    buf, off = th.flat(texts)
    h = th.span_hash(buf, off[:-1], off[1:])
    out = np.zeros((len(col), META_HASH), np.float32)
    out[np.arange(len(col)), (h % th.U64(META_HASH)).astype(int)] = 1
    return out


def meta_view(b: pa.RecordBatch) -> np.ndarray:
    n = b.num_rows
    buf, off = th.flat(b.column("text"))
    stored = np.array([np.nan if v is None else float(v) for v in b.column("n_chars").to_pylist()])
    lead = (buf & 0xC0) != 0x80
    real = np.array([np.count_nonzero(lead[a:z]) for a, z in zip(off[:-1], off[1:], strict=True)], np.int64)
    s, e, r = th.lines(buf, off)
    lines = np.bincount(r, minlength=n)
    mean = np.bincount(r, e - s, n) / np.maximum(lines, 1)
    var = np.bincount(r, (e - s - mean[r]) ** 2, n) / np.maximum(lines, 1) if len(r) else np.zeros(n)
    short = np.bincount(r[e - s < 40], minlength=n) / np.maximum(lines, 1)
    known = ~np.isnan(stored)
    gap = np.where(known, np.abs(np.nan_to_num(stored) - real) / np.maximum(real, 1), 0)
    dense = np.stack([np.log1p(np.maximum(np.nan_to_num(stored), 0)) / 10, known, np.log1p(lines) / 5, np.log1p(mean) / 5,
                      np.log1p(np.sqrt(var)) / 5, short, np.minimum(gap, 1), real == 0], 1)
    return np.concatenate([_indicator(b.column("source"), 1), _indicator(b.column("lang"), 2), dense.astype(np.float32)], 1)


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray  # of a view's raw output: intercept, slope
    meta_scale: np.ndarray
    both: np.ndarray        # intercept and the two views' weights


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 8) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the free intercept."""
    a = np.c_[x, np.ones(len(x))].astype(np.float64)
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(a @ w)
        h = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(h, a.T @ (y - p) - penalty * w)
        w += step * min(1.0, 10 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return w


def _raw(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def score(text: np.ndarray, meta: np.ndarray, m: Model) -> np.ndarray:
    t = m.text_scale[0] * _raw(text, m.text) + m.text_scale[1]
    g = m.meta_scale[0] * _raw(meta, m.meta) + m.meta_scale[1]
    return _sigmoid(m.both[0] * t + m.both[1] * g + m.both[2])


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> Model:
    """``label`` is 1, 0, or -1 for the pool."""
    known = np.flatnonzero(label >= 0)
    held = known[CALIBRATION - 1::CALIBRATION]
    if len(np.unique(label[held])) < 2:
        held = known
    train = known if len(held) == len(known) else np.setdiff1d(known, held)
    if len(np.unique(label[train])) < 2:
        train = known
    pool = np.flatnonzero(label < 0)
    share = label[train].mean()
    views = [text, meta]
    rows = [train, train]
    given = [label[train].astype(float)] * 2
    open_ = [np.ones(len(pool), bool)] * 2
    weights = [_logistic(v[train], given[0], 1.0) for v in views]
    for _ in range(rounds):
        for k in (0, 1):
            free = np.flatnonzero(open_[1 - k])
            if not len(free):
                continue
            p = _sigmoid(_raw(views[k][pool[free]], weights[k]))
            order = np.argsort(-p, kind="stable")
            n = min(per_round, len(free))
            good = int(round(n * share))
            picked = np.r_[order[:good], order[len(order) - (n - good):]]
            sure = np.r_[np.ones(good), np.zeros(n - good)]
            clear = np.where(sure > 0, p[picked] > 0.8, p[picked] < 0.2)  # only confident labels pass on
            picked, sure = free[picked[clear]], sure[clear]
            open_[1 - k] = open_[1 - k].copy()
            open_[1 - k][picked] = False
            rows[1 - k] = np.r_[rows[1 - k], pool[picked]]
            given[1 - k] = np.r_[given[1 - k], sure]
        weights = [_logistic(v[r], g, 1.0) for v, r, g in zip(views, rows, given, strict=True)]
    scales, outs = [], []
    y = label[held].astype(float)
    for v, w in zip(views, weights, strict=True):
        raw = _raw(v[held], w)[:, None]
        scales.append(_logistic(raw, y, 0.01))
        outs.append(scales[-1][0] * raw[:, 0] + scales[-1][1])
    return Model(weights[0], weights[1], scales[0], scales[1], _logistic(np.stack(outs, 1), y, 0.1))


META = (("lang", "string"), ("source", "string"), ("n_chars", "bigint"))


def _viewed(docs: DataFrame, keep: list) -> DataFrame:
    have = set(docs.columns)
    return docs.select(*keep, text_or_empty().alias("text"), *[
        (F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in META])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model | float:
    """The trained model, or the share of good labels where there is nothing to tell apart."""
    spark = docs.sparkSession
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").cast("int").alias("label")))
    first = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled).collect()
    if len({r["label"] for r in first}) < 2:
        return float(np.mean([r["label"] for r in first])) if first else 1.0
    others = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null").distinct()
              .join(known, "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool).collect())
    chosen = spark.createDataFrame([(r["doc_id"], r["label"]) for r in first] + [(r["doc_id"], -1) for r in others],
                                   "chosen_id bigint, label int")
    rows = one_row_each(_viewed(docs.join(F.broadcast(chosen), F.col("doc_id").cast("bigint") == F.col("chosen_id")),
                                ["chosen_id", "label"]), ["chosen_id", "label"])  # at most ``labelled + pool`` rows

    def view(batches):
        for b in th.chunks(batches, "text"):
            x = np.concatenate([text_view(b.column("text")), meta_view(b)], 1).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [b.column("chosen_id"), b.column("label"), pa.array([v.tobytes() for v in x], pa.binary())],
                names=["chosen_id", "label", "x"])
    seen = rows.mapInArrow(view, "chosen_id bigint, label int, x binary").toPandas().sort_values("chosen_id", kind="stable")
    y = seen["label"].to_numpy(int)
    if len(set(y[y >= 0])) < 2:  # labels of documents that aren't there
        return float(y[y >= 0].mean()) if (y >= 0).any() else 1.0
    x = np.frombuffer(b"".join(seen["x"]), np.float32).reshape(len(seen), N_TEXT + N_META)
    return co_train(x[:, :N_TEXT], x[:, N_TEXT:], y)


def quality(docs: DataFrame, model: Model | float, column: str = "score") -> DataFrame:
    """``docs`` with ``column``: the probability that a document is good."""
    names = docs.columns
    rows = _viewed(docs, [F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(names)])

    def run(batches):
        for b in th.chunks(batches, "text"):
            if isinstance(model, float):
                p = np.full(b.num_rows, model)
            else:
                p = score(text_view(b.column("text")), meta_view(b), model)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(names))] + [pa.array(p, pa.float64())],
                                             names=[*b.schema.names[:len(names)], "p"])
    schema = ", ".join([*(f"own_{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)), "p double"])
    return rows.mapInArrow(lambda it: th.lean(run(it)), schema).select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(names)],
                                               F.col("p").alias(column))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality(docs.select("doc_id", "text", "lang", "source", "n_chars"), model)
    return scored.select("doc_id", "score", (F.col("score") >= REJECT_BELOW).alias("kept"))
