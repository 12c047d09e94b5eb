"""Operator 2: packing token sequences by patterns fitted with non-negative least squares.

Documents become token counts, documents longer than ``limit`` are cut into full pieces and a rest,
and the pieces' lengths become a histogram of at most ``limit`` bins.  On the driver, which only
ever sees this histogram: every pattern of up to three lengths that fills a sequence exactly is
enumerated, repeat counts that reproduce the histogram are fitted by non-negative least squares
(accelerated projected gradient), rounded and bounded by what is there, and the residual
lengths are packed by best fit, longest first, on counts instead of pieces.  The plan is a list
of slots: so many pieces of one length go to consecutive sequences at one offset.

Pieces find their slot by their rank among the pieces of the same length.  Ranks are dealt without
a window over a whole length: rows are numbered within (length, salt) and shifted by the counts of
the salts before, so that a length that a third of all pieces have is spread over the cluster.

Defined results: null text is the empty text, which still has its end token (id 0); rows equal in
id are packed one by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import texthash as th
from .common import cut, documents, parts, text_or_empty

LIMIT, END = 2048, 0
TOKENIZER = "word_bpe_49k.json"  # of the public_tokenizers folder
ITERATIONS = 200
SALTS_PER_TASK = 2
RANK_SPAN = 1 << 44  # more than the pieces of one length


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


SEPARATOR = "<|endoftext|>"  # a special token of the vocabulary; no word that holds one is joined
CACHE_WORDS = 1 << 20
JOINED = 512  # words encoded at once


class WordIds:
    """Token ids of words, remembered in a task's process from chunk to chunk: sorted word hashes
    with their place in a pool of ids.  Beyond ``CACHE_WORDS`` it starts anew."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.clear()

    def clear(self):
        self.hash = np.zeros(0, np.uint64)
        self.at = self.size = np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids by word); words are encoded joined by the separator, whose id cuts them."""
        odd = [i for i, w in enumerate(words) if "<|" in w]
        if odd:
            known = set(odd)
            plain = self._encode([w for i, w in enumerate(words) if i not in known])
            parts_ = np.split(plain[0], np.cumsum(plain[1])[:-1]) if len(plain[1]) else []
            rest = iter(parts_)
            each = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) if i in known
                    else next(rest) for i, w in enumerate(words)]
            return np.concatenate(each), np.array([len(x) for x in each], np.int64)
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        cut_at = self.tokenizer.token_to_id(SEPARATOR)
        texts = [SEPARATOR.join(words[i:i + JOINED]) + SEPARATOR for i in range(0, len(words), JOINED)]
        # the fast call keeps no character offsets; one text at a time, so that its lists are freed at once
        ids = np.concatenate([np.array(self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids, np.uint32)
                              for t in texts])
        ends = np.flatnonzero(ids == cut_at)
        return ids[ids != cut_at], np.diff(np.r_[-1, ends]) - 1

    def find(self, h: np.ndarray, word_of) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pool, number of ids) of sorted distinct hashes; ``word_of(i)`` is the i-th word."""
        if len(self.hash) + len(h) > CACHE_WORDS:
            self.clear()
        pos = np.searchsorted(self.hash, h)
        known = np.zeros(len(h), bool)
        inside = pos < len(self.hash)
        known[inside] = self.hash[pos[inside]] == h[inside]
        new = np.flatnonzero(~known)
        if len(new):
            ids, size = self._encode([word_of(i) for i in new])
            if self.used + len(ids) > len(self.pool):
                self.pool = np.r_[self.pool[:self.used], np.zeros(self.used + 2 * len(ids), np.uint32)]
            self.pool[self.used:self.used + len(ids)] = ids
            at = self.used + np.cumsum(size) - size
            self.used += len(ids)
            self.hash, self.at, self.size = (np.insert(x, pos[new], y) for x, y in (
                (self.hash, h[new]), (self.at, at), (self.size, size)))
            pos = np.searchsorted(self.hash, h)
        return self.at[pos], self.size[pos]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def encode(col: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the texts, each closed by ``END``.  The tokenizer never joins characters
    across white space, so each distinct word is encoded once and remembered."""
    buf, off = th.flat(col)
    s, e, row = th.words(buf, off)
    h, first, which = np.unique(th.span_hash(buf, s, e), return_index=True, return_inverse=True)
    raw = buf.tobytes()
    cache = _word_ids(path)
    at, size = cache.find(h, lambda i: raw[s[first[i]]:e[first[i]]].decode())
    # words and, after each text's last word, its end token
    n = len(col)
    end_at = np.cumsum(np.bincount(row, minlength=n) + 1) - 1
    length = np.ones(len(s) + n, np.int64)
    start = np.zeros(len(s) + n, np.int64)
    is_word = np.ones(len(s) + n, bool)
    is_word[end_at] = False
    length[is_word], start[is_word] = size[which], at[which]
    to = np.cumsum(length) - length
    ids = cache.pool[np.repeat(start - to, length) + np.arange(int(length.sum()))]
    ids[to[end_at]] = END
    return ids, np.r_[0, np.cumsum(length)[end_at]]


def pieces(docs: DataFrame, limit: int = LIMIT, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids themselves with ``with_ids``)."""
    path = path or tokenizer_path()

    def run(batches):
        for b in th.chunks(batches, "text"):
            ids, at = encode(b.column("text"), path)
            size = np.diff(at)
            n = -(-size // limit)
            doc = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * limit
            length = np.minimum(size[doc] - start, limit)
            lo = at[doc] + start
            ids = ids.astype("<u4")
            crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(lo, length, strict=True)]
            out = [b.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                   pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array([ids[a:a + k].astype(np.int32) for a, k in zip(lo, length, strict=True)],
                                    pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        lambda it: th.lean(run(it)), schema)


# ---- the plan, from the histogram alone ----------------------------------------------------------
def patterns(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Every multiset of one to three of the lengths that sums to ``limit``; rows padded with 0."""
    have = np.zeros(limit + 1, bool)
    have[lengths] = True
    out = [np.array([[limit, 0, 0]])] if have[limit] else []
    a = np.flatnonzero(have[:limit])
    a = a[a > 0]
    b = limit - a
    two = (a <= b) & have[b]
    out.append(np.c_[a[two], b[two], np.zeros(two.sum(), int)])
    for x in a[a <= limit // 3]:
        y = a[(a >= x) & (2 * a <= limit - x)]
        z = limit - x - y
        ok = have[z]
        out.append(np.c_[np.full(ok.sum(), x), y[ok], z[ok]])
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def fit(pats: np.ndarray, hist: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - hist|^2, A the lengths' counts in patterns."""
    size = len(hist)
    if not len(pats):
        return np.zeros(0)

    def times(x):
        y = sum(np.bincount(pats[:, j], x, size) for j in range(3))
        y[0] = 0
        return y

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[pats[:, 0]] + r[pats[:, 1]] + r[pats[:, 2]]

    v = np.ones(len(pats))
    for _ in range(12):  # largest eigenvalue of A'A
        v = back(times(v))
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (1.05 * top)
    x = y = np.zeros(len(pats))
    t = 1.0
    target = hist.astype(float)
    target[0] = 0
    for _ in range(iterations):
        new = np.maximum(0, y - step * back(times(y) - target))
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / s * (new - x), new, s
    return x


def plan(hist: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Slots (length, first rank, number, first sequence, offset) that place every piece once."""
    left = hist.astype(np.int64).copy()
    left[0] = 1  # pads patterns of fewer pieces
    taken = np.zeros(limit + 1, np.int64)  # ranks given out so far, by length
    slots: list[tuple[int, int, int, int, int]] = []
    seq = 0

    def place(length, n, first_seq, offset):
        slots.append((length, int(taken[length]), int(n), int(first_seq), int(offset)))
        taken[length] += n
        left[length] -= n

    def repeat(pattern, wanted):
        """Places up to ``wanted`` repeats of a pattern; how many there were pieces for."""
        nonlocal seq
        used = [int(v) for v in pattern if v]
        n = min(wanted, *(int(left[v]) // used.count(v) for v in used))
        if n > 0:
            offset = 0
            for v in sorted(used, reverse=True):
                place(v, n, seq, offset)
                offset += v
            seq += n
        return max(n, 0)

    while True:
        # whole parts of the fitted counts, then one more each by largest remainder; what is left is fitted again
        pats = patterns(np.flatnonzero(left), limit)
        x = fit(pats, left)
        whole = np.floor(x).astype(np.int64)
        placed = sum(repeat(pats[p], int(whole[p])) for p in np.flatnonzero(whole)[np.argsort(-whole[whole > 0], kind="stable")])
        for p in np.argsort(whole - x, kind="stable"):
            if (left[pats[p]] > 0).all():  # left[0] stands for no further piece
                placed += repeat(pats[p], 1)
        if not placed:
            break
    # residuals: best fit on counts, longest first; open[space] has (first sequence, number)
    open_: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]
    for v in range(limit, 0, -1):
        space = v
        while left[v]:
            while space <= limit and not open_[space]:
                space += 1
            if space > limit:
                fresh = -(-int(left[v]) // max(1, limit // v)) if limit // v > 1 else int(left[v])
                open_[limit].append((seq, fresh))
                seq += fresh
                space = limit
            at, n = open_[space].pop()
            k = min(n, int(left[v]))
            if k < n:
                open_[space].append((at + k, n - k))
            place(v, k, at, limit - space)
            open_[space - v].append((at, k))
            space = max(v, space - v) if space - v >= v else space
    return np.array(slots, np.int64).reshape(-1, 5)


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: from 0 without gaps among the rows of the same length."""
    salts = SALTS_PER_TASK * parts(rows.sparkSession)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
             .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.join(shift, ["length", "salt"])
            .withColumn("rank", F.col("shift") + F.row_number().over(own) - 1).drop("salt", "shift"))


def pack(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns, with ``length`` of 1 to ``limit``)."""
    hist = np.zeros(limit + 1, np.int64)
    for r in rows.groupBy("length").count().collect():  # at most ``limit`` rows
        hist[r["length"]] = r["count"]
    slots = plan(hist, limit)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    key = slots[:, 0] * RANK_SPAN + slots[:, 1]

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length * RANK_SPAN + rank, "right") - 1
            out = pa.Table.from_batches([b]).drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(slots[at, 3] + rank - slots[at, 1]))
            yield from out.append_column("offset", pa.array(slots[at, 4])).to_batches()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    ranked = _ranked(rows).select(*rows.columns, "rank")
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(cut(pieces(documents(spark, sf_dir)), "pieces"))
