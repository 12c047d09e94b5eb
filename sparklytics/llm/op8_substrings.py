"""Operator 8: substring deduplication with a compressed FM-index per shard.

A window is ``DEPTH`` consecutive words (unchanged) of one document; a word goes if a window that
covers it also starts in a document of smaller id.  Windows are judged on the input.

Sharding: every window belongs to its anchor, the five-word gram of smallest hash in it (the leftmost of
ties), so equal windows have equal anchors and meet in one shard, wherever they are.  Round one sends
only the batches' distinct anchors, 40 bits each, and returns one bit: whether the anchor occurs
in another document.  Round two sends the segments of shared anchors (the consecutive windows of one
anchor, 13 to 21 words), each distinct segment once per batch with its smallest document.

A shard lays its distinct segments out by smallest document, with separators, and builds the FM-index
of that text of word symbols: suffixes sorted by their first ``DEPTH`` words (ties by position, hence
by document), the Burrows-Wheeler transform of that order in a wavelet matrix of packed bit vectors.
Limiting the sort's depth keeps backward search exact for patterns up to the depth.  Segments are
streamed against the index: backward search gives each word's matching statistics up to the
threshold; where a full window matches, the first suffix of its interval names the smallest document
that has it.  Only one bit per window goes back.

The batch's own documents need no search: of equal segments in a batch, all but the smallest
document's lose their windows.

Defined results: null text has no words; documents of fewer than ``DEPTH`` words never change; a
repeat within one document, or between rows of one id, is not a match; a null ``doc_id`` is larger than
any other; extra columns are ignored.  Words are compared by 40-bit hashes, so a window could
be taken for another only if all its differing words collide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents
from .exchange import by_shard, dealt, pack, pack_sorted, shard_of, table, unpack, unpack_sorted

DEPTH, ANCHOR = 13, 5
BITS40 = (1 << 40) - 1
LAST = (1 << 63) - 1  # id of a null doc_id


# ---- the index ------------------------------------------------------------------------------------
class Wavelet:
    """Wavelet matrix: one packed bit vector with counts per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        s = symbols
        for level in range(self.levels):
            bit = (s >> (self.levels - 1 - level)) & 1
            packed = np.packbits(np.r_[bit.astype(np.uint8), np.zeros(64 + -len(bit) % 64, np.uint8)], bitorder="little")
            w = packed.view("<u8")
            self.words.append(w)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(w).astype(np.int64))])
            self.zeros.append(int((bit == 0).sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        at = np.zeros(sigma, np.int64)
        self.start = np.zeros(sigma, np.int64)
        self.start = self._down(np.arange(sigma), at)

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            block = i >> 6
            inside = self.words[level][block] & ((th.U64(1) << (i & 63).astype(np.uint64)) - th.U64(1))
            ones = self.counts[level][block] + np.bitwise_count(inside)
            i = np.where((c >> (self.levels - 1 - level)) & 1 == 1, self.zeros[level] + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c occurs before position i."""
        return self._down(c, i) - self.start[c]


class FMIndex:
    """Depth-bounded FM-index of a sequence of symbols from 0; exact for patterns up to ``depth``."""

    def __init__(self, text: np.ndarray, depth: int = DEPTH):
        n = len(text)
        self.depth = depth
        rank = text.astype(np.int64)
        have = 1

        def sort(rank, step):
            ahead = np.zeros(n, np.int64)
            ahead[:n - step] = rank[step:] + 1
            key = rank * (int(rank.max(initial=0)) + 2) + ahead
            order = np.argsort(key, kind="stable")
            k = key[order]
            dense = np.empty(n, np.int64)
            dense[order] = np.cumsum(np.r_[0, k[1:] != k[:-1]])
            return order, dense
        order = np.argsort(rank, kind="stable")
        while have < depth and n > 1:
            step = min(have, depth - have)
            if step >= n:
                break
            order, rank = sort(rank, step)
            have += step
        self.suffix = order
        sigma = int(text.max(initial=0)) + 1
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))]
        self.wavelet = Wavelet(text[order - 1], sigma)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: intervals of c + pattern from those of the patterns."""
        return self.first[c] + self.wavelet.rank(c, lo), self.first[c] + self.wavelet.rank(c, hi)

    def match(self, text: np.ndarray, end: np.ndarray, limit: np.ndarray, least: int = 1):
        """Matching statistics: for each end in ``text`` the longest suffix of at most ``limit`` symbols
        before it that occurs at least ``least`` times in the index, as (length, low, high)."""
        n = len(end)
        length = np.zeros(n, np.int64)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.suffix))
        live = np.arange(n)
        step = 1
        while len(live):
            live = live[limit[live] >= step]
            c = text[end[live] - step]
            lo, hi = self.extend(c, low[live], high[live]) if step > 1 else (self.first[c], self.first[c + 1])
            ok = hi - lo >= least
            live = live[ok]
            low[live], high[live], length[live] = lo[ok], hi[ok], step
            step += 1
        return length, low, high


# ---- segments -------------------------------------------------------------------------------------
class Windows:
    """Words, windows and anchors of a batch's texts."""

    def __init__(self, col: pa.Array):
        self.buf, self.off = th.flat(col)
        self.start, self.end, self.row = th.words(self.buf, self.off)
        h = th.span_hash(self.buf, self.start, self.end)
        self.symbol = h & th.U64(BITS40)
        n = len(h)
        empty = np.zeros(0, np.int64)
        self.first, self.anchor_at, self.anchor = empty, empty, np.zeros(0, np.uint64)
        if n >= DEPTH:
            g = _grams(h, ANCHOR)
            ok = np.flatnonzero(self.row[:n - DEPTH + 1] == self.row[DEPTH - 1:])
            least = sliding_window_view(g, DEPTH - ANCHOR + 1)[ok].argmin(axis=1) + ok
            self.first, self.anchor_at, self.anchor = ok, least, g[least]  # per window: first word, anchor
        new = np.ones(len(self.first), bool)
        new[1:] = self.anchor_at[1:] != self.anchor_at[:-1]
        new[1:] |= self.row[self.first[1:]] != self.row[self.first[:-1]]
        self.seg = np.flatnonzero(new)  # first window of each segment
        self.size = np.diff(np.r_[self.seg, len(self.first)])  # windows
        self.seg_anchor = self.anchor[self.seg]
        self.seg_row = self.row[self.first[self.seg]]
        self.h = h


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    mult = th.mix64(np.arange(101, 101 + k, dtype=np.uint64)) | th.U64(1)
    g = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        g += th.mix64(h[j:len(h) - k + 1 + j] * mult[j])
    return th.mix64(g)


def _rid(t: pa.Table) -> np.ndarray:
    return t["doc_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _ask_anchors(t: pa.Table, shards: int) -> pa.Table:
    w, rid = Windows(t["text"]), _rid(t)
    keys, many, shard = _batch_anchors(w, rid, shards)
    order, cuts = by_shard(shard, shards)
    some = np.flatnonzero(np.diff(cuts))
    got = [order[cuts[k]:cuts[k + 1]] for k in some]
    return table({"batch": ([t["batch"][0].as_py()] * len(some), pa.int64()), "shard": (some.tolist(), pa.int64()),
                  "keys": ([pack_sorted(keys[i] & th.U64(BITS40), 5) for i in got], pa.binary()),
                  "many": ([np.packbits(many[i]).tobytes() for i in got], pa.binary())})


def _batch_anchors(w: Windows, rid: np.ndarray, shards: int):
    """The batch's distinct anchors in order of their 40 bits, whether two of its ids have each, shards."""
    short = (w.seg_anchor & th.U64(BITS40))
    keys, which = np.unique(short, return_inverse=True)
    ids = rid[w.seg_row]
    low, high = np.full(len(keys), LAST), np.full(len(keys), -(1 << 63))
    np.minimum.at(low, which, ids)
    np.maximum.at(high, which, ids)
    return keys, low < high, shard_of(keys, shards)


def _share_anchors(t: pa.Table) -> pa.Table:
    ks = [unpack_sorted(x, 5) for x in t["keys"].to_pylist()]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)).astype(bool)
            for m, k in zip(t["many"].to_pylist(), ks, strict=True)]
    keys, which, n = np.unique(np.concatenate(ks), return_inverse=True, return_counts=True)
    shared = n > 1
    np.logical_or.at(shared, which, np.concatenate(many))
    out = [np.packbits(shared[i]).tobytes() for i in np.split(which, np.cumsum([len(k) for k in ks])[:-1])]
    return table({"batch": (t["batch"].to_pylist(), pa.int64()), "shard": (t["shard"].to_pylist(), pa.int64()),
                  "bits": (out, pa.binary())})


class Shared:
    """The batch's segments of shared anchors, and the distinct ones in shard order."""

    def __init__(self, w: Windows, rid: np.ndarray, shared: dict[int, bytes], shards: int):
        keys, _, shard = _batch_anchors(w, rid, shards)
        order, cuts = by_shard(shard, shards)
        is_shared = np.zeros(len(keys), bool)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            i = order[cuts[s]:cuts[s + 1]]
            is_shared[i] = np.unpackbits(np.frombuffer(shared[s], np.uint8), count=len(i)).astype(bool)
        short = w.seg_anchor & th.U64(BITS40)
        self.seg = np.flatnonzero(is_shared[np.searchsorted(keys, short)]) if len(keys) else np.zeros(0, np.int64)
        first, size = w.first[w.seg[self.seg]], w.size[self.seg]
        self.first, self.size = first, size
        self.rid = rid[w.seg_row[self.seg]]
        # at most 21 words: the first and the last window spell the whole segment
        if len(first):
            win = _grams(w.h, DEPTH)
            key = th.mix64(win[first] * th.U64(3) + win[first + size - 1]) ^ th.mix64(size.astype(np.uint64))
        else:
            key = np.zeros(0, np.uint64)
        by = np.lexsort((self.rid, key))
        new = np.r_[True, key[by][1:] != key[by][:-1]] if len(by) else np.zeros(0, bool)
        self.which = np.empty(len(by), np.int64)
        self.which[by] = np.cumsum(new) - 1
        self.example = by[new]  # of each distinct segment, an occurrence in its smallest document
        self.low = self.rid[self.example]
        self.shard = shard_of(short[self.seg[self.example]], shards)


def _ask_segments(t: pa.Table, replies: pa.Table, shards: int) -> pa.Table:
    names = {"batch": pa.int64(), "shard": pa.int64(), "symbols": pa.binary(), "sizes": pa.binary(), "ids": pa.binary()}
    if not t.num_rows:
        return pa.schema(list(names.items())).empty_table()
    w = Windows(t["text"])
    s = Shared(w, _rid(t), dict(zip(replies["shard"].to_pylist(), replies["bits"].to_pylist(), strict=True)), shards)
    order, cuts = by_shard(s.shard, shards)
    out = {c: [] for c in names}
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        i = order[cuts[k]:cuts[k + 1]]
        occ = s.example[i]
        n = s.size[occ] + DEPTH - 1
        to = np.cumsum(n) - n
        words = w.symbol[np.repeat(s.first[occ] - to, n) + np.arange(int(n.sum()))]
        for c, v in zip(out, (t["batch"][0].as_py(), k, pack(words, 5), pack(n, 1), pack(s.low[i].view(np.uint64), 8)), strict=True):
            out[c].append(v)
    return table({c: (out[c], kind) for c, kind in names.items()})


def _search(t: pa.Table) -> pa.Table:
    """Builds the shard's index and streams the segments against it."""
    sizes = [unpack(x, 1).astype(np.int64) for x in t["sizes"].to_pylist()]
    ids = np.concatenate([unpack(x, 8).view(np.int64) for x in t["ids"].to_pylist()])
    raw = np.concatenate([unpack(x, 5) for x in t["symbols"].to_pylist()])
    n = np.concatenate(sizes)
    bits = [b""] * t.num_rows
    if len(n):
        names, sym = np.unique(raw, return_inverse=True)
        sym = sym + 1  # 0 separates segments
        at = np.cumsum(n) - n
        # distinct segments: equal when their words are
        power = np.cumsum(th.mix64(names)[sym - 1] * _weights(n), dtype=np.uint64)
        content = power[at + n - 1] - np.where(at > 0, power[at - 1], 0)
        key = th.mix64(content + n.astype(np.uint64))
        by = np.lexsort((ids, key))
        new = np.r_[True, key[by][1:] != key[by][:-1]]
        which = np.empty(len(by), np.int64)
        which[by] = np.cumsum(new) - 1
        keep = by[new]
        order = np.argsort(ids[keep], kind="stable")  # by smallest document
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        which, keep = place[which], keep[order]
        m = n[keep] + 1
        to = np.cumsum(m) - m
        text = np.zeros(int(m.sum()), np.int64)
        inside = np.repeat(to, n[keep]) + _ramp(n[keep])
        text[inside] = sym[np.repeat(at[keep], n[keep]) + _ramp(n[keep])]
        index = FMIndex(text)
        doc = np.repeat(ids[keep], m)
        # each distinct segment's windows: the smallest document that has the same words
        wins = m - DEPTH
        end = np.repeat(to + DEPTH, wins) + _ramp(wins)
        lowest = doc[end - 1].copy()
        length, low, _ = index.match(text, end, np.full(len(end), DEPTH), least=2)
        full = length == DEPTH
        lowest[full] = doc[index.suffix[low[full]]]
        w0 = np.cumsum(wins) - wins
        mine = wins[which]
        hit = lowest[np.repeat(w0[which], mine) + _ramp(mine)] < np.repeat(ids, mine)
        cut = np.cumsum([int(mine[a:b].sum()) for a, b in _spans([len(x) for x in sizes])])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(hit, cut)]
    return table({"batch": (t["batch"].to_pylist(), pa.int64()), "shard": (t["shard"].to_pylist(), pa.int64()),
                  "bits": (bits, pa.binary())})


def _ramp(n: np.ndarray) -> np.ndarray:
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _weights(n: np.ndarray) -> np.ndarray:
    return th.mix64(np.arange(1, 2 * DEPTH + 2, dtype=np.uint64))[_ramp(n)]


def _spans(sizes):
    at = 0
    for k in sizes:
        yield at, at + k
        at += k


def _remove(t: pa.Table, replies: pa.Table, shards: int, unchanged: str) -> pa.Table:
    rest = t.drop_columns(["batch", "text"])
    if not t.num_rows:
        for name, kind in (("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())):
            rest = rest.append_column(name, pa.array([], kind))
        return rest
    w, rid = Windows(t["text"]), _rid(t)
    got: tuple[dict, dict] = {}, {}
    for round_, shard, bits in zip(*(replies[c].to_pylist() for c in ("round", "shard", "bits")), strict=True):
        got[round_ - 1][shard] = bits
    s = Shared(w, rid, got[0], shards)
    # windows of the distinct segments, then of every occurrence
    wins = s.size[s.example]
    hit = np.zeros(int(wins.sum()), bool)
    w0 = np.cumsum(wins) - wins
    order, cuts = by_shard(s.shard, shards)
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        i = order[cuts[k]:cuts[k + 1]]
        hit[np.repeat(w0[i], wins[i]) + _ramp(wins[i])] = np.unpackbits(
            np.frombuffer(got[1][k], np.uint8), count=int(wins[i].sum())).astype(bool)
    gone = np.repeat(s.rid > s.low[s.which], s.size) | hit[np.repeat(w0[s.which], s.size) + _ramp(s.size)]
    at = (np.repeat(s.first, s.size) + _ramp(s.size))[gone]
    cover = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + DEPTH, -1)
    drop = np.cumsum(cover)[:-1] > 0
    n = t.num_rows
    n_words, n_removed = np.bincount(w.row, minlength=n), np.bincount(w.row[drop], minlength=n)
    raw = w.buf.tobytes()
    bounds = th.bounds(w.row, n)
    kept = []
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        if unchanged == "as_it_was" and not n_removed[i]:
            kept.append(raw[w.off[i]:w.off[i + 1]].decode())
            continue
        at = a + np.flatnonzero(~drop[a:b])
        kept.append(b" ".join([raw[x:y] for x, y in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)]).decode())
    for name, values in (("n_words", pa.array(n_words, pa.int64())), ("n_removed", pa.array(n_removed, pa.int64())),
                         ("kept_text", pa.array(kept, pa.string()))):
        rest = rest.append_column(name, values)
    return rest


def substring_dedup(docs: DataFrame, unchanged: str = "joined") -> DataFrame:
    """All columns of ``docs`` but text, n_words, n_removed and kept_text: the kept words joined by one
    space.  With ``unchanged="as_it_was"``, a text that loses nothing keeps its own white space."""
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows, shards = dealt(docs, *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own)])
    anchors = (rows.groupBy("batch")
               .applyInArrow(lambda t: th.lean_group(_ask_anchors(t, shards)), "batch bigint, shard bigint, keys binary, many binary")
               .groupBy("shard").applyInArrow(lambda t: th.lean_group(_share_anchors(t)), "batch bigint, shard bigint, bits binary"))
    found = (rows.groupBy("batch").cogroup(anchors.groupBy("batch"))
             .applyInArrow(lambda t, r: th.lean_group(_ask_segments(t, r, shards)),
                           "batch bigint, shard bigint, symbols binary, sizes binary, ids binary")
             .groupBy("shard").applyInArrow(lambda t: th.lean_group(_search(t)), "batch bigint, shard bigint, bits binary"))
    both = anchors.withColumn("round", F.lit(1)).unionByName(found.withColumn("round", F.lit(2)))
    carried = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name.startswith("own_")]
    out = rows.groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(
        lambda t, r: th.lean_group(_remove(t, r, shards, unchanged)),
        ", ".join(["doc_id bigint", *carried, "n_words bigint, n_removed bigint, kept_text string"]))
    return out.select("doc_id", *[F.col(f"own_{i}").alias(c) for i, c in enumerate(own)], "n_words", "n_removed", "kept_text")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM win JOIN low USING (k) WHERE m < doc_id),
kept AS (
  SELECT doc_id, count(*) FILTER (g.i IS NOT NULL) AS n_removed,
         string_agg(x.word, ' ' ORDER BY x.i) FILTER (g.i IS NULL) AS t
  FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w) x
  LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""
