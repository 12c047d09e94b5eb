"""Operator 1: language-model scoring by prediction by partial matching (PPM).

The model is a byte-context trie of order ``ORDER``.  A text is its words (split at ASCII white
space, A-Z lower-cased), one space between them, closed by an end symbol; so its probability is that
of its token sequence.  A symbol is predicted in the longest context that training has seen; a
symbol new to that context escapes to the next shorter one with probability d / 2n (n symbols seen
there, d of them distinct; each distinct symbol gives half a count to the escape), and there the
symbols of the longer context are excluded from n, d and the counts.  The last resort is uniform over the symbols never seen.  A text's score is the sum of
log10 probabilities under counts of the whole training set ("pretrained").

The trie grows with the corpus and is never held in one place.  Batches of documents send their
distinct (context, symbol) pairs with training counts to the shard of the two latest context bytes.
Counts are summed per shard and group of ``GROUP`` batches, then per shard, which so holds the whole subtree
of orders 2 to ``ORDER`` once and computes its probabilities.  A group of batches gets back only the pairs
that it asked for, so what is sent grows with the requests, and a common context, which every batch asks about,
costs a task one group of batches at a time.  Orders 0 and 1 are one 256 x 256 table, counted
first.  Word counts of the base score travel the same way.  There are as many shards as batches.

Defined results: null text is the empty text, which is its end token; a null ``doc_id`` is held out;
repeated rows are scored (and learned) one by one; without training rows every symbol has probability
1/256 and every token 1; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents
from .exchange import dealt, pack, pack_sorted, runs_by_shard, shard_of, table, unpack, unpack_sorted

ORDER = 5  # context bytes; with the symbol, a pair is 48 bits
END = 10   # newline: never inside a normalised text
FOLDS, HELD_OUT = 7, 2
WIDTH = ORDER + 1
GROUP = 32      # batches whose requests one task of a shard answers


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True))


def symbols(col: pa.Array):
    """(symbols of all rows, offsets, word hashes, their rows)."""
    buf, off = th.flat(col)
    buf = th.LOWER[buf]
    s, e, row = th.words(buf, off)
    n = len(col)
    words = np.bincount(row, minlength=n)
    # one space after each word but a row's last, and the end symbol after that one
    size = e - s + 1
    last = np.cumsum(words)[words > 0] - 1
    total = np.bincount(row, size, n).astype(np.int64)
    total[words == 0] = 1
    at = np.r_[0, np.cumsum(total)]
    out = np.full(int(at[-1]), END, np.uint8)
    to = at[row] + (np.cumsum(size) - size) - (np.cumsum(size) - size)[np.searchsorted(row, row, "left")]
    length = e - s
    start = np.cumsum(length) - length
    out[np.repeat(to - start, length) + np.arange(int(length.sum()))] = \
        buf[np.repeat(s - start, length) + np.arange(int(length.sum()))]
    space = np.ones(len(s), bool)
    space[last] = False
    out[(to + length)[space]] = 32
    return out, at, th.span_hash(buf, s, e), row


def pairs(sym: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each position's context and symbol as one number, the latest context byte highest.  Contexts
    before a text's start are end symbols."""
    n = len(sym)
    place = np.arange(n) - np.repeat(at[:-1], np.diff(at))
    key = sym.astype(np.uint64)
    for j in range(1, ORDER + 1):
        b = np.full(n, END, np.uint64)
        b[j:] = sym[:max(0, n - j)]
        b[place < j] = END
        key |= b << th.U64(8 * (ORDER + 1 - j))
    return key


def _count_pairs(batches):
    total = np.zeros(65536, np.int64)
    docs = 0
    for b in th.chunks(batches, "text"):
        sym, at, _, _ = symbols(b.column("text"))
        k = pairs(sym, at)
        total += np.bincount(((k >> th.U64(8 * ORDER)) << th.U64(8) | (k & th.U64(255))).astype(np.int64), minlength=65536)
        docs += b.num_rows
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[seen, -1]), pa.array(np.r_[total[seen], docs])], names=["pair", "n"])


def log10_probabilities(key: np.ndarray, count: np.ndarray, low: np.ndarray) -> np.ndarray:
    """log10 P(symbol | context) of sorted distinct pairs with their training counts.  The pairs of
    a context that was seen in training are all there; ``low`` has the counts of order 1."""
    n = len(key)
    sym = (key & th.U64(255)).astype(np.int64)
    log = np.zeros(n)
    done = np.zeros(n, bool)
    child = None  # of the longer context: (context of each pair, its pairs' grams and counts, contexts, distinct)
    for k in range(ORDER, -1, -1):
        if k >= 2:
            gram = (key >> th.U64(8 * (WIDTH - k))) << th.U64(8) | (key & th.U64(255))
            grams, which = (key, np.arange(n)) if k == ORDER else np.unique(gram, return_inverse=True)
            c = np.bincount(which, count, len(grams))
            ctx, ctx_of = np.unique(grams >> th.U64(8), return_inverse=True)
            total = np.bincount(ctx_of, c, len(ctx))
            distinct = np.bincount(ctx_of, c > 0, len(ctx))
            own, place = c[which], ctx_of[which]

            def seen(g, grams=grams, c=c):
                return c[np.searchsorted(grams, g)]
        else:
            t = low if k == 1 else low.sum(0)[None, :]
            place = (key >> th.U64(8 * ORDER)).astype(np.int64) if k == 1 else np.zeros(n, np.int64)
            total, distinct = t.sum(1).astype(float), (t > 0).sum(1).astype(float)
            own = t[place, sym].astype(float)
            grams = np.arange(65536, dtype=np.uint64) if k == 1 else None
            c = low.ravel().astype(float)
            ctx_of = np.repeat(np.arange(256), 256)

            def seen(g, t=t, k=k):
                g = g.astype(np.int64)
                return t[(g >> 8) & 255 if k == 1 else 0, g & 255].astype(float)
        rest, kinds = total[place], distinct[place]
        if child is not None:
            child_place, child_grams, child_c, child_ctx_of, child_total, child_distinct = child
            # the parent's gram of a child's gram: drop the oldest context byte
            parent = (child_grams >> th.U64(16)) << th.U64(8) | (child_grams & th.U64(255)) if k else child_grams & th.U64(255)
            excluded = np.bincount(child_ctx_of, np.where(child_c > 0, seen(parent), 0), len(child_total))
            rest, kinds = rest - excluded[child_place], kinds - child_distinct[child_place]
        hit = ~done & (own > 0)
        log[hit] += np.log10((own[hit] - 0.5) / rest[hit])
        done |= hit
        miss = ~done & (rest > 0)
        log[miss] += np.log10(kinds[miss] / 2 / rest[miss])
        child = place, grams, c, ctx_of, total, distinct
    log[~done] -= np.log10(256 - float((low.sum(0) > 0).sum()))
    return log


def _ask(t: pa.Table, shards: int) -> pa.Table:
    sym, at, words, row = symbols(t["text"])
    train = ~t["held_out"].to_numpy()
    k = pairs(sym, at)
    mine = np.repeat(train, np.diff(at))
    out = {c: [] for c in ("batch", "shard", "grp", "pairs", "pair_n", "words", "word_n")}
    keys, n = _with_counts(k, mine)
    of_pair = runs_by_shard(_pair_shard(keys, shards))
    w, wn = _with_counts(words, train[row])
    of_word = runs_by_shard(shard_of(w, shards))
    batch = t["batch"][0].as_py()
    none = np.zeros(0, np.int64)
    for s in sorted(of_pair.keys() | of_word.keys()):  # nothing is sent to shards that none of the keys belong to
        i, j = of_pair.get(s, none), of_word.get(s, none)
        for c, v in zip(out, (batch, s, batch // GROUP, pack_sorted(keys[i], WIDTH), pack(n[i], 5), pack_sorted(w[j], 8), pack(wn[j], 5)),
                        strict=True):
            out[c].append(v)
    return table({c: (v, pa.int64() if c in ("batch", "shard", "grp") else pa.binary()) for c, v in out.items()})


def _with_counts(keys: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and how often each occurs among ``mine``."""
    known, n = np.unique(keys[mine], return_counts=True)
    every = np.union1d(known, keys[~mine]) if not mine.all() else known
    count = np.zeros(len(every), np.int64)
    count[np.searchsorted(every, known)] = n
    return every, count


def _pair_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return shard_of(keys >> th.U64(8 * (WIDTH - 2)), shards)


def _total(t: pa.Table, keys: str, counts: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all rows with their summed counts."""
    every = np.concatenate([unpack_sorted(x, width) for x in t[keys].to_pylist()])
    n = np.concatenate([unpack(x, 5) for x in t[counts].to_pylist()])
    found, which = np.unique(every, return_inverse=True)
    return found, np.bincount(which, n, len(found)).astype(np.int64)


def _sum(t: pa.Table) -> pa.Table:
    """Counts of a shard over one group of batches."""
    k, n = _total(t, "pairs", "pair_n", WIDTH)
    w, wn = _total(t, "words", "word_n", 8)
    return table({"shard": ([t["shard"][0].as_py()], pa.int64()), "grp": ([t["grp"][0].as_py()], pa.int64()),
                  "pairs": ([pack_sorted(k, WIDTH)], pa.binary()), "pair_n": ([pack(n, 5)], pa.binary()),
                  "words": ([pack_sorted(w, 8)], pa.binary()), "word_n": ([pack(wn, 5)], pa.binary())})


def _solve(t: pa.Table, low: np.ndarray) -> pa.Table:
    """A shard's finished subtree, cut to what each group of batches asked for: its pairs with log10
    probabilities, its words with counts."""
    k, n = _total(t, "pairs", "pair_n", WIDTH)
    w, wn = _total(t, "words", "word_n", 8)
    log = log10_probabilities(k, n, low).astype("<f4")
    logs = [log[np.searchsorted(k, unpack_sorted(x, WIDTH))].tobytes() for x in t["pairs"].to_pylist()]
    counts = [pack(wn[np.searchsorted(w, unpack_sorted(x, 8))], 5) for x in t["words"].to_pylist()]
    return pa.table({"shard": t["shard"], "grp": t["grp"], "pairs": t["pairs"], "logs": pa.array(logs, pa.binary()), "words": t["words"],
                     "counts": pa.array(counts, pa.binary())})


def _word_totals(t: pa.Table) -> pa.Table:
    """Distinct training words of a shard, and how often they occur."""
    _, n = _total(t, "words", "word_n", 8)
    return table({"distinct": ([int((n > 0).sum())], pa.int64()), "tokens": ([int(n.sum())], pa.int64())})


def _answer(t: pa.Table, solved: pa.Table) -> pa.Table:
    tree = {c: solved[c][0].as_py() for c in ("pairs", "logs", "words", "counts")}
    keys, log = unpack_sorted(tree["pairs"], WIDTH), np.frombuffer(tree["logs"], "<f4")
    words, count = unpack_sorted(tree["words"], 8), unpack(tree["counts"], 5)
    logs = [log[np.searchsorted(keys, unpack_sorted(x, WIDTH))].tobytes() for x in t["pairs"].to_pylist()]
    counts = [pack(count[np.searchsorted(words, unpack_sorted(x, 8))], 5) for x in t["words"].to_pylist()]
    return pa.table({"batch": t["batch"], "shard": t["shard"], "logs": pa.array(logs, pa.binary()), "counts": pa.array(counts, pa.binary())})


SCHEMA = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double, n_symbols bigint")
EMPTY = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_symbols", pa.int64())]


def _score(t: pa.Table, replies: pa.Table, shards: int, train_docs: int) -> pa.Table:
    if not t.num_rows:
        return pa.schema(EMPTY).empty_table()
    sym, at, words, row = symbols(t["text"])
    n = t.num_rows
    by = dict(zip(replies["shard"].to_pylist(), range(replies.num_rows), strict=True))
    k = pairs(sym, at)
    keys, which = np.unique(k, return_inverse=True)
    log = np.empty(len(keys))
    w, wwhich = np.unique(words, return_inverse=True)
    count = np.zeros(len(w), np.int64)
    logs, counts = replies["logs"], replies["counts"]
    for s, i in runs_by_shard(_pair_shard(keys, shards)).items():
        log[i] = np.frombuffer(logs[by[s]].as_py(), "<f4")
    for s, i in runs_by_shard(shard_of(w, shards)).items():
        count[i] = unpack(counts[by[s]].as_py(), 5)
    score = np.bincount(np.repeat(np.arange(n), np.diff(at)), log[which], n)
    tokens = replies["tokens"][0].as_py() + train_docs
    distinct = replies["distinct"][0].as_py() + (train_docs > 0)
    c = count[wwhich]
    n_tokens = np.bincount(row, minlength=n) + 1
    known = np.bincount(row, c > 0, n).astype(np.int64) + (train_docs > 0)
    base = (np.bincount(row, np.log10(c + 1.0), n) + np.log10(train_docs + 1.0)
            - n_tokens * np.log10(float(tokens + distinct + 1)))
    return pa.table({"doc_id": t["doc_id"], "held_out": t["held_out"], "n_tokens": n_tokens, "n_known": known,
                     "train_tokens": np.full(n, tokens), "base_score": base, "score": score, "n_symbols": np.diff(at)})


def ppm_scores(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """Scores all rows of ``docs`` (doc_id, text) with the model learned from those not held out."""
    held = held_out(F.col("doc_id")) if held is None else held
    rows, batches = dealt(docs, held.alias("held_out"))
    shards = batches
    low = np.zeros(65536, np.int64)
    train_docs = 0
    counted = (rows.filter(~F.col("held_out")).select("text").mapInArrow(_count_pairs, "pair bigint, n bigint")
               .groupBy("pair").agg(F.sum("n").alias("n")).collect())  # at most 65,537 rows
    for r in counted:
        if r["pair"] < 0:
            train_docs = r["n"]
        else:
            low[r["pair"]] = r["n"]
    low = low.reshape(256, 256)
    blobs = "pairs binary, pair_n binary, words binary, word_n binary"
    asked = rows.groupBy("batch").applyInArrow(lambda t: _ask(t, shards), f"batch bigint, shard bigint, grp bigint, {blobs}")
    summed = asked.groupBy("shard", "grp").applyInArrow(_sum, f"shard bigint, grp bigint, {blobs}")
    solved = summed.groupBy("shard").applyInArrow(
        lambda t: _solve(t, low), "shard bigint, grp bigint, pairs binary, logs binary, words binary, counts binary")
    totals = (summed.groupBy("shard").applyInArrow(_word_totals, "distinct bigint, tokens bigint")
              .agg(F.sum("distinct").alias("distinct"), F.sum("tokens").alias("tokens")).withColumn("one", F.lit(1)))  # one row
    replies = (asked.groupBy("shard", "grp").cogroup(solved.groupBy("shard", "grp"))
               .applyInArrow(_answer, "batch bigint, shard bigint, logs binary, counts binary")
               .withColumn("one", F.lit(1)).join(F.broadcast(totals), "one").drop("one"))
    return rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        lambda t, r: _score(t, r, shards, train_docs), SCHEMA)


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(documents(spark, sf_dir))
