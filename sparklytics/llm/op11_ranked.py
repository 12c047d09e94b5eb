"""Operator 11: ranked lexical search of many items over all documents by a dual-tree search.

1. One pass over the texts keeps, of each document, its number of terms and the counts of the terms that
   items have; the number of documents and terms and how many documents hold a term are summed from that.
2. Trees.  Documents of a task are ordered by their strongest term and put into trees of at most ``LEAVES``
   leaves of ``LEAF`` documents; a node holds, for each term, the largest value below it (coordinate maxima).
   Items are ordered likewise into a tree whose nodes hold each term's weight.
3. Traversal.  A pair of nodes has a bound, the sum of weight times largest value over the item node's terms:
   no item below scores higher with any document below.  A pair whose bound is less than the weakest of its
   items' k-th best scores so far is pruned with all below it, which is exact (a bound that equals it stays, because
   a smaller id wins a tie).  Others are replaced by their children, highest bound last, so that they are next.
4. Two traversals.  The first takes, for each item, only the most promising leaf of each tree; the k-th best
   of these real scores over all trees are lower bounds that the second, whole one starts with everywhere.  What it
   leaves is ranked by a window whose partial limit keeps k rows an item and task.

Items come to the driver in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` distinct terms (one item with
more is a block of its own) and all documents are searched for each block, so what tasks are sent is
bounded.  Terms are compared by 64-bit hashes.  Sums are exact: they are integers below 2**53.

Defined results: null and empty texts and texts without terms are no hits, and they count in no statistic; items without
terms, or whose terms no document has, give no rows; very long texts are counted whole; equal scores (ties)
rank by ascending ``doc_id``, null ids last; of repeated documents each is a hit of its own; repeated items are ranked each;
empty tables of documents or items give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import texthash as th
from .common import cut, documents

K = 10
LEAF, FAN, LEAVES = 32, 8, 256
CELLS = 4 << 20            # coordinate maxima of one tree's leaves; trees are smaller where there are more terms
BLOCK_ITEMS, BLOCK_TERMS = 4096, 32_768
CHUNK = 2 << 20

# A term's bytes are ASCII digits and letters and all of multi-byte characters.
_TERM = np.zeros(256, bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True


def terms(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term of a string column, A-Z lower-cased."""
    buf, off = th.flat(col)
    starts, ends, row = th.runs(_TERM[buf], off)
    return th.span_hash(th.LOWER[buf], starts, ends), row


def _vectors(batches, vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """doc_id, n (terms with repeats), and the positions in the vocabulary with their counts."""
    for b in th.chunks(batches, "text", CHUNK):
        h, row = terms(b.column("text"))
        n = np.bincount(row, minlength=b.num_rows)
        at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        known = vocabulary[at] == h
        key, tf = np.unique(row[known] << 32 | at[known], return_counts=True)
        cuts = np.searchsorted(key, np.arange(b.num_rows + 1) << 32)
        term, tf = (key & 0xFFFFFFFF).astype("<u4"), tf.astype("<u4")
        parts = [[x[a:z].tobytes() for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)] for x in (term, tf)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(parts[0], pa.binary()), pa.array(parts[1], pa.binary())],
                                         names=["doc_id", "n", "terms", "tfs"])


def _document_counts(batches, size: int) -> Iterator[pa.RecordBatch]:
    df = np.zeros(size, np.int64)
    for b in batches:
        for raw in b.column("terms").to_pylist():
            df[np.frombuffer(raw, "<u4")] += 1
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])


class Items:
    """A block of items as a tree.  Node: (first item, end, terms, largest weights); single items are the lowest level."""

    def __init__(self, vectors: list[np.ndarray], weight: np.ndarray):
        strongest = [(int(t[np.argmax(weight[t])]) if len(t) else -1) for t in vectors]
        self.order = sorted((i for i, t in enumerate(vectors) if len(t)), key=lambda i: (strongest[i], i))
        level = [(i, i + 1, vectors[o], weight[vectors[o]].astype(np.float64)) for i, o in enumerate(self.order)]
        self.levels = [level]
        while len(level) > 1:
            up = []
            for a in range(0, len(level), FAN):
                below = level[a:a + FAN]
                t, at = np.unique(np.concatenate([x[2] for x in below]), return_inverse=True)
                w = np.zeros(len(t))
                np.maximum.at(w, at, np.concatenate([x[3] for x in below]))
                up.append((below[0][0], below[-1][1], t, w))
            level = up
            self.levels.append(level)


class Documents:
    """A tree over documents given as rows of (term, value) in one array each."""

    def __init__(self, ids: list, start: np.ndarray, term: np.ndarray, value: np.ndarray, weight: np.ndarray):
        n = len(start) - 1
        doc = np.repeat(np.arange(n), np.diff(start))
        gain = value * weight[term]
        by_gain = np.lexsort((gain, doc))
        top = np.full(n, -1)
        top[doc[by_gain]] = term[by_gain]  # the last, strongest one of each document stays
        order = np.argsort(top, kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        entry = np.argsort(place[doc], kind="stable")
        self.ids = [ids[i] for i in order.tolist()]
        self.term, self.value = term[entry], value[entry].astype(np.float64)
        self.start = np.r_[0, np.cumsum(np.diff(start)[order])]
        leaves = -(-n // LEAF)
        largest = np.zeros((leaves, len(weight)), np.float64)
        np.maximum.at(largest, (place[doc][entry] // LEAF, self.term), self.value)
        self.levels = [largest]
        while len(largest) > 1:
            largest = np.maximum.reduceat(largest, np.arange(0, len(largest), FAN))
            self.levels.append(largest)

    def scores(self, leaf: int, weight: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents; ``weight`` is one item's, over all terms."""
        s = self.start[leaf * LEAF:min((leaf + 1) * LEAF, len(self.ids)) + 1]
        total = np.r_[0, np.cumsum(weight[self.term[s[0]:s[-1]]] * self.value[s[0]:s[-1]])]
        return total[s[1:] - s[0]] - total[s[:-1] - s[0]]


class Best:
    """The k best (score, id) of each item, and the least score that can still be among them."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k = least.astype(np.float64), k
        self.found: list[list] = [[] for _ in least]

    def add(self, item: int, score: np.ndarray, ids: list) -> None:
        hit = np.flatnonzero(score >= self.least[item])
        if len(hit):
            f = self.found[item]
            f += [(-int(score[i]), ids[i] is None, ids[i] if ids[i] is not None else 0) for i in hit.tolist()]
            f.sort()
            del f[self.k:]
            if len(f) == self.k:
                self.least[item] = max(self.least[item], -f[-1][0])


def _seed(docs: Documents, items: Items, weight: np.ndarray, best: Best) -> None:
    """Only the leaf of the highest bound, for each item."""
    own = np.zeros(len(weight))
    for i, _, t, w in items.levels[0]:
        leaf = int(np.argmax(docs.levels[0][:, t] @ w))
        own[t] = w
        first = leaf * LEAF
        best.add(i, docs.scores(leaf, own), docs.ids[first:first + LEAF])
        own[t] = 0


def _traverse(docs: Documents, items: Items, weight: np.ndarray, best: Best) -> None:
    own = np.zeros(len(weight))
    waiting = [(len(items.levels) - 1, 0, len(docs.levels) - 1, 0, math.inf)]
    while waiting:
        li, i, ld, d, bound = waiting.pop()
        a, z, t, w = items.levels[li][i]
        if bound < best.least[a:z].min():
            continue
        if li == 0 and ld == 0:
            own[t] = w
            best.add(i, docs.scores(d, own), docs.ids[d * LEAF:(d + 1) * LEAF])
            own[t] = 0
            continue
        lower_i = range(i * FAN, min((i + 1) * FAN, len(items.levels[li - 1]))) if li else (i,)
        lower_d = slice(d * FAN, min((d + 1) * FAN, len(docs.levels[ld - 1]))) if ld else slice(d, d + 1)
        li, ld = max(li - 1, 0), max(ld - 1, 0)
        pairs = []
        for c in lower_i:
            a, z, t, w = items.levels[li][c]
            bounds = docs.levels[ld][lower_d][:, t] @ w
            for x in np.flatnonzero(bounds >= best.least[a:z].min()).tolist():
                pairs.append((li, c, ld, lower_d.start + x, float(bounds[x])))
        pairs.sort(key=lambda p: p[4])
        waiting += pairs


def _search(batches, items: Items, weight: np.ndarray, n_docs: int, n_terms: int, least: np.ndarray, k: int, seed: bool):
    """(item, doc_id, score) of what each tree leaves."""
    size = LEAF * max(1, min(LEAVES, CELLS // max(1, len(weight))))
    ids, n, term, tf = [], [], [], []

    def flush() -> pa.RecordBatch:
        count = np.array([len(x) for x in term], np.int64)
        start = np.r_[0, np.cumsum(count)]
        all_terms, all_tf = np.concatenate(term).astype(np.int64), np.concatenate(tf).astype(np.int64)
        m = np.array([100 - 90 + 90 * x * n_docs // n_terms for x in n], np.int64)  # Python's integers don't overflow
        value = 1_000_000_000 * all_tf // (1000 * all_tf + 8 * np.repeat(m, count))
        best = Best(least, k)
        (_seed if seed else _traverse)(Documents(ids, start, all_terms, value, weight), items, weight, best)
        rows = [(items.order[i], None if none else x, -s) for i, f in enumerate(best.found) for s, none, x in f]
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["item", "doc_id", "score"])
    for b in batches:
        for i, x, raw, counts in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tfs")), strict=True):
            if not raw:
                continue  # none of the block's terms: its score is 0
            ids.append(i)
            n.append(x)
            term.append(np.frombuffer(raw, "<u4"))
            tf.append(np.frombuffer(counts, "<u4"))
            if len(ids) == size:
                yield flush()
                for x in (ids, n, term, tf):
                    x.clear()
    if ids:
        yield flush()


def _blocks(items: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Item ids and each item's distinct term hashes, a bounded block at a time."""
    ids, vectors, held = [], [], set()
    for r in items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        own = np.unique(terms(pa.array([r["text"]], pa.string()))[0])
        if ids and (len(ids) >= BLOCK_ITEMS or len(held) + sum(t not in held for t in own.tolist()) > BLOCK_TERMS):
            yield ids, vectors
            ids, vectors, held = [], [], set()
        ids.append(r["item_id"])
        vectors.append(own)
        held.update(own.tolist())
    if ids:
        yield ids, vectors


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(docs: DataFrame, ids: list, hashes: list[np.ndarray], k: int) -> DataFrame | None:
    """One block: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate(hashes))
    if not len(vocabulary):
        return None
    vectors = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(lambda it: _vectors(it, vocabulary), "doc_id bigint, n bigint, terms binary, tfs binary"), "term-vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = len(vocabulary)
    counted = (vectors.select("terms").mapInArrow(lambda it: _document_counts(it, size), "term bigint, df bigint")
               .groupBy("term").agg(F.sum("df").alias("df")).collect())  # at most the block's terms
    df = np.zeros(size, np.int64)
    for r in counted:
        df[r["term"]] = r["df"]
    if not df.any():
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    tree = Items([t[df[t] > 0] for t in (np.searchsorted(vocabulary, h) for h in hashes)], weight)
    count = len(tree.order)
    least = np.ones(count)
    schema = "item bigint, doc_id bigint, score bigint"
    wanted = vectors.filter(F.length("terms") > 0)
    seeds = _top(wanted.mapInArrow(lambda it: _search(it, tree, weight, n_docs, n_terms, np.ones(count), k, True), schema), k)
    place = {o: i for i, o in enumerate(tree.order)}
    for r in seeds.filter(F.col("rank") == k).select("item", "score").collect():  # at most a row an item of the block
        least[place[r["item"]]] = r["score"]
    hits = wanted.mapInArrow(lambda it: _search(it, tree, weight, n_docs, n_terms, least, k, False), schema)
    names = spark.createDataFrame(list(enumerate(ids)), "item bigint, item_id bigint")
    return _top(hits, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a block of items


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    found = [x for x in (_searched(docs, ids, hashes, k) for ids, hashes in _blocks(items)) if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM words WHERE len(ws) > 0),
tf AS (SELECT r, doc_id, n, w, count(*) AS tf FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS w FROM words) GROUP BY ALL),
df AS (SELECT w, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, total GROUP BY w),
item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item JOIN df USING (w) JOIN tf USING (w), total GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
