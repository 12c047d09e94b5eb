"""Operator 13: SimHash near-duplicates by a self-join of binary tries.

The fingerprint of a document has a bit set where more than half of the 64-bit hashes of its word
shingles (repeats included) have it.  Documents whose fingerprints differ in at most ``BUDGET`` bits are
linked; the result is each document's component.

1. Fingerprints are reduced to distinct ones; copies never meet each other.
2. Tries.  The 64 bits are cut into blocks, ``BUDGET`` more than ``exact``; two linked fingerprints
   agree in at least ``exact`` of them.  There is one trie for each choice of ``exact`` blocks, with these at
   its root: a pair starts below a root path that both share, with no differing bits so far.
   ``exact`` follows the number of fingerprints so that the unrelated ones below a root path stay few.
3. A root path with more than ``UNIT`` fingerprints is split as node pairs, 8 levels a round, by
   DataFrame joins over its nodes (at most 256 a side): pairs of nodes whose prefixes differ in more
   bits than the budget are pruned, and rows go only to pairs that remain.
4. Node pairs that are small enough are traversed inside tasks, all of a chunk at once: a pair adds the
   bits in which the common prefixes differ, is pruned beyond the budget, and else the node with the
   shorter prefix is replaced by its two children.  Pairs of least difference go first, and a pair
   of nodes that are connected already is skipped, so a group of near copies costs few comparisons.
5. A task gives each fingerprint its smallest connected one; ``components`` merges these links.

Defined results: null and empty texts and texts of white space only have fingerprint zero, which is linked
like any other; a text of fewer words than a shingle is one shingle; a bit set in exactly half of the
hashes is 0; very long texts are hashed whole, in blocks of ``HASHES`` shingles; equal fingerprints (ties) are one
component whatever their texts; a null ``doc_id`` is larger than any other (a component of only such rows
has a null id); repeated rows each get their row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import cut, documents, parts, with_group_first
from .components import components

SHINGLE, BUDGET, SEED = 4, 4, 42
BITS = 64
HASHES = 1 << 16      # shingles hashed at once
UNIT = 1 << 16        # fingerprints of a node pair that one task takes
STEP = 8              # trie levels by which a larger one is split
PER_ROOT = 64         # unrelated fingerprints expected below a root path
PAIRS = 1 << 20       # node pairs, or compared fingerprints, held at once
LEAF = 256            # a node pair of so many comparisons is compared at once
SALTS = 64
LAST = (1 << 63) - 1
U64 = np.uint64
MASK = (1 << BITS) - 1
ROOT = ["trie", "p", "q", "depth"]


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of UTF-8 text as an unsigned number.  ``bytes`` lower-cases and splits by ASCII alone."""
    joined = b" ".join((text or b"").lower().split())
    if not joined:
        return 0
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    n = max(1, len(space) + 2 - shingle)
    starts, ends = np.r_[0, space + 1][:n], np.r_[space, len(joined)][-n:]
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, HASHES):
        spans = zip(starts[a:a + HASHES].tolist(), ends[a:a + HASHES].tolist(), strict=True)
        h = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans), U64, min(HASHES, n - a))
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches, shingle: int):
    at = 0
    for b in th.chunks(batches, "text", 1 << 20):
        fp = np.array([simhash(t, shingle) for t in b.column("text").to_pylist()], U64).view(np.int64)
        salt = (at + np.arange(len(fp))) % SALTS  # differs between equal rows; kept because the rows are written
        at += len(fp)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp), pa.array(salt.astype(np.int32))], names=["doc_id", "fp", "salt"])


def tries(n: int, budget: int) -> list[int]:
    """The bits, as masks, that each trie has at its root."""
    exact = next(e for e in itertools.count(1) if n >> (BITS * e // (e + budget)) < PER_ROOT or e >= budget)
    edge = [BITS * i // (exact + budget) for i in range(exact + budget + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edge)]
    return [sum(c) for c in itertools.combinations(block, exact)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _top(depth: int) -> int:
    return ((1 << depth) - 1) << (BITS - depth)


def split(units: DataFrame, masks: list[int], budget: int, unit: int = UNIT) -> DataFrame:
    """``units`` (root columns, fp) with every node pair of more than ``unit`` rows replaced by pairs of nodes
    ``STEP`` levels lower, as long as there are any.  A pair of single fingerprints is never larger."""
    done = None
    for depth in range(STEP, BITS + 1, STEP):
        sizes = cut(units.groupBy(*ROOT).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > unit), "large-units")
        if sizes.isEmpty():
            break
        mask = F.element_at(F.array(*[F.lit(_signed(m | _top(depth))) for m in masks]), F.col("trie") + 1)
        before = F.element_at(F.array(*[F.lit(_signed(m | _top(depth - STEP))) for m in masks]), F.col("trie") + 1)
        hot = (units.join(sizes.select(*ROOT), ROOT).withColumn("node", F.col("fp").bitwiseAND(mask))
               .withColumn("up", F.col("fp").bitwiseAND(before)))
        nodes = hot.select(*ROOT, "node", "up").distinct()  # at most 256 below each side
        x = nodes.select(*ROOT, F.col("node").alias("x"), F.col("up").alias("ux"))
        y = nodes.select(*ROOT, F.col("node").alias("y"), F.col("up").alias("uy"))
        near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= budget
        across = (F.col("ux") == F.col("p")) & (F.col("uy") == F.col("q")) & ((F.col("p") != F.col("q")) | (F.col("x") <= F.col("y")))
        pairs = x.join(y, ROOT).filter(near & across).select(*ROOT, "x", "y")
        goes = (pairs.withColumn("node", F.explode(F.array_distinct(F.array("x", "y"))))
                .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
        lower = (hot.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
                 .join(goes, [*ROOT, "node", "salt"])
                 .select("trie", F.col("x").alias("p"), F.col("y").alias("q"), F.lit(depth).alias("depth"), "fp"))
        small = units.join(sizes.select(*ROOT), ROOT, "left_anti")
        done = small if done is None else done.unionByName(small)
        units = cut(lower, "units")
    return units if done is None else done.unionByName(units)


def _prefix(x: np.ndarray) -> np.ndarray:
    """Leading zero bits of each number."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x | (x >> U64(s))
    return BITS - np.bitwise_count(x).astype(np.int64)


class Forest:
    """Union-find over array positions, whole arrays at a time; the root of a set is its smallest position."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            root = self.roots()
            a, b = root[i], root[j]
            apart = a != b
            i, j = i[apart], j[apart]
            np.minimum.at(self.up, np.maximum(a, b)[apart], np.minimum(a, b)[apart])


def trie_join(fp: np.ndarray, pairs: np.ndarray, budget: int) -> np.ndarray:
    """The smallest connected position of each position.  ``pairs`` has rows (lo, hi, lo, hi): ranges of ``fp``
    that are sorted, equal or apart, and to be joined with each other."""
    forest = Forest(len(fp))
    waiting: list[list[np.ndarray]] = [[] for _ in range(budget + 1)]

    def put(new: np.ndarray) -> None:
        """Adds the bits in which the common prefixes differ, prunes, files the rest."""
        a, b = fp[new[:, 0]], fp[new[:, 2]]
        depth = np.minimum(_prefix(a ^ fp[new[:, 1] - 1]), _prefix(b ^ fp[new[:, 3] - 1]))
        low = np.where(depth < BITS, U64(0xFFFFFFFFFFFFFFFF) >> np.minimum(depth, BITS - 1).astype(U64), U64(0))
        differ = np.bitwise_count((a ^ b) & ~low).astype(np.int64)
        for d in range(budget + 1):
            at = new[differ == d]
            if len(at):
                waiting[d].append(at)
    put(pairs)
    while any(waiting):
        least = next(w for w in waiting if w)
        now = least.pop()
        if len(now) > PAIRS:
            least.append(now[PAIRS:])
            now = now[:PAIRS]
        root = forest.roots()
        change = np.r_[0, np.cumsum(root[1:] != root[:-1])]
        one = (change[now[:, 0]] == change[now[:, 1] - 1]) & (change[now[:, 2]] == change[now[:, 3] - 1]) \
            & (root[now[:, 0]] == root[now[:, 2]])
        now = now[~one]
        n, m = now[:, 1] - now[:, 0], now[:, 3] - now[:, 2]
        leaf = n * m <= LEAF
        small = now[leaf]
        step = PAIRS // LEAF
        for k in range(0, len(small), step):
            s = small[k:k + step]
            a, b = s[:, 1] - s[:, 0], s[:, 3] - s[:, 2]
            each = a * b
            row = np.repeat(np.arange(len(s)), each)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            i, j = s[row, 0] + nth // b[row], s[row, 2] + nth % b[row]
            hit = np.bitwise_count(fp[i] ^ fp[j]) <= budget
            forest.join(i[hit], j[hit])
        now = now[~leaf]
        if not len(now):
            continue
        own = (now[:, 0] == now[:, 2]) & (now[:, 1] == now[:, 3])
        first = _prefix(fp[now[:, 0]] ^ fp[now[:, 1] - 1]) <= _prefix(fp[now[:, 2]] ^ fp[now[:, 3] - 1])
        lo, hi = np.where(first, now[:, 0], now[:, 2]), np.where(first, now[:, 1], now[:, 3])
        bit = U64(BITS - 1) - _prefix(fp[lo] ^ fp[hi - 1]).astype(U64)  # where the node's children part
        key = (fp[hi - 1] >> bit) << bit
        a, z = lo.copy(), hi.copy()
        while (open_ := a < z).any():
            mid = (a + z) // 2
            right = open_ & (fp[np.minimum(mid, len(fp) - 1)] < key)
            a, z = np.where(right, mid + 1, a), np.where(open_ & ~right, mid, z)
        other = np.where(first[:, None], now[:, 2:], now[:, :2])
        left, right = np.stack([lo, a], 1), np.stack([a, hi], 1)
        cross = np.where(own[:, None], right, left)  # of a node with itself: left-left, right-right, left-right
        put(np.concatenate([np.concatenate([left, np.where(own[:, None], left, other)], 1),
                            np.concatenate([right, np.where(own[:, None], right, other)], 1),
                            np.concatenate([left, cross], 1)[own]]))
    return forest.roots()


def _joined(t: pa.Table, budget: int) -> pa.RecordBatch:
    """Links (u, v) of whole units; rows are sorted by unit and fingerprint."""
    c = {k: t[k].to_numpy() for k in ROOT}
    fp = t["fp"].to_numpy().view(U64)
    order = np.lexsort((fp, *(c[k] for k in reversed(ROOT))))  # unsigned, unlike Spark's order
    fp, c = fp[order], {k: v[order] for k, v in c.items()}
    new = np.ones(len(fp), bool)
    new[1:] = np.any([v[1:] != v[:-1] for v in c.values()], axis=0)
    lo = np.flatnonzero(new)
    hi = np.r_[lo[1:], len(fp)]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    # two nodes are joined with each other: the pair's ranges part where the second node starts
    p, q = c["p"][lo], c["q"][lo]
    two = p != q
    pairs = np.stack([lo, hi, lo, hi], 1)
    if two.any():
        cut_at = np.array([_second(fp[a:b], int(x) & MASK, int(y) & MASK) for a, b, x, y in
                           zip(lo[two].tolist(), hi[two].tolist(), p[two].tolist(), q[two].tolist(), strict=True)]) + lo[two]
        pairs[two, 1], pairs[two, 2] = cut_at, cut_at
        pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2])]
    root = trie_join(fp, pairs, budget) if len(pairs) else np.arange(len(fp))
    linked = root != np.arange(len(fp))
    return pa.RecordBatch.from_arrays([pa.array(fp[linked].view(np.int64)), pa.array(fp[root[linked]].view(np.int64))], names=["u", "v"])



def _second(fp: np.ndarray, p: int, q: int) -> int:
    """Where the rows of the node with the larger prefix start: the nodes part at their first differing bit."""
    bit = (p ^ q).bit_length() - 1
    return int(np.searchsorted(fp >> U64(bit) & U64(1), 1))


def _units(batches, budget: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by unit; whole units are joined, ``UNIT`` rows or more at a time."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows <= 2 * UNIT:
            continue
        last = np.ones(held.num_rows, bool)
        for k in ROOT:
            v = held[k].to_numpy()
            last &= v == v[-1]
        at = held.num_rows - int(last.sum())
        if at:
            yield _joined(held.slice(0, at).combine_chunks(), budget)
            held = held.slice(at).combine_chunks()
    if held is not None and held.num_rows:
        yield _joined(held.combine_chunks(), budget)


def links(fps: DataFrame, n: int, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """(u, v): links that connect the same fingerprints (column ``fp``, distinct, ``n`` of them) as all
    pairs within the budget do."""
    masks = tries(n, budget)
    roots = F.array(*[F.struct(F.lit(i).alias("trie"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("p")) for i, m in enumerate(masks)])
    units = (fps.select("fp", F.explode(roots).alias("r"))
             .select("r.trie", "r.p", F.col("r.p").alias("q"), F.lit(0).alias("depth"), "fp"))
    units = split(units, masks, budget, unit)
    return (units.repartition(parts(fps.sparkSession), *ROOT).sortWithinPartitions(*ROOT)
            .mapInArrow(lambda it: _units(it, budget), "u bigint, v bigint"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """doc_id, fp (signed), component_id; one row per row of ``docs``."""
    own = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
              .mapInArrow(lambda it: _fingerprints(it, shingle), "doc_id bigint, fp bigint, salt int"), "simhash")
    seen = own.groupBy("fp", "salt").agg(F.min("doc_id").alias("first"))
    fps = cut(seen.groupBy("fp").agg(F.coalesce(F.min("first"), F.lit(LAST)).alias("first"), F.collect_list("salt").alias("salts")),
              "distinct-simhash")
    labels = components(links(fps.select("fp"), fps.count(), budget, unit))
    rooted = fps.join(labels, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    least = with_group_first(rooted.select("root", F.col("first").alias("id"), "fp"), ["root"], ["id", "fp"], singles=True)
    spread = (least.select("fp", F.col("first.id").alias("component")).join(fps.select("fp", "salts"), "fp")
              .select("fp", "component", F.explode("salts").alias("salt")))
    return (own.join(spread, ["fp", "salt"])
            .select("doc_id", "fp", F.when(F.col("component") < LAST, F.col("component")).alias("component_id")))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
