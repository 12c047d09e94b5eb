"""Operator 10: exact Jaccard join of documents as a metric-space join.

Documents are sets of distinct word shingles, the distance of two is 1 - Jaccard similarity (a metric),
and two are linked when it is at most r = 1 - threshold.  The result is each document's component.

1. Equal sets are one class (a digest of the set decides); one document stands for it.
2. Pivots of the whole space.  With one global order of shingles (frequent ones last), two linked
   documents share a shingle among their first n - ceil(t n) + 1.  For each such shingle, the
   smallest document that has it there is a pivot, and the documents around it are the pivot's region.
   Linked sizes differ by at most the threshold, so a shingle's documents are cut into windows of
   size, and documents on a window's upper edge are replicated into the window before it.  Every linked
   pair meets in a region; documents that share no such shingle with any other drop out here.
3. Regions are thinned out by a cheaper distance that never exceeds the number of shingles in which
   two sets differ: the L1 distance of their histograms over hash buckets, an eightieth of a set's
   size.  Members within the bound that linked sets must keep form candidate components over
   all regions; a document alone in its component drops out.  Only now are texts moved, once to their
   components and once to their groups, where sets are made of them.
4. Inside a candidate component, cells.  Pivots are taken until each member is within r of one, and each
   member belongs to its nearest pivot (its Voronoi cell).  Members of a cell are connected through it.
   Links between cells can only run between pivots at most 3r apart, and there only between members
   within 2r of the other cell's pivot: these boundary windows are compared exactly.  A member that a
   pivot finds within r is linked directly.
5. Components are merged by stars (``components``), in rounds that grow with the logarithm of a chain's length.

Regions and candidate components above ``REGION`` members are split by hash into blocks, and each pair of
blocks is joined by itself: exact, and in bounded memory, at a cost that grows with the square of
the number of documents that are all nearly alike and not equal.

Frequent shingles only affect the order, not the result: at most ``FREQUENT`` of them are held, those
that most documents have.  Their counts leave out chunks of 4 MB of text in which fewer than
``FREQUENT_IN_CHUNK`` documents have the shingle: one that is that thin in every chunk is never known as
frequent, however many documents have it in all, and its region can be large (cost only).

Defined results: a text of fewer words than a shingle is one shingle; null and empty texts have
no set and are linked with nothing; a null ``doc_id`` is larger than any other (a component of only
such rows has a null id); rows equal in id and text are one document; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from ..streaming.jobs import remove
from .common import cut, documents, parts, release, scratch, text_or_empty, with_group_first, written
from .components import components as connected

SHINGLE, THRESHOLD = 3, (90, 100)
FREQUENT, FREQUENT_IN_CHUNK = 65_536, 3
COUNTED_AT_ONCE = 4 << 20  # bytes of text
REGION = 2048
BUCKETS = (32, 4096)  # least and most buckets of a histogram; about a 16th of the set's size
LAST = (1 << 63) - 1
NODE = ["rid", "tid"]  # a row; inside, rows have a number of their own, smaller in a shuffle


def sets(col: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf, off = th.flat(col)
    buf = th.LOWER[buf]
    s, e, row = th.words(buf, off)
    g, r = th.grams(th.span_hash(buf, s, e), row, shingle)
    at = th.bounds(r, len(col))
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        v = np.sort(g[a:b])
        out.append(v[np.r_[True, v[1:] != v[:-1]]] if len(v) else v)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """(rid, tid, doc_id, text): id with nulls last, and the text's hash, identify a row."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("rid"),
                       F.xxhash64(text_or_empty()).alias("tid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       text_or_empty().alias("text"))


def frequent_shingles(rows: DataFrame, shingle: int) -> np.ndarray:
    """At most ``FREQUENT`` shingle hashes, the rarest first."""
    def count(batches):
        for b in th.chunks(batches, "text", COUNTED_AT_ONCE):
            every = [v for part in th.chunks([b], "text") for v in sets(part.column("text"), shingle)]
            h, n = np.unique(np.concatenate(every), return_counts=True)
            often = n >= FREQUENT_IN_CHUNK
            yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often])], names=["h", "n"])
    top = (rows.select("text").mapInArrow(lambda it: th.lean(count(it)), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "h").limit(FREQUENT).collect())
    return np.array([r["h"] for r in reversed(top)], np.int64).view(np.uint64)


def _prefixes(batches, shingle: int, num: int, den: int, frequent: np.ndarray):
    by_hash = np.argsort(frequent)
    sorted_ = frequent[by_hash]
    for b in th.chunks(batches, "text"):
        every = sets(b.column("text"), shingle)
        n = np.array([len(v) for v in every], np.int64)
        flat = np.concatenate(every) if every else np.zeros(0, np.uint64)
        order = flat >> th.U64(1)
        if len(sorted_):
            at = np.minimum(np.searchsorted(sorted_, flat), len(sorted_) - 1)
            known = sorted_[at] == flat
            order = np.where(known, (1 << 63) + by_hash[at].astype(np.uint64), order).astype(np.uint64)
        ends = np.cumsum(n)
        sums = [np.r_[th.U64(0), np.cumsum(th.mix64(flat + th.U64(k)), dtype=np.uint64)] for k in (1, 2)]
        d1, d2 = ((x[ends] - x[ends - n]).view(np.int64) for x in sums)
        take = n - -(-num * n // den) + 1
        prefix = []
        for v, e, k, m in zip(every, ends, take, n, strict=True):
            prefix.append(v[np.argsort(order[e - m:e], kind="stable")[:k]].view(np.int64) if m else v.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column("rid"), b.column("tid"), b.column("doc_id"), pa.array(n), pa.array(d1), pa.array(d2),
             pa.array(prefix, pa.list_(pa.int64())), pa.array([histogram(v).tobytes() for v in every], pa.binary())],
            names=["rid", "tid", "doc_id", "n", "d1", "d2", "prefix", "hist"])


def histogram(v: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles over hash buckets, a power of two of them, cut off at 16 bits."""
    size = min(max(BUCKETS[0], 1 << (len(v) // 16).bit_length()), BUCKETS[1])
    n = np.bincount(((v >> th.U64(20)) & th.U64(size - 1)).astype(np.int64), minlength=size)
    return np.minimum(n, 65535).astype("<u2")


def close_histograms(hists: list[np.ndarray], n: np.ndarray, num: int, den: int) -> list[int]:
    """For each member the number of the smallest one it is connected with by histograms that linked
    sets could have: the sets differ in at most (1 - t) / (1 + t) of their summed sizes."""
    size = min(len(h) for h in hists)
    h = np.stack([x.reshape(-1, size).sum(0) for x in (y.astype(np.int32) for y in hists)])  # folds larger ones
    union = _Union(len(n))
    for i in range(len(n) - 1):
        apart = np.abs(h[i + 1:] - h[i]).sum(1)
        for j in np.flatnonzero((num + den) * apart <= (den - num) * (n[i + 1:] + n[i])).tolist():
            union.join(i, i + 1 + j)
    return [union.find(i) for i in range(len(n))]


def _candidates(batches, num: int, den: int):
    """Rows arrive by region (and pair of blocks).  Emits its candidate components of two and more."""
    keys = ["pr", "a", "b"]
    held = None

    def flush(t: pa.Table, out):
        cols = {c: t[c].to_numpy() for c in (*keys, "no", "n")}
        hists = t["hist"].to_pylist()
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for c in keys:
            new[1:] |= cols[c][1:] != cols[c][:-1]
        first = np.r_[np.flatnonzero(new), t.num_rows]
        for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if z - a < 2:
                continue
            root = np.array(close_histograms([np.frombuffer(x, "<u2") for x in hists[a:z]], cols["n"][a:z], num, den))
            many = np.bincount(root, minlength=len(root))[root] > 1
            if many.any():
                at = a + np.flatnonzero(many)
                for c in (*keys, "no"):
                    out[c].append(cols[c][at])
                out["root"].append(root[many])
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        last = [t[c][t.num_rows - 1].as_py() for c in keys] if t.num_rows else None
        if last is None:
            continue
        same = np.ones(t.num_rows, bool)
        for c, v in zip(keys, last, strict=True):
            same &= t[c].to_numpy() == v
        cut_at = t.num_rows - int(same.sum())
        held = t.slice(cut_at)
        out = {c: [] for c in (*keys, "root", "no")}
        if cut_at:
            flush(t.slice(0, cut_at), out)
        if out["no"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in out.values()], names=[*out])
    if held is not None:
        out = {c: [] for c in (*keys, "root", "no")}
        flush(held, out)
        if out["no"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in out.values()], names=[*out])


def _regions(batches, num: int, den: int):
    """Rows arrive by shingle, size and number.  Emits (pivot, member) for every member but the pivot:
    the pivot is the first of a size window, and a member within reach of the window before, too."""
    token = None  # of the run; then pivots and size limits of the window before and the open one
    before = now = None
    for b in batches:
        tokens, n, no = (b.column(c).to_numpy() for c in ("token", "n", "no"))
        cuts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1], True]) if len(tokens) else np.zeros(1, int)
        out: list[list[np.ndarray]] = [[], []]
        size = np.diff(cuts)

        def add(pivot, lo, hi, out=out, no=no):
            out[0].append(np.full(hi - lo, pivot))
            out[1].append(no[lo:hi])
        # runs of one row are most: only the batch's first and last run can belong to a longer one
        run = np.flatnonzero(size > 1)
        if len(size):
            run = np.unique(np.r_[0, run, len(size) - 1])
        for k in run.tolist():
            a, z = int(cuts[k]), int(cuts[k + 1])
            if token is None or tokens[a] != token:
                token, before, now = tokens[a], None, None
            i = a
            while i < z:
                if now is None or n[i] * num > now[1] * den:  # beyond the open window: it becomes the one before
                    before, now = (now[0], now[2]) if now else None, (no[i], int(n[i]), int(n[i]))
                    stop = i + int(np.searchsorted(n[i:z], int(n[i]) * den // num, "right"))
                    if stop - i > 1:
                        add(now[0], i + 1, stop)
                else:
                    stop = i + int(np.searchsorted(n[i:z], now[1] * den // num, "right"))
                    add(now[0], i, stop)
                if before is not None:  # linked with a home member of the window before
                    edge = i + int(np.searchsorted(n[i:stop], before[1] * den // num, "right"))
                    if edge > i:
                        add(before[0], i, edge)
                now = (now[0], now[1], int(n[stop - 1]))
                i = stop
        if out[0]:
            got = [np.concatenate(c) for c in out]
            other = got[0] != got[1]
            yield pa.RecordBatch.from_arrays([pa.array(c[other]) for c in got], names=["pr", "no"])


class _Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def components(members: list[np.ndarray], num: int, den: int) -> list[int]:
    """For each set the number of the smallest set it is connected with by links.  Exact."""
    m = len(members)
    size = np.array([len(v) for v in members], np.int64)
    ids, which = np.unique(np.concatenate(members), return_inverse=True)
    start = np.cumsum(size) - size
    mark = np.zeros(len(ids), np.int64)
    union = _Union(m)

    def shared(i, at=None):
        """Sizes of the intersections of set i with all sets (or those of ``at``)."""
        own = which[start[i]:start[i] + size[i]]
        mark[own] = 1
        if at is None:
            got = np.add.reduceat(mark[which], start)
        else:
            got = np.array([mark[which[start[j]:start[j] + size[j]]].sum() for j in at], np.int64)
        mark[own] = 0
        return got
    pivots, far, home, near = [], [], np.full(m, -1), np.full(m, np.inf)
    covered = np.zeros(m, bool)
    for p in range(m):
        if covered[p]:
            continue
        both = shared(p)
        linked = both * den >= num * (size + size[p] - both)
        d = 1 - both / (size + size[p] - both)
        for j in np.flatnonzero(linked).tolist():
            union.join(p, j)
        closer = linked & (d < near)
        home[closer], near[closer] = len(pivots), d[closer]
        covered |= linked
        pivots.append(p)
        far.append(d)
    r = 1 - num / den + 1e-9  # windows may be a little wide, links are decided in integers
    cells: dict[int, np.ndarray] = {}
    for a in range(len(pivots)):
        close = np.flatnonzero(far[a][pivots[a + 1:]] <= 3 * r) + a + 1
        for b in close.tolist():
            if union.find(pivots[a]) == union.find(pivots[b]):
                continue
            for c in (a, b):
                if c not in cells:
                    cells[c] = np.flatnonzero(home == c)
            y = cells[a][far[b][cells[a]] <= 2 * r]
            z = cells[b][far[a][cells[b]] <= 2 * r]
            if len(y) > len(z):
                y, z = z, y
            for i in y.tolist():
                both = shared(i, z)
                hit = z[both * den >= num * (size[z] + size[i] - both)]
                if len(hit):
                    union.join(i, int(hit[0]))
                    break  # the two cells are connected
    return [union.find(i) for i in range(m)]


def _join_region(t: pa.Table, shingle: int, num: int, den: int) -> pa.Table:
    """Sets are made of the texts here: a text takes less room in a shuffle than its shingles' hashes."""
    every = [v for b in th.chunks(t.select(["text"]).to_batches(), "text") for v in sets(b.column("text"), shingle)]
    no = t["no"].to_numpy()
    order = np.argsort(no, kind="stable")
    no = no[order]
    root = np.array(components([every[i] for i in order.tolist()], num, den))
    many = np.bincount(root, minlength=len(root))[root] > 1
    n = int(many.sum())
    own = {c: np.full(n, t[c][0].as_py()) for c in ("pr", "a", "b")}
    return pa.table({**own, "root": root[many].astype(np.int64), "no": no[many]})


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Adds (a, b): (0, 0), or of a group in several blocks each pair of blocks that the row's is in."""
    own = F.pmod(F.xxhash64("no"), F.col("blocks"))
    other = F.explode(F.when(F.col("blocks") > 1, F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
                      .otherwise(F.array(F.lit(0).cast("bigint"))))
    return (rows.withColumn("own", own).withColumn("other", other)
            .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("own", "other", "blocks"))


def _sized(members: DataFrame, region: int) -> DataFrame:
    """(pr, no, blocks) of groups of two and more."""
    return (with_group_first(members, ["pr"], ["no"])
            .select("pr", "no", F.ceil(F.col("n_rows") / region).cast("bigint").alias("blocks")))


def _merge(groups: DataFrame) -> DataFrame:
    """(no, least): the smallest number of each document's component.  ``groups`` has the components
    of regions, one row per region and member: each member is linked with its region's smallest one."""
    stars = with_group_first(groups, ["grp"], ["no"])
    found = connected(stars.select(F.col("no").alias("u"), F.col("first.no").alias("v")))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots).select(F.col("node").alias("no"), F.col("root").alias("least"))


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
                       region: int = REGION) -> DataFrame:
    """rid, tid (see ``keyed``), doc_id, n_shingles, component_id and stays (whether the row is its
    component's smallest document); one row per row of ``docs``."""
    num, den = threshold
    spark = docs.sparkSession
    n_parts = parts(spark)
    rows = keyed(docs)
    frequent = frequent_shingles(rows, shingle)
    path = scratch(spark, "prefixes")
    own = written(rows.mapInArrow(lambda it: th.lean(_prefixes(it, shingle, num, den, frequent)),
                                  "rid bigint, tid bigint, doc_id bigint, n bigint, d1 bigint, d2 bigint, "
                                  "prefix array<bigint>, hist binary").withColumn("no", F.monotonically_increasing_id()), path)
    release(spark)
    ids = own.select("no", *NODE, "doc_id", "n", "d1", "d2")
    classes = with_group_first(ids.filter("n > 0"), ["d1", "d2", "n"], [*NODE, "no"], singles=True)
    ids = cut(classes.select(*ids.columns, (F.col("first.no") == F.col("no")).alias("stands"))
              .unionByName(ids.filter("n = 0").withColumn("stands", F.lit(False))), "classes")
    full = ids.filter("n > 0")
    reps = own.select("no", "n", "prefix").join(ids.filter("stands").select("no"), "no")
    tokens = reps.select(F.explode("prefix").alias("token"), "n", "no")
    regions = (tokens.repartition(n_parts, "token").sortWithinPartitions("token", "n", "no")
               .mapInArrow(lambda it: th.lean(_regions(it, num, den)), "pr bigint, no bigint").distinct())
    pivots = regions.select("pr", F.col("pr").alias("no")).distinct()
    members = cut(regions.unionByName(pivots), "regions")
    release(spark)
    group = ["pr", "a", "b"]
    out = "pr bigint, a bigint, b bigint, root bigint, no bigint"
    close = (_in_blocks(_sized(members, region).join(own.select("no", "n", "hist"), "no"))
             .repartition(n_parts, *group).sortWithinPartitions(*group, "no")
             .mapInArrow(lambda it: th.lean(_candidates(it, num, den)), out))
    candidates = cut(close.select(F.struct(*group, "root").alias("grp"), "no"), "candidates")
    remove(spark, path)
    candidates = _merge(candidates)
    sized = _sized(candidates.select(F.col("least").alias("pr"), "no"), region).join(ids.select("no", *NODE), "no")
    with_text = rows.select(*NODE, "text").join(sized, NODE).dropDuplicates(NODE).select("pr", "blocks", "no", "text")
    joined = _in_blocks(with_text).groupBy(*group).applyInArrow(lambda t: _join_region(t, shingle, num, den), out)
    joined = cut(joined.select(F.struct(*group, "root").alias("grp"), "no"), "components")
    release(spark)
    # of each component, the smallest document
    labels = (with_group_first(_merge(joined).join(ids.select("no", *NODE), "no"), ["least"], NODE)
              .select("no", F.col("first.rid").alias("lr"), F.col("first.tid").alias("lt")))
    labelled = (full.join(labels, "no", "left")
                .withColumn("lt", F.coalesce("lt", "tid")).withColumn("lr", F.coalesce("lr", "rid")))
    # back from the class's document to all of its copies
    done = with_group_first(labelled, ["d1", "d2", "n"], ["lr", "lt", "rid", "tid"], singles=True)
    stays = (F.col("first.lr") == F.col("rid")) & (F.col("first.lt") == F.col("tid"))
    return (done.select(*NODE, "doc_id", F.col("n").alias("n_shingles"), F.col("first.lr").alias("component"), stays.alias("stays"))
            .unionByName(ids.filter("n = 0").select(*NODE, "doc_id", F.col("n").alias("n_shingles"),
                                                    F.col("rid").alias("component"), F.lit(True).alias("stays")))
            .withColumn("component_id", F.when(F.col("component") < LAST, F.col("component"))).drop("component"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, n.n
"""
