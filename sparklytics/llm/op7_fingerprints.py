"""Operator 7: document fingerprints, bottom-k sketches of shingle hashes.

A document's set is its distinct shingles of ``shingle`` consecutive words (A-Z lower-cased, split at
ASCII white space; a shorter text is one shingle).  The fingerprint is the ``k`` smallest 64-bit
shingle hashes, written as base64 of their big-endian bytes.  Fingerprints of parts merge into the
fingerprint of the whole (``merge``, or ``merge_fingerprints`` over a table), and two of them estimate
resemblance, containment and, one alone, the number of distinct shingles.

``compare_with_edited`` needs each document's successor in descending id order.  It deals the rows
into ranges of ids, cut at bounds that are ids of the table (a quantile summary; their number follows
the shuffle partitions, not the data), sorts each range and streams over it holding one row.  The
first document of a range is sent to the range before it as well, so that every row finds its
successor in its own task, and the texts are shuffled once.

Defined results: null text is the empty text; the empty text's fingerprint is "" and resembles only
another empty one (1.0); null ids come last in the order; rows of equal id follow each other by
text; a single row is its own successor; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents, parts, text_or_empty

K, SHINGLE = 128, 5
RANGES_PER_TASK = 4
LAST = -(1 << 63)  # order key of a null id


def encode(h: np.ndarray) -> str:
    return base64.b64encode(h.astype(">u8").tobytes()).decode()


def decode(fingerprint: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint or ""), ">u8").astype(np.uint64)


def sketches(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    buf, off = th.flat(texts)
    buf = th.LOWER[buf]
    s, e, row = th.words(buf, off)
    g, r = th.grams(th.span_hash(buf, s, e), row, shingle)
    r, g = th.distinct(r, g)
    at = th.bounds(r, len(texts))
    return [g[a:min(a + k, b)] for a, b in zip(at[:-1], at[1:], strict=True)]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.union1d(a, b)[:k]


def _shared(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, np.ndarray]:
    both = np.concatenate([a, b])
    both.sort()
    twice = np.zeros(len(both), bool)
    twice[1:] = both[1:] == both[:-1]
    union = both[~twice][:k]
    return int((both[twice] <= union[-1]).sum()) if len(union) else 0, union


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the shared part of the union's bottom k.  Exact when the union
    has at most ``k`` shingles."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    n, union = _shared(a, b, k)
    return n / len(union)


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0 ** 64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has, from resemblance and the counts."""
    if not len(a):
        return 1.0
    j, na, nb = resemblance(a, b, k), distinct_count(a, k), distinct_count(b, k)
    return min(1.0, j * (na + nb) / (1 + j) / na)


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint of every row."""
    def run(batches):
        for b in th.chunks(batches, "text"):
            prints = [encode(x) for x in sketches(b.column("text"), k, shingle)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, fingerprint string")


def merge_fingerprints(prints: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, fingerprint) of the union of each key's documents: hashes are made distinct, and the
    rank limit keeps ``k`` of a key on each task before the shuffle, so no group is gathered."""
    raw = F.unbase64("fingerprint")
    hashes = (prints.filter(F.length("fingerprint") > 0).select(key, raw.alias("raw"))
              .withColumn("i", F.explode(F.expr("sequence(0, cast(octet_length(raw) / 8 as int) - 1)")))
              .select(key, F.expr("substring(raw, i * 8 + 1, 8)").alias("h")).distinct())
    low = Window.partitionBy(key).orderBy("h")
    kept = hashes.withColumn("rank", F.row_number().over(low)).filter(F.col("rank") <= k)
    joined = F.expr("concat_ws('', transform(array_sort(collect_list(h)), x -> hex(x)))")
    return kept.groupBy(key).agg(F.base64(F.unhex(joined)).alias("fingerprint"))


def _numbers(values, kind: str) -> Column:
    """A constant array as one literal, however long: a plan of thousands of literals takes minutes to build."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _range_of(bounds: list[int], order: Column) -> tuple[Column, Column]:
    """(range, whether the id is a bound); ranges count down from the largest id.  A binary search
    over the sorted bounds, in log2 steps."""
    m = len(bounds)
    a = _numbers(bounds, "bigint")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(m.bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda pos, s: F.when(
        (pos + s <= m) & (F.get(a, pos + s - 1) < order), pos + s).otherwise(pos))
    return F.lit(m - 1) - below, F.coalesce(F.get(a, below) == order, F.lit(False))


def _stream(batches, k: int, shingle: int):
    """Rows arrive by range and descending id, each range closed by the next one's first document."""
    held = None
    for b in th.chunks(batches, "text", th.CHUNK_BYTES // 2):
        t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
        held = t.slice(t.num_rows - 1).to_batches()[0]
        texts, deal, ghost, ids = (t.column(c).to_pylist() for c in ("text", "deal", "ghost", "doc_id"))
        at = [i for i in range(len(texts) - 1) if not ghost[i] and deal[i] == deal[i + 1]]
        if not at:
            continue
        edited = []
        for i in at:
            third = len(texts[i]) // 3
            edited.append(texts[i][:len(texts[i]) - third] + texts[i + 1][:third])
        own = sketches(t.column("text"), k, shingle)
        new = sketches(pa.array(edited, pa.string()), k, shingle)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
             pa.array([encode(own[i]) for i in at]), pa.array([encode(x) for x in new]),
             pa.array([resemblance(own[i], x, k) for i, x in zip(at, new, strict=True)], pa.float64()),
             pa.array([resemblance(own[i], own[i + 1], k) for i in at], pa.float64())],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_with_edited(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Per row its fingerprint, that of its text with the last third replaced from its successor
    (see the module), and the estimated resemblance to that text and to the successor."""
    spark = docs.sparkSession
    n = parts(spark)
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), order.alias("ord"))
    m = n * RANGES_PER_TASK
    cuts = rows.agg(F.max("ord").alias("top"),
                    F.percentile_approx("ord", _numbers([i / m for i in range(1, m)], "double"), F.lit(20 * m)).alias("cuts")).first()
    bounds = sorted({cuts["top"], *cuts["cuts"]}) if cuts["top"] is not None else [LAST]
    deal, is_bound = _range_of(bounds, F.col("ord"))
    before = F.pmod(F.col("range") - 1, F.lit(len(bounds)))
    dealt = (rows.withColumn("range", deal).withColumn("bound", is_bound)
             .withColumn("to", F.explode(F.when(F.col("bound"), F.array(
                 F.struct(F.col("range").alias("deal"), F.lit(False).alias("ghost")),
                 F.struct(before.alias("deal"), F.lit(True).alias("ghost"))))
                 .otherwise(F.array(F.struct(F.col("range").alias("deal"), F.lit(False).alias("ghost"))))))
             .select("doc_id", "text", "ord", "to.deal", "to.ghost"))
    return (dealt.repartition(n, "deal").sortWithinPartitions("deal", "ghost", F.desc("ord"), "text")
            .mapInArrow(lambda it: _stream(it, k, shingle),
                        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edited(documents(spark, sf_dir))
