"""Operator 4: line-level deduplication by winnowing over line hashes.

A document is its sequence of non-empty lines (separated by newline, compared byte by byte).  In
every window of ``window`` consecutive lines the smallest line hash (the rightmost of ties) is the
window's fingerprint, so any run of at least ``window`` lines that occurs twice shares fingerprints
at both places.  Positions are joined on the fingerprint, and each match is extended both ways line
by line to the windows around it; a window that also occurs earlier, in (doc_id, line) order, is a
later repeat, and every line that such a window covers is deleted.  Neighbouring windows overlap, so
deleted lines form exactly the maximal repeated runs of ``window`` lines or more.

Joining and extending are one equality: a fingerprint with the lines before and after it up to the
window's ends.  So positions are reduced to the first one per extended fingerprint before they
are shuffled, no pairs of positions are built, and a run shared by a third of all documents is
spread by salts (``with_group_first``).

With ``min_words``, a run of fewer than ``window`` lines counts as well if it has that many words
(white-space separated): its lines are windows of their own, reduced in the same way, so a long
passage on one or two lines is found whatever stands around it.  The pipeline and the registered query work so, with
``MIN_WORDS``.

Defined results: null text is the empty text; without ``min_words``, documents of fewer lines than
``window`` are never changed; blank lines are kept and don't separate runs; a repeat within one document counts; a null
``doc_id`` comes after all others; rows that are equal in id and text are one document (each gets the
same answer); extra columns are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents, text_or_empty, with_group_first

WINDOW = 3  # lines
MIN_WORDS = 13  # of a run of fewer lines, as operator 8's windows
KEY = ["rid", "tid"]  # row identity: id with nulls last, and the text's hash


def _windows(batches, window: int, min_words: int | None):
    """(rid, tid, line, size, fingerprint, extended) of every window of every text: ``window`` lines,
    and with ``min_words`` also fewer lines of that many words.  ``line``: index of the window's first
    line among the non-empty lines; ``size``: its number of lines."""
    from numpy.lib.stride_tricks import sliding_window_view
    for b in th.chunks(batches, "text"):
        buf, off = th.flat(b.column("text"))
        s, e, row = th.lines(buf, off)
        n = len(s)
        h = th.span_hash(buf, s, e)
        first = np.searchsorted(row, row, "left")  # of each line: the first line of its row
        if min_words is not None:
            starts = th.words(buf, off)[0]
            words = np.r_[0, np.cumsum(np.searchsorted(starts, e) - np.searchsorted(starts, s))]
        for size in range(window if min_words is None else 1, min(window, n) + 1):
            ok = row[:n - size + 1] == row[size - 1:]
            if size < window:
                ok &= words[size:] - words[:n - size + 1] >= min_words
            view = sliding_window_view(h, size)[ok]
            if not len(view):
                continue
            at = size - 1 - view[:, ::-1].argmin(axis=1)  # the rightmost minimum
            ext = np.full(len(view), window - size, np.uint64)
            for j in range(size):
                ext = th.mix64(ext * th.U64(0x9E3779B97F4A7C15) + view[:, j] + (at + 1).astype(th.U64))
            line = (np.arange(n) - first)[:n - size + 1][ok]
            r = pa.array(row[:n - size + 1][ok])
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").take(r), b.column("tid").take(r), pa.array(line.astype(np.int64)),
                 pa.array(np.full(len(view), size, np.int32)),
                 pa.array(view[np.arange(len(view)), at].view(np.int64)), pa.array(ext.view(np.int64))],
                names=["rid", "tid", "line", "size", "fingerprint", "extended"])


def _cut(text: str, runs) -> tuple[str, int]:
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x]
    gone = {full[j] for a, b in runs for j in range(a, b)}
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)


def _apply(batches):
    for b in th.chunks(batches, "text"):
        kept, gone, total = [], [], []
        for t, at in zip(b.column("text").to_pylist(), b.column("at").to_pylist(), strict=True):
            total.append(sum(map(bool, t.split("\n"))))
            t, n = (t, 0) if at is None else _cut(t, [(w["line"], w["line"] + w["size"]) for w in at])
            kept.append(t)
            gone.append(n)
        rest = [i for i, c in enumerate(b.schema.names) if c not in ("text", "at")]
        yield pa.RecordBatch.from_arrays(
            [b.column(i) for i in rest] + [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
            names=[b.schema.names[i] for i in rest] + ["kept_text", "n_lines", "n_removed"])


def repeated_windows(docs: DataFrame, window: int = WINDOW, min_words: int | None = None) -> DataFrame:
    """(rid, tid, at): per document, first line and size of its windows that occur earlier."""
    rows = docs.select(*KEY, "text").mapInArrow(
        lambda it: th.lean(_windows(it, window, min_words)),
        "rid bigint, tid bigint, line bigint, size int, fingerprint bigint, extended bigint")
    later = (with_group_first(rows, ["fingerprint", "extended"], [*KEY, "line"])
             .filter(F.struct(*KEY, "line") > F.col("first")))
    return later.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("line", "size"))).alias("at"))


def line_dedup(docs: DataFrame, window: int = WINDOW, min_words: int | None = None) -> DataFrame:
    """One row per document: all its columns but ``text`` and n_lines, n_removed, kept_text.  Without
    ``min_words``, only runs of ``window`` lines or more count as repeats."""
    own = docs.columns
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(f"own_{i}") for i, c in enumerate(own) if c != "text"], text_or_empty().alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("rid"),
        F.xxhash64(text_or_empty()).alias("tid"))
    joined = keyed.join(repeated_windows(keyed, window, min_words), KEY, "left").drop(*KEY)
    rest = [f for f in joined.schema.fields if f.name.startswith("own_")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest),
                        "kept_text string, n_lines bigint, n_removed bigint"])
    out = joined.mapInArrow(lambda it: th.lean(_apply(it)), schema)
    return out.select(*[F.col(f"own_{i}").alias(c) for i, c in enumerate(own) if c != "text"],
                      "n_lines", "n_removed", "kept_text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup(docs, min_words=MIN_WORDS).select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM raw WHERE line <> ''),
win AS (
  SELECT doc_id, p, unnest([
    {'size': 1, 'words': words, 'run': line},
    {'size': 2, 'words': words + lead(words, 1) OVER w, 'run': line || chr(10) || lead(line, 1) OVER w},
    {'size': 3, 'words': 13, 'run': line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w}]) AS x
  FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
later AS (
  SELECT doc_id, p, size FROM (
    SELECT doc_id, p, x.size AS size, row_number() OVER (PARTITION BY x.size, x.run ORDER BY doc_id, p) AS k
    FROM win WHERE x.run IS NOT NULL AND x.words >= 13)
  WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p + unnest(range(size)) AS p FROM later),
marked AS (
  SELECT r.doc_id, r.i, r.line, f.p, g.p AS g
  FROM raw r LEFT JOIN full_lines f ON r.doc_id = f.doc_id AND r.i = f.i
  LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.p = g.p)
SELECT doc_id, count(p) AS n_lines, count(g) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (g IS NULL), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
