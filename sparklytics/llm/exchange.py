"""Requests and replies between batches of documents and shards of a model, as Spark exchanges.

Documents are dealt into batches of a few megabytes by a hash of each row's number in its partition, so that rows
equal in id and text are spread, too.  The numbers are the same again when a lost task is run again, if the
documents are a table or another plan with a fixed order of rows (``common.cut`` makes one).  A batch asks
each shard about its distinct keys, with its own counts, in one row: the keys are deduplicated before
they are shuffled, however many rows of the batch repeat them.  A shard sees what all batches sent,
answers each row, and a co-group hands the answers back to the batch.  The numbers of batches and
shards follow the text's bytes.  What a shard holds grows with the corpus's distinct keys over the number of shards; the
operators say what they send to shards that none of a batch's keys belong to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texthash as th
from .common import text_or_empty

BATCH_BYTES = 4 << 20


def dealt(docs: DataFrame, *extra) -> tuple[DataFrame, int]:
    """(batch, doc_id, text, extra columns) and the number of batches."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-size // BATCH_BYTES))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), *extra)
    number = F.xxhash64(F.monotonically_increasing_id())
    return rows.select(F.pmod(number, F.lit(n)).alias("batch"), *rows.columns), n


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (th.mix64(keys) % th.U64(shards)).astype(np.int64)


def pack(a: np.ndarray, width: int) -> bytes:
    """Unsigned integers as ``width`` byte planes: planes of zeros compress in the shuffle."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def pack_sorted(a: np.ndarray, width: int) -> bytes:
    return pack(np.diff(a.astype(np.uint64), prepend=th.U64(0)), width)


def unpack_sorted(raw: bytes, width: int) -> np.ndarray:
    return np.cumsum(unpack(raw, width), dtype=np.uint64)


def by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(stable order by shard, offsets of the shards in it)."""
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def runs_by_shard(shard: np.ndarray) -> dict[int, np.ndarray]:
    """For each shard that occurs, the positions of its entries in their order."""
    order = np.argsort(shard, kind="stable")
    ids, first = np.unique(shard[order], return_index=True)
    return {int(s): i for s, i in zip(ids, np.split(order, first[1:]), strict=True)} if len(ids) else {}


def table(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({k: pa.array(v, t) for k, (v, t) in columns.items()})
