"""C9 as a sequence match with keyed state: a file's removal after its addition is reported at the match.

The windowed form (``queries.added_then_removed``) reports when the watermark closes a window, up to two horizons late.
Here each file has a small state and a match leaves in the micro-batch that completes it:

* Time is cut into buckets of the horizon H.  Per bucket the state holds four times: first and last addition, first and
  last removal.  A removal less than H after an addition is in the same bucket, where it is enough that the first
  addition precedes the last removal, or in the next one, where it is enough that the first removal comes less than H
  after the bucket's last addition.  So these four decide exactly, however many events the bucket has and in
  whatever order they come.
* A timer drops a bucket when no event that is still on time could complete a match with it: at the watermark of two
  horizons after its start.  State is therefore at most (lateness / H + 3) buckets a file, and none for quiet files.
* Before the shuffle, each task reduces its events to a row per file and bucket (an Arrow aggregation), so a file with
  a third of all events costs a row per task.

A match is reported once; a file is reported again only for events after its state has expired.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import constants as K
from ..functions import fields
from .queries import TS, interval_seconds

TIMES = ["a_min", "a_max", "r_min", "r_max"]
REDUCED = "repository string, filename string, bucket bigint, " + ", ".join(f"{c} bigint" for c in TIMES) + ", ts timestamp"
STATE = "bucket array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in TIMES) + ", reported boolean"
OUT = "repository string, filename string"
Times = list  # four microsecond times of a bucket, or None


def _reduce(batches: Iterator[pa.RecordBatch], h_us: int) -> Iterator[pa.RecordBatch]:
    """A row per file and bucket of each Arrow batch, and one without a file that only moves event time on."""
    schema = pa.schema([("repository", pa.string()), ("filename", pa.string()), ("bucket", pa.int64()),
                        *[(c, pa.int64()) for c in TIMES], ("ts", pa.timestamp("us", "UTC"))])
    for b in batches:
        t = pa.Table.from_batches([b])
        newest = pc.max(t["us"])
        if not newest.is_valid:
            continue
        t = t.filter(pc.and_(pc.is_valid(t["filename"]), pc.and_(pc.is_valid(t["removed"]), pc.is_valid(t["us"]))))
        us, removed = t["us"], t["removed"]
        t = t.append_column("bucket", pa.array(us.to_numpy() // h_us, pa.int64()))
        none = pa.scalar(None, pa.int64())
        t = t.append_column("a", pc.if_else(removed, none, us)).append_column("r", pc.if_else(removed, us, none))
        g = t.group_by(["repository", "filename", "bucket"]).aggregate(
            [("a", "min"), ("a", "max"), ("r", "min"), ("r", "max"), ("us", "max")])
        rows = pa.table([g["repository"], g["filename"], g["bucket"], g["a_min"], g["a_max"], g["r_min"], g["r_max"],
                         g["us_max"].cast(pa.timestamp("us", "UTC"))], schema=schema)
        clock = pa.table([[None], [None], [None], [None], [None], [None], [None], pa.array([newest.as_py()], pa.timestamp("us", "UTC"))],
                         schema=schema)
        yield from rows.to_batches()
        yield from clock.to_batches()


def merge(buckets: dict[int, Times], bucket: int, new: Times) -> None:
    old = buckets.get(bucket)
    if old is None:
        buckets[bucket] = list(new)
        return
    for i, pick in enumerate((min, max, min, max)):
        old[i] = new[i] if old[i] is None else old[i] if new[i] is None else pick(old[i], new[i])


def matches(buckets: dict[int, Times], touched: set[int], h_us: int) -> bool:
    """Whether a removal follows an addition in less than the horizon, looking where something is new."""
    for b in {x + d for x in touched for d in (-1, 0)}:
        here, there = buckets.get(b), buckets.get(b + 1)
        if here and here[0] is not None:
            if here[3] is not None and here[0] < here[3]:
                return True
            if there and there[2] is not None and there[2] - here[1] < h_us:
                return True
    return False


def _load(state: GroupState) -> tuple[dict[int, Times], bool]:
    if not state.exists:
        return {}, False
    bucket, *times, reported = state.get
    clean = [[None if pd.isna(x) else int(x) for x in t] for t in times]
    return {int(b): [t[i] for t in clean] for i, b in enumerate(bucket)}, bool(reported)


def _match(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, h_us: int) -> Iterator[pd.DataFrame]:
    if key[1] is None:  # the clock rows
        return
    buckets, reported = _load(state)
    touched: set[int] = set()
    if not state.hasTimedOut:
        for pdf in frames:
            for row in pdf[["bucket", *TIMES]].astype("Int64").itertuples(index=False):
                new = [None if pd.isna(x) else int(x) for x in row]
                merge(buckets, new[0], new[1:])
                touched.add(new[0])
    if not reported and matches(buckets, touched, h_us):
        reported = True
        yield pd.DataFrame({"repository": [key[0]], "filename": [key[1]]})
    mark = state.getCurrentWatermarkMs() * 1000
    buckets = {b: t for b, t in buckets.items() if (b + 2) * h_us > mark}
    if not buckets:
        if state.exists:
            state.remove()
        return
    order = sorted(buckets)
    state.update((order, *[[buckets[b][i] for b in order] for i in range(4)], reported))
    state.setTimeoutTimestamp(max((order[0] + 2) * h_us // 1000 + 1, state.getCurrentWatermarkMs() + 1))


def added_then_removed_keyed(commits: DataFrame, within: str = K.ADDED_REMOVED_WITHIN, watermark: str = "0 seconds") -> DataFrame:
    """C9 on a stream: (repository, filename), reported in the micro-batch that completes the match.  Any commit moves
    event time on, also one without added or removed files."""
    h_us = interval_seconds(within) * 1_000_000
    f = commits.select(fields.full_name("url").alias("repository"), F.unix_micros(F.col(TS)).alias("us"), F.explode_outer("files").alias("f"))
    status = F.col("f.status")
    events = f.select("repository", F.col("f.filename").alias("filename"), "us",
                      F.when(status == "removed", True).when(status == "added", False).alias("removed"))
    reduced = events.mapInArrow(lambda it: _reduce(it, h_us), REDUCED).withWatermark("ts", watermark)
    return reduced.groupBy("repository", "filename").applyInPandasWithState(
        lambda key, frames, state: _match(key, frames, state, h_us), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
