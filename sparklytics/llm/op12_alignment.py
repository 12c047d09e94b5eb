"""Operator 12: alignment of two tokenizations of the same texts.

Tokenizer A encodes space + text, tokenizer B the text, before which it puts a space itself; both give tokens of the
same bytes.  Byte offsets where tokens of both end cut a text into groups; an A and a B token whose byte ranges
overlap are a link, and how often two ids are linked in the whole corpus is the link's count.

1. Each text is encoded in the task that reads it.  Its token ends are two sorted lists.
2. Merge path.  Walking both lists at once takes one step per token.  Binary searches on the diagonals of
   the merge (every ``PIECE`` steps) find where each piece starts in A and in B, without walking there, so the
   pieces are independent and of equal work, however long the text is.  A piece emits its overlaps (every distinct
   end closes exactly one) and its common ends; an end that A has as the last of one piece and B as the first of the next is
   one end.  Groups that a piece leaves open are stitched with the next one's.
3. Pieces become rows: a text's share of a piece, with its distinct id pairs.  Rows are dealt into batches
   of ``BATCH_STEPS`` steps, so a very long text is spread over many.  A batch asks once about each of its distinct
   pairs.  Counts are summed by pair and joined to the requests by pair: a pair is there once a batch, however
   common it is.  Highest counts by B id are at most a vocabulary of rows, which bounds their broadcast.
4. The answers meet the batch's rows in a co-group (the shuffle of the rows is used three times), and rows of one text are summed.

Texts that A's fast form (the same vocabulary as ranks) and its JSON form could split differently, those with characters
beyond U+024F, take the JSON form.

Defined results: null and empty texts, texts that are not valid UTF-8, and texts that one of the tokenizers changes (so that joined
bytes differ) have no tokens: zeros and an empty ``groups_sha256``; special tokens' strings are plain text; of ids linked
equally often with a B id (ties) all are its highest; very long texts are encoded whole, by one task, and merged by pieces; repeated
rows each count and each get their row; a null ``doc_id`` stays null; an empty table gives no rows; other columns are ignored.
The input should be a table or another plan that gives the same rows in the same order when a lost task is run
again (``common.cut`` makes one).
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents
from .exchange import pack, pack_sorted, unpack, unpack_sorted

PIECE = 1 << 15
CHUNK = 1 << 20           # bytes of text encoded at once, or one longer text
BATCH_STEPS = 4 << 20     # about 10 MB of text
A_JSON, A_RANKS, B_MODEL = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
_BEYOND = re.compile("[^\x00-ɏ]")
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
PART = ("row bigint, batch bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs binary, counts binary")


def byte_level() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Pair:
    """The two tokenizers and the bytes of their ids."""

    def __init__(self, a_json: str, a_ranks: str, b_model: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_json)
        self.a.encode_special_tokens = True
        with open(a_ranks, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in (line.split() for line in f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_model)
        level = byte_level()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = bytes(level[c] for c in t) if all(c in level for c in t) else t.encode()
        self.b_bytes = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            as_byte = _BYTE_PIECE.fullmatch(piece)
            self.b_bytes.append(bytes([int(as_byte[1], 16)]) if as_byte else piece.replace("▁", " ").encode())
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [self.a.encode(" " + t, add_special_tokens=False).ids if _BEYOND.search(t) else self.fast.encode_ordinary(" " + t)
             for t in texts]
        return a, self.b.encode(texts, num_threads=1)


@functools.lru_cache(maxsize=2)
def tokenizer_pair(a_json: str, a_ranks: str, b_model: str) -> Pair:
    return Pair(a_json, a_ranks, b_model)


def merge_path(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each piece of ``step`` merge steps starts in the sorted lists ``a`` and ``b`` (of equal values, a's
    comes first); the last entries are their ends.  One binary search on each diagonal."""
    n = len(a) + len(b)
    d = np.r_[np.arange(0, n, step), n]
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        first = np.zeros(len(d), bool)
        first[open_] = a[mid[open_]] <= b[d[open_] - 1 - mid[open_]]
        lo, hi = np.where(open_ & first, mid + 1, lo), np.where(open_ & ~first, mid, hi)
    return lo, d - lo


def overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Of the piece a[i0:i1], b[j0:j1] of two lists of token ends: positions (i, j) of overlapping tokens with
    the end that closes each overlap, and positions (i, j) of common ends."""
    ea, eb = a[i0:i1], b[j0:j1]
    at_a = j0 + np.searchsorted(eb, ea)
    r = np.searchsorted(ea, eb)
    common = np.zeros(len(eb), bool)
    inside = r < len(ea)
    common[inside] = ea[r[inside]] == eb[inside]
    close = i0 + r
    if i0 and len(eb) and not common[0] and a[i0 - 1] == eb[0]:  # the piece before ends with this end's A token
        common[0], close[0] = True, i0 - 1
    alone = ~common
    i = np.r_[np.arange(i0, i1), i0 + r[alone]]
    j = np.r_[at_a, j0 + np.flatnonzero(alone)]
    return i, j, np.r_[ea, eb[alone]], close[common], j0 + np.flatnonzero(common)


_DIGITS = np.array([list(f"{i:<5d}".encode()) for i in range(1 << 16)], np.uint8)
_WIDTH = np.array([len(str(i)) for i in range(1 << 16)], np.int64)
_COMMA, _BAR, _SEMI = b",|;"


def group_text(a: np.ndarray, b: np.ndarray, close_a: np.ndarray, close_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;`` for each group, and where each group's text ends.  ``close`` has the position of each group's
    last token; ids are below 65,536."""
    ga = np.searchsorted(close_a, np.arange(len(a)))
    gb = np.searchsorted(close_b, np.arange(len(b)))
    token, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), _COMMA, np.uint8)
    at_a = np.arange(len(a)) + np.r_[0, close_b + 1][ga]
    at_b = np.arange(len(b)) + (close_a + 1)[gb]
    token[at_a], token[at_b] = a, b
    mark[at_a[close_a]], mark[at_b[close_b]] = _BAR, _SEMI
    width = _WIDTH[token]
    end = np.cumsum(width + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    start = end - width - 1
    for k in range(5):
        on = width > k
        out[start[on] + k] = _DIGITS[token[on], k]
    out[end - 1] = mark
    return out.tobytes(), end[at_b[close_b]]


def _aligned(a_ids: list[list[int]], b_ids: list[list[int]], a_len: np.ndarray, b_len: np.ndarray, step: int):
    """For texts with tokens: (text, n_a, n_b, n_groups, n_links, sha or '', pairs, counts) of each text's share of each piece."""
    a, b = (np.concatenate([np.array(x, np.int64) for x in ids]) for ids in (a_ids, b_ids))
    ends_a, ends_b = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    text_end = ends_a[np.cumsum([len(x) for x in a_ids]) - 1]  # a common end: no group spans two texts
    starts = merge_path(ends_a, ends_b, step)
    open_a, open_b = 0, 0  # first tokens of the group that the pieces before left open
    sha = hashlib.sha256()
    for i0, i1, j0, j1 in zip(starts[0][:-1].tolist(), starts[0][1:].tolist(), starts[1][:-1].tolist(), starts[1][1:].tolist(), strict=True):
        i, j, end, close_a, close_b = overlaps(ends_a, ends_b, i0, i1, j0, j1)
        text = np.searchsorted(text_end, end)
        lo, hi = int(text.min()) if len(text) else 0, int(text.max()) + 1 if len(text) else 0
        if len(close_a):  # texts of the common ends may start before the piece's overlaps do
            of_close = np.searchsorted(text_end, ends_b[close_b])
            lo, hi = (min(lo, int(of_close[0])), max(hi, int(of_close[-1]) + 1)) if hi else (int(of_close[0]), int(of_close[-1]) + 1)
        digests = [""] * (hi - lo)
        groups = np.zeros(hi - lo, np.int64)
        if len(close_a):
            done, at = group_text(a[open_a:close_a[-1] + 1], b[open_b:close_b[-1] + 1], close_a - open_a, close_b - open_b)
            open_a, open_b = int(close_a[-1]) + 1, int(close_b[-1]) + 1
            groups = np.bincount(of_close - lo, minlength=hi - lo)
            last = np.flatnonzero(ends_b[close_b] == text_end[of_close])
            pos = 0
            for g in last.tolist():
                sha.update(done[pos:int(at[g]) - 1])  # the last group has no separator behind it
                digests[int(of_close[g]) - lo] = sha.hexdigest()
                sha, pos = hashlib.sha256(), int(at[g])
            sha.update(done[pos:])
        pair = ((text - lo).astype(np.uint64) << th.U64(32)) | (b[j] << 16 | a[i]).astype(np.uint64)
        pair, n = np.unique(pair, return_counts=True)
        cut_at = np.searchsorted(pair, np.arange(hi - lo + 1, dtype=np.uint64) << th.U64(32))
        pair &= th.U64(0xFFFFFFFF)
        of_a = np.bincount(np.searchsorted(text_end, ends_a[i0:i1]) - lo, minlength=hi - lo)
        of_b = np.bincount(np.searchsorted(text_end, ends_b[j0:j1]) - lo, minlength=hi - lo)
        links = np.bincount(text - lo, minlength=hi - lo)
        for k in range(hi - lo):
            s = slice(int(cut_at[k]), int(cut_at[k + 1]))
            yield (lo + k, int(of_a[k]), int(of_b[k]), int(groups[k]), int(links[k]), digests[k],
                   pack_sorted(pair[s], 4), pack(n[s], 4))


def _parts(batches, paths: tuple[str, str, str], step: int, batch_steps: int) -> Iterator[pa.RecordBatch]:
    """Rows of PART for (doc_id, text); ``row`` is one number for each input row."""
    tok = tokenizer_pair(*paths)
    task = TaskContext.get().partitionId()
    row, batch, steps = task << 40, task << 32, 0
    names = [c.split()[0] for c in PART.split(", ")]
    types = [pa.binary() if c.endswith("binary") else pa.string() if c.endswith("string") else pa.int64() for c in PART.split(", ")]
    for chunk in th.chunks(batches, "text", CHUNK):
        ids = chunk.column("doc_id").to_pylist()
        texts, at = [], []
        for k, raw in enumerate(chunk.column("text").to_pylist()):
            try:
                text = (raw or b"").decode()
            except UnicodeDecodeError:
                text = ""
            if text:
                texts.append(text)
                at.append(k)
        ga, gb = tok.encode(texts) if texts else ([], [])
        keep = []
        for k, t in enumerate(texts):
            want = (" " + t).encode()
            if b"".join(map(tok.a_bytes.__getitem__, ga[k])) == want and b"".join(map(tok.b_bytes.__getitem__, gb[k])) == want:
                keep.append(k)
        has = {at[k] for k in keep}
        out, held = [(row + k, batch, i, 0, 0, 0, 0, "", b"", b"") for k, i in enumerate(ids) if k not in has], 0
        if keep:
            for t, na, nb, g, n, digest, pairs, counts in _aligned([ga[k] for k in keep], [gb[k] for k in keep], tok.a_len, tok.b_len, step):
                k = at[keep[t]]
                out.append((row + k, batch, ids[k], na, nb, g, n, digest, pairs, counts))
                steps, held = steps + na + nb, held + na + nb
                if steps >= batch_steps:
                    batch, steps = batch + 1, 0
                if held >= CHUNK:  # a very long text's rows leave before all are made
                    yield _batch(out, types, names)
                    out, held = [], 0
        row += len(ids)
        if out:
            yield _batch(out, types, names)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _ask(t: pa.Table) -> pa.Table:
    """A batch's distinct id pairs with their numbers."""
    pair, n = _pairs(t)
    pair, at = np.unique(pair, return_inverse=True)
    total = np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)
    return pa.table({"batch": np.full(len(pair), t["batch"][0].as_py(), np.int64), "b": (pair >> 16).astype(np.int32),
                     "a": (pair & 0xFFFF).astype(np.int32), "n": total})


def _pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    pairs = [unpack_sorted(x, 4) for x in t["pairs"].to_pylist()]
    counts = [unpack(x, 4) for x in t["counts"].to_pylist()]
    return (np.concatenate(x).astype(np.int64) for x in (pairs, counts))


OUT = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _answer(parts: pa.Table, answers: pa.Table) -> pa.Table:
    key = answers["b"].to_numpy().astype(np.int64) << 16 | answers["a"].to_numpy()
    order = np.argsort(key)
    key, total, best = key[order], answers["total"].to_numpy()[order], answers["best"].to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = [], []
    for pairs, counts in zip(parts["pairs"].to_pylist(), parts["counts"].to_pylist(), strict=True):
        at, n = np.searchsorted(key, unpack_sorted(pairs, 4).astype(np.int64)), unpack(counts, 4).astype(np.int64)
        n_best.append(int(n[best[at]].sum()) if len(at) else 0)
        count_sum.append(int((n * total[at]).sum()) if len(at) else 0)
    same = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table({**{c: parts[c] for c in same}, "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                     "groups_sha256": parts["groups_sha256"]})


def align(docs: DataFrame, a_json: str | None = None, a_ranks: str | None = None, b_model: str | None = None, step: int = PIECE,
          batch_steps: int = BATCH_STEPS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row per row of ``docs``.

    The paths are those of A's JSON file, of the same vocabulary as ranks, and of B's model, on every executor."""
    paths = tuple(p or public_tokenizers.path(d) for p, d in ((a_json, A_JSON), (a_ranks, A_RANKS), (b_model, B_MODEL)))
    paths = tuple(map(str, paths))
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(lambda it: _parts(it, paths, step, batch_steps), PART))
    asked = rows.groupBy("batch").applyInArrow(_ask, "batch bigint, b int, a int, n bigint")
    totals = asked.groupBy("b", "a").agg(F.sum("n").alias("total"))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))  # at most B's vocabulary of rows
    counted = totals.join(F.broadcast(highest), "b").select("b", "a", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = asked.select("batch", "b", "a").join(counted, ["b", "a"])
    done = rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_answer, OUT)
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return (done.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256"))
            .drop("row"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
