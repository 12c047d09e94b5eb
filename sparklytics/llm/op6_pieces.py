"""Operator 6: sampled SentencePiece segmentations, and lossless decoding.

The vocabulary of a public piece model is read, never trained.  Its BPE scores are merge ranks, so a
piece's probability is taken from its rank by Zipf's law, 1 / (rank + ``SHIFT``), raised to ``alpha``:
a large alpha approaches the single most likely segmentation, 0 makes all segmentations equal.

A text is cut into units (a run of spaces with the characters up to the next space), and every unit
has a lattice of pieces.  Forward filtering sums, for each position, the weight of all segmentations
that reach it; backward sampling draws the last piece in proportion to weight, moves to its start and
goes on.  Lattices are built once per distinct unit of a chunk, and all occurrences in the chunk
are sampled in step.  The random number of each draw is a hash of seed, row key, unit number and
step, so a row gets the same segmentation on any executor, in any partitioning, and after a retry.

Lossless: a piece's space mark stands for a space, and a character that no piece covers (a mark in the
text among them) is written as byte pieces.  Decoding joins pieces, turns marks to spaces and bytes to text.

Defined results: null text is the empty text, which has no pieces; the row key is doc_id, a null one
counts as a key of its own; repeated rows get equal segmentations; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import texthash as th
from .common import documents, text_or_empty

MODEL = "piece_bpe_32k.model"  # of the public_tokenizers folder
MARK = "▁"
ALPHA, SHIFT, SEED = 1.0, 100.0, 17
CHUNK_BYTES = 2 << 20  # of text at once: lattices take some hundred bytes a character of distinct units
BYTE_PENALTY = -14.0  # log weight of a byte piece: used where nothing else fits


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte = np.zeros(256, np.int64)
        self.raw: list[bytes] = [b""] * n
        self.log = np.zeros(n)
        by_length: dict[int, tuple[list[bytes], list[int]]] = {}
        longer: dict[int, set[bytes]] = {}  # by length: what a longer piece begins with
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], self.raw[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.raw[i] = piece.replace(MARK, " ").encode()
                texts, ids = by_length.setdefault(len(piece), ([], []))
                texts.append(self.raw[i])
                ids.append(i)
                for k in range(1, len(piece)):
                    longer.setdefault(k, set()).add(piece[:k].replace(MARK, " ").encode())
                rank = max(0.0, -float(sp.get_score(i)))
                self.log[i] = -np.log(min(rank, 1e6) + SHIFT)
        self.size = np.array([len(x) for x in self.raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(self.raw), np.uint8)
        # by length in characters: pieces and beginnings of longer ones by the hash of their bytes, the ids (-1:
        # only a beginning), and whether a longer piece begins so
        self.table = {}
        for k in range(1, max(by_length, default=0) + 1):
            texts, ids = by_length.get(k, ([], []))
            begins = longer.get(k, set())
            only = sorted(begins.difference(texts))
            every = [*texts, *only]
            off = np.r_[0, np.cumsum([len(t) for t in every])].astype(np.int64)
            h = th.span_hash(np.frombuffer(b"".join(every), np.uint8), off[:-1], off[1:])
            order = np.argsort(h, kind="stable")
            self.table[k] = (Sorted(h[order]), np.r_[ids, np.full(len(only), -1)].astype(np.int64)[order],
                             np.array([t in begins for t in every], bool)[order])


class Sorted:
    """Sorted hashes with the place where each value of their leading bits begins: most look-ups take one step."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        bits = max(1, (4 * self.n).bit_length())
        self.shift = th.U64(64 - bits)
        self.begin = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.keys = np.r_[keys, ~th.U64(0)]  # ends every search

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``h`` are among the keys, their places)."""
        at = self.begin[h >> self.shift]
        key = self.keys[at]
        on = np.flatnonzero(key < h)
        while len(on):
            at[on] += 1
            key[on] = self.keys[at[on]]
            on = on[key[on] < h[on]]
        hit = np.flatnonzero((key == h) & (at < self.n))
        return hit, at[hit]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """Forward-filtered lattices of many units at once (flat UTF-8 bytes and offsets).

    A unit of n characters has n + 1 nodes, ``node0`` is its first.  The edges into a node are
    consecutive, ``first`` to ``last``; ``cum`` holds node number + cumulative probability.  ``back`` is
    an edge's length in characters, ``piece`` its id, or -1 for a character that is written as bytes."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, vocab: Vocabulary, alpha: float):
        n_units = len(off) - 1
        lead = np.flatnonzero((buf & 0xC0) != 0x80)
        stops = np.r_[lead, len(buf)]
        char0 = np.searchsorted(lead, off)  # first character of each unit
        unit = np.repeat(np.arange(n_units), np.diff(char0))
        chars = np.arange(len(lead))
        self.node0 = char0[:-1] + np.arange(n_units)
        node = chars + unit  # of the position before each character
        left = char0[1:][unit] - chars  # characters from here to the unit's end
        n_nodes = len(lead) + n_units
        scores = alpha * vocab.log
        count = np.zeros(n_nodes, np.int64)  # edges into each node
        found = []

        def add(c, k, ids, log):
            end = node[c] + k  # no node twice
            nth = count[end]
            count[end] = nth + 1
            found.append((end, nth, k, ids, log))

        single = np.zeros(len(lead), bool)
        spans = th.Spans(buf)
        c = chars
        for k in sorted(vocab.table):
            c = c[left[c] >= k]
            keys, ids, more = vocab.table[k]
            hit, at = keys.find(spans.hash(stops[c], stops[c + k]))
            c, i = c[hit], ids[at]
            whole = np.flatnonzero(i >= 0)
            if k == 1:
                single[c[whole]] = True
            add(c[whole], k, i[whole], scores[i[whole]])
            c = c[more[at]]
        c = chars[~single]
        width = (stops[c + 1] - stops[c]).astype(float)
        add(c, 1, -1, max(alpha, 0.01) * BYTE_PENALTY * width)
        # edges in order of the node they end in: each goes to its place, nothing is sorted
        first = np.cumsum(count) - count
        n_edges = int(count.sum())
        self.back, self.piece, start = (np.empty(n_edges, np.int64) for _ in range(3))
        log = np.empty(n_edges)
        while found:  # emptied on the way: these arrays are most of a task's memory
            end, nth, k, ids, score = found.pop()
            to = first[end] + nth
            self.back[to], self.piece[to], start[to], log[to] = k, ids, end - k, score
        # every node but a unit's first has an edge; by position: first nodes, second nodes and so on of all units
        position = np.arange(n_nodes) - np.repeat(self.node0, np.diff(char0) + 1)
        ends = np.flatnonzero(position)
        position = position[ends]
        longest = int(position.max(initial=0))
        ordered = np.argsort(position.astype(np.uint16) if longest < 1 << 16 else position, kind="stable")
        cuts = np.r_[0, np.cumsum(np.bincount(position, minlength=longest + 1)[1:])]
        by_position, size = ends[ordered], count[ends]
        n = size[ordered]
        head = np.cumsum(n) - n
        edges = np.repeat(first[by_position] - head, n) + np.arange(n_edges)
        came_from, weight = start[edges], log[edges]
        del start, log
        edge_cuts = np.r_[head, n_edges][cuts]
        total = np.zeros(n_nodes)
        v_all = np.empty(n_edges)
        for lo, hi, x, y in zip(cuts[:-1], cuts[1:], edge_cuts[:-1], edge_cuts[1:], strict=True):  # all units' nodes of one position
            v = total[came_from[x:y]] + weight[x:y]
            at = head[lo:hi] - x
            top = np.maximum.reduceat(v, at)
            total[by_position[lo:hi]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, n[lo:hi])), at))
            v_all[x:y] = v
        value = np.empty(n_edges)
        value[edges] = v_all
        del edges, v_all, came_from, weight
        end = np.repeat(ends, size)
        first = first[ends]
        p = np.exp(value - total[end])
        run = np.cumsum(p)
        run -= np.repeat(run[first] - p[first], size)
        run[first + size - 1] = 1.0
        self.cum = np.minimum(run, 1.0) + end
        # first and last edge into each node
        self.first, self.last = np.zeros((2, n_nodes), np.int64)
        self.first[ends], self.last[ends] = first, first + size - 1


def _unit_spans(buf: np.ndarray, off: np.ndarray):
    """Units: a run of spaces with what follows up to the next space.  They cover the whole text."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    space = buf == 32
    begins = np.zeros(n, bool)
    begins[1:] = space[1:] & ~space[:-1]
    begins[off[:-1][off[1:] > off[:-1]]] = True
    s = np.flatnonzero(begins)
    return s, np.r_[s[1:], n], np.searchsorted(off, s, "right") - 1


def encode(col: pa.Array, keys: np.ndarray, path: str, alpha: float = ALPHA, seed: int = SEED):
    """(ids, offsets): one sampled segmentation per text, drawn by its 64-bit key."""
    buf, off = th.flat(col)
    s, e, row = _unit_spans(buf, off)
    n = len(s)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(col) + 1, np.int64)
    vocab = vocabulary(path)
    _, first, which = np.unique(th.span_hash(buf, s, e), return_index=True, return_inverse=True)
    size = e[first] - s[first]
    to = np.cumsum(size) - size
    units = buf[np.repeat(s[first] - to, size) + np.arange(int(size.sum()))]
    lat = Lattices(units, np.r_[to, len(units)], vocab, alpha)
    lead = np.r_[0, np.cumsum((buf & 0xC0) != 0x80)]
    chars = lead[e] - lead[s]
    cum, back, piece = lat.cum, lat.back, lat.piece
    unit_no = np.arange(n) - np.searchsorted(row, row, "left")
    state = th.mix64(keys[row] ^ th.mix64(unit_no.astype(np.uint64) + th.U64(seed)))
    live, begin = np.arange(n), lat.node0[which]
    node = begin + chars
    drawn_unit, drawn_pos, drawn_edge, drawn_step = [], [], [], []
    step = 0
    while len(live):
        u = (th.mix64(state + th.U64(step + 1)) >> th.U64(11)).astype(np.float64) / 2.0 ** 53
        edge, last, drawn = lat.first[node], lat.last[node], node + u
        on = np.flatnonzero((cum[edge] <= drawn) & (edge < last))  # a node has few edges: step to the drawn one
        while len(on):
            edge[on] += 1
            on = on[(cum[edge[on]] <= drawn[on]) & (edge[on] < last[on])]
        node = node - back[edge]
        drawn_unit.append(live)
        drawn_pos.append(node - begin)
        drawn_edge.append(edge)
        drawn_step.append(np.full(len(live), step))
        on = np.flatnonzero(node > begin)
        live, begin, node, state = live[on], begin[on], node[on], state[on]
        step += 1
    # pieces are drawn from a unit's end to its start
    unit, pos, drawn_edges, steps = (np.concatenate(x) for x in (drawn_unit, drawn_pos, drawn_edge, drawn_step))
    drawn = np.bincount(unit, minlength=n)
    to = np.cumsum(drawn)[unit] - 1 - steps
    at, ids = np.empty((2, len(to)), np.int64)
    at[to], ids[to] = pos, piece[drawn_edges]
    unit = np.repeat(np.arange(n), drawn)
    width = np.ones(len(ids), np.int64)
    plain = ids < 0
    if plain.any():  # characters written as bytes: each becomes its UTF-8 length in pieces
        where = np.flatnonzero((buf & 0xC0) != 0x80)
        where = np.r_[where, len(buf)]
        c = lead[s[unit[plain]]] + at[plain]
        width[plain] = where[c + 1] - where[c]
        out = np.repeat(ids, width)
        to = np.cumsum(width) - width
        k = np.repeat(np.arange(plain.sum()), width[plain])
        j = np.arange(len(k)) - np.repeat(np.cumsum(width[plain]) - width[plain], width[plain])
        out[to[plain][k] + j] = vocab.byte[buf[where[c][k] + j]]
        ids = out
    per_row = np.bincount(np.repeat(row[unit], width), minlength=len(col))
    return ids, np.r_[0, np.cumsum(per_row)]


def decode_column(col: pa.Array, path: str) -> pa.Array:
    """The texts of a column of id lists."""
    v = vocabulary(path)
    at = col.offsets.to_numpy().astype(np.int64)
    ids = col.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(np.int64)
    size, to = v.size[ids], np.r_[0, np.cumsum(v.size[ids])]
    data = v.pool[np.repeat(v.start[ids] - to[:-1], size) + np.arange(int(to[-1]))]
    off = to[at - at[0]]
    return pa.Array.from_buffers(pa.large_string(), len(col), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)])


def decode(ids, path: str) -> str:
    return decode_column(pa.array([list(ids)], pa.list_(pa.int32())), path)[0].as_py()


def _keys(ids: pa.Array) -> np.ndarray:
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return th.mix64(known + np.where(ids.is_null().to_numpy(zero_copy_only=False), th.U64(1 << 63), th.U64(0)))


def sample_segmentations(docs: DataFrame, path: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """doc_id, ids (the sampled pieces of each text) and ids_crc32 (of little-endian 32-bit ids)."""
    path = path or model_path()

    def run(batches):
        for b in th.chunks(batches, "text", CHUNK_BYTES):
            ids, at = encode(b.column("text"), _keys(b.column("doc_id")), path, alpha, seed)
            ids = ids.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                 pa.array([zlib.crc32(ids[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)], pa.int64())],
                names=["doc_id", "ids", "ids_crc32"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>, ids_crc32 bigint")


def decode_segmentations(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` with a column ids, and the decoded text; a null list gives the empty text."""
    path = path or model_path()

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                c = b.slice(i, 1024)
                lists = c.column("ids")
                lists = pc.if_else(lists.is_null(), pa.array([[]], lists.type)[0], lists) if lists.null_count else lists
                yield pa.RecordBatch.from_arrays([*c.columns, decode_column(lists, path).cast(pa.string())],
                                                 names=[*c.schema.names, "text"])
    rest = rows.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(run, f"{schema}, text string")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of little-endian 32-bit ids), text_sha256 of the decoded text."""
    rows = decode_segmentations(sample_segmentations(documents(spark, sf_dir)))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids_crc32",
                       F.sha2("text", 256).alias("text_sha256"))
