"""Operator 12 against a plain walk over byte offsets."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from sparklytics.llm import op12_alignment as op

from .helpers import corpus, frame, sort

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATHS = tuple(public_tokenizers.path(p) for p in (op.A_JSON, op.A_RANKS, op.B_MODEL))


@functools.cache
def plain():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[2])


def tokens(text):
    """(id, start, end) of both tokenizations, or none."""
    if not text:
        return [], []
    a, b = plain()
    pair = op.tokenizer_pair(*map(str, PATHS))
    out = []
    for ids, table in ((a.encode(" " + text, add_special_tokens=False).ids, pair.a_bytes), (b.encode(text), pair.b_bytes)):
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return [], []
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(table[i])))
            at += len(table[i])
        out.append(spans)
    return out


def expected(rows):
    docs, count = [], Counter()
    for i, t in rows:
        a, b = tokens(t)
        links, j0 = [], 0
        for x, s, e in a:
            while j0 < len(b) and b[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < e:
                links.append((x, b[j][0]))
                j += 1
        count.update(links)
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, x, y = [], 0, 0
        for e in common:
            own = [[], []]
            while x < len(a) and a[x][2] <= e:
                own[0].append(str(a[x][0]))
                x += 1
            while y < len(b) and b[y][2] <= e:
                own[1].append(str(b[y][0]))
                y += 1
            groups.append("|".join(",".join(o) for o in own))
        docs.append((i, len(a), len(b), groups, links))
    high = {}
    for (_, b), n in count.items():
        high[b] = max(high.get(b, 0), n)
    return [(i, na, nb, len(g), len(ls), sum(count[x] == high[x[1]] for x in ls), sum(count[x] for x in ls),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, ls in docs]


def got(spark, rows, **kw):
    return [tuple(r) for r in op.align(frame(spark, rows), **kw).select(COLUMNS).collect()]


ODD = [(1, "don't  stop<|endoftext|>now"), (2, "<s> </s> <unk> <0x0A>"), (3, "▁ a▁b"), (4, "naïve façade ﬁ № 日本語 🙂🙃"), (5, "á   x\x85y\xa0z"),
       (6, " leading and trailing "), (7, "\n\n\t tabs"), (8, "x" * 3000), (9, "\x00\x1c\x7f"), (9, "tie tie tie"), (9, "tie tie tie")]


@pytest.mark.parametrize("step", [7, 1 << 15])
def test_whole_operator(spark, step):
    rows = corpus(8, 40) + ODD
    assert sort(got(spark, rows, step=step, batch_steps=500 if step == 7 else op.BATCH_STEPS)) == sort(expected(rows))


def test_repeated_row_and_long_text_over_many_batches(spark):
    r = random.Random(2)
    long = "".join(r.choice(["the ", "and", "ing ", "été ", "zq", "\n"]) for _ in range(30_000))
    rows = [(1, long)] + [(2, "The same row in a third of the table.")] * 200 + [(3, "The same row")]
    assert sort(got(spark, rows, batch_steps=20_000)) == sort(expected(rows))


def test_empty_and_null_tables(spark):
    assert got(spark, []) == []
    assert sort(got(spark, [(None, None), (4, "")])) == sort([(None, 0, 0, 0, 0, 0, 0, ""), (4, 0, 0, 0, 0, 0, 0, "")])


def test_text_that_is_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert [tuple(r) for r in op.align(docs).select(COLUMNS).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_fast_form_gives_the_ids_of_the_json_form():
    r = random.Random(4)
    a, _ = plain()
    fast = op.tokenizer_pair(*map(str, PATHS)).fast
    for _ in range(3000):
        t = "".join(chr(r.choice([r.randrange(0x250), r.randrange(32, 127), 32, 10])) for _ in range(r.randrange(1, 30)))
        assert fast.encode_ordinary(" " + t) == a.encode(" " + t, add_special_tokens=False).ids


@pytest.mark.parametrize("step", [1, 2, 5, 64])
def test_merge_path_pieces_are_equal_and_whole(step):
    r = random.Random(step)
    for _ in range(50):
        n = r.randrange(2, 60)
        a, b = (np.array(sorted({*r.sample(range(1, n), r.randrange(1, n)), n})) for _ in range(2))
        i, j = op.merge_path(a, b, step)
        assert (np.diff(i + j)[:-1] == step).all() and (i[-1], j[-1]) == (len(a), len(b))
        links, common = [], []
        for k in range(len(i) - 1):
            x, y, end, ca, cb = op.overlaps(a, b, i[k], i[k + 1], j[k], j[k + 1])
            assert len(x) + len(ca) - sum(c < i[k] for c in ca) <= step * 2
            links += zip(x.tolist(), y.tolist(), end.tolist(), strict=True)
            common += zip(ca.tolist(), cb.tolist(), strict=True)
        sa, sb = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        assert sorted((x, y) for x, y, _ in links) == [(x, y) for x in range(len(a)) for y in range(len(b)) if sa[x] < b[y] and sb[y] < a[x]]
        assert sorted(common) == [(x, y) for x in range(len(a)) for y in range(len(b)) if a[x] == b[y]]
