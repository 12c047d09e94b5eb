"""Small corpora and plain-Python definitions for brute-force checks."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside; inputs with such columns must work.
CLASHES = ["batch", "shard", "digest", "salt", "rid", "tid", "n", "row", "kept_text", "own_0", "score", "n_removed", "kept",
           "deal", "ord", "p", "token", "first", "piece", "length"]


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return WORD.findall(t or "")


def frame(spark, rows, clashes=True):
    """(doc_id, text) rows with lang, source, n_chars and clashing extra columns, over several partitions."""
    names = ["doc_id", "text", "lang", "source", "n_chars", *(CLASHES if clashes else [])]
    data = [(i, t, "en" if i else None, f"s{(i or 0) % 3}", None if t is None else len(t), *(["x"] * (len(names) - 5))) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in names[5:]) if clashes else "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


def corpus(seed=1, n=60, vocabulary=120, lines=True):
    """Texts with exact copies, near copies, shared passages and shared runs of lines, and odd ones."""
    r = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in ("Ba", "ré", "to", "mi") for b in ("n", "lo", "日") for c in range(vocabulary // 12)]

    def line(k):
        return " ".join(r.choice(vocab) for _ in range(k))
    shared = "\n".join(line(8) for _ in range(4))
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and i > 6:
            t = rows[i - 3][1]
        elif kind == 2 and i > 6:
            w = rows[i - 5][1].split(" ")
            for _ in range(2):
                w[r.randrange(len(w))] = r.choice(vocab)
            t = " ".join(w)
        elif kind == 3:
            t = line(5) + "\n" + shared + "\n" + line(r.randrange(1, 40))
        else:
            t = "\n".join(line(r.randrange(1, 14)) for _ in range(r.randrange(1, 9)))
        rows.append((i * 3, t))
    w = line(400)
    rows += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "one"), (1004, "ONE"), (1005, "a\n\nb\n\n"), (1006, w), (1007, w.upper()),
             (1008, "x" * 20_000), (1009, (line(6) + "\n") * 300), (None, shared), (None, None), rows[3], rows[3]]
    r.shuffle(rows)
    return rows


def sort(rows):
    return sorted(rows, key=repr)
