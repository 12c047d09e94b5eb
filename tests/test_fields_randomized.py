"""Filename extension rules (D6) and repository identity against plain-Python definitions."""

import random

from pyspark.sql import functions as F

from sparklytics.functions import fields


def _b2(name):
    if name is None:
        return "unknown"
    base = name.rsplit("/", 1)[-1].rstrip(".")
    return base.rsplit(".", 1)[1] if "." in base else "unknown"


def _d5(name):
    return name.rsplit(".", 1)[-1] if "." in name else name


def test_extension_rules(spark):
    rnd = random.Random(5)
    alphabet = ["a", "b", ".", "/", "é", "_"]
    names = [None, "", ".", "..", "a.", ".a", "a/b.c/d", "x.tar.gz"]
    names += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r["i"]: (r["b2"], r["d5"]) for r in df.select(
        "i", fields.extension_or_unknown(F.col("n")).alias("b2"), fields.last_dot_part(F.col("n")).alias("d5")).collect()}
    for i, n in enumerate(names):
        assert got[i][0] == _b2(n), n
        if n is not None:
            assert got[i][1] == _d5(n), n


def test_repository_identity(spark):
    urls = ["https://api.github.com/repos/own/rep/commits/abc", "https://api.github.com/repos/a-b/c.d/commits/1",
            "https://example.org/nothing", None, "https://api.github.com/repos/x/y/commits"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [tuple(r) for r in df.select(fields.owner("url"), fields.repo("url"), fields.full_name("url")).collect()]
    assert got == [("own", "rep", "own/rep"), ("a-b", "c.d", "a-b/c.d"), (None, None, None), (None, None, None),
                   ("x", "y", "x/y")]
