"""List expressions against plain-Python definitions on random lists (empty lists and nulls included)."""

import random

from pyspark.sql import functions as F

from sparklytics.operators import lists as L


def _py(xs, oxs):
    defined = [x for x in oxs if x is not None]
    above = [x for x in xs if x > 25][:3]
    div7 = [x for x in xs if x % 7 == 0]
    fl = 7
    for x in xs:
        fl = (fl * 31 + x) % 1_000_000_007
    fr = 7
    for x in reversed(xs):
        fr = (fr * 31 + x) % 1_000_000_007
    return {
        "m": [x + 1 for x in xs], "f": [x for x in xs if x > 25], "n": xs[:3],
        "mx": max(xs) if xs else None, "s": sum(xs), "sd": sum(defined),
        "d7": div7[0] if div7 else None, "ev": [x for x in defined if x % 2 == 0],
        "avg": sum(above) // len(above) if above else None,
        "s10": sum([x for x in xs if x > 25][:10]),
        "z": [(a, b) for a, b in zip(xs, xs[1:])], "fl": fl, "fr": fr,
        "hst": bool(xs) and xs[0] == sum(xs[1:]),
    }


def test_list_expressions_match_python(spark):
    rnd = random.Random(11)
    data = []
    for i in range(400):
        n = rnd.choice([0, 1, 2, 3, 5, 8, 13])
        xs = [rnd.randint(-5, 60) for _ in range(n)]
        oxs = [x if rnd.random() > 0.3 else None for x in xs]
        data.append((i, xs, oxs))
    df = spark.createDataFrame(data, "id int, xs array<int>, oxs array<int>")
    mod = 1_000_000_007
    out = df.select(
        "id",
        L.array_map("xs", lambda x: x + 1).alias("m"), L.array_filter("xs", lambda x: x > 25).alias("f"),
        L.array_first_n("xs", 3).alias("n"), L.list_max("xs").alias("mx"), L.list_sum("xs").alias("s"),
        L.list_sum_defined("oxs").alias("sd"), L.list_first_divisible("xs", 7).alias("d7"),
        L.list_even_defined("oxs").alias("ev"), L.list_avg_first_n_above("xs", 25, 3).alias("avg"),
        L.list_sum_first_n_above("xs", 10, 25).alias("s10"),
        L.array_zip_shortest("xs", F.slice("xs", 2, F.greatest(F.size("xs"), F.lit(1)))).alias("z"),
        L.array_fold_left("xs", F.lit(7).cast("bigint"), lambda a, x: (a * 31 + x) % mod).alias("fl"),
        L.array_fold_right("xs", F.lit(7).cast("bigint"), lambda x, a: (a * 31 + x) % mod).alias("fr"),
        ((F.size("xs") >= 1) & (F.get("xs", 0).cast("bigint") == L.list_sum(F.slice("xs", 2, F.size("xs")))))
        .alias("hst"),
    )
    by_id = {r["id"]: r for r in out.collect()}
    for i, xs, oxs in data:
        want = _py(xs, oxs)
        got = by_id[i].asDict()
        got["z"] = [tuple(p) for p in got["z"]]
        got["hst"] = bool(got["hst"])
        for k, v in want.items():
            assert got[k] == v, (k, xs, oxs, got[k], v)
