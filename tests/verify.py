"""Compare a catalogue query with its DuckDB oracle (row count, column names, order-free values)."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def canonical(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    ocols = rel.columns
    if sorted(cols) != sorted(ocols):
        return False, f"columns {cols} vs {ocols}"
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    a, b = canonical(srows), canonical(orows)
    if a == b:
        return True, f"{len(a)} rows"
    sa, sb = set(a), set(b)
    return False, f"spark {len(a)} vs duckdb {len(b)} rows; spark only {list(sa - sb)[:2]}; duckdb only {list(sb - sa)[:2]}"
