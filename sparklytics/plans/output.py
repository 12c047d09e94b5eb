"""Flat, engine-neutral result shapes for the driver's comparison.

Library operators return proper arrays / structs / zoned timestamps; the catalogue flattens
them: integers widen to bigint, timestamps become zone-less UTC wall clock (DuckDB TIMESTAMP),
string arrays become sorted-as-given comma-joined text, structs become columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
