"""Access-log fields by whitespace position (Common Log Format), like ``awk '{print $n}'``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _field(parts: Column, i: int) -> Column:
    return F.get(parts, i - 1)  # 1-based like awk; null past the end


FIELDS = ("client", "time", "zone", "method", "path", "protocol", "status", "size")


def parse_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds client, time (``dd/MMM/yyyy:HH:mm:ss``, raw text), zone, method, path, protocol,
    status and size (raw text, may be ``-``) to each line."""
    parts = F.split(F.trim(F.col(value)), r"\s+")
    keep = [c for c in lines.columns if c not in FIELDS]  # parsed fields replace same-named columns
    return lines.select(
        *keep,
        _field(parts, 1).alias("client"),
        F.regexp_replace(_field(parts, 4), r"^\[", "").alias("time"),
        F.regexp_replace(_field(parts, 5), r"\]$", "").alias("zone"),
        F.regexp_replace(_field(parts, 6), '"', "").alias("method"),
        _field(parts, 7).alias("path"),
        F.regexp_replace(_field(parts, 8), '"', "").alias("protocol"),
        _field(parts, 9).alias("status"),
        _field(parts, 10).alias("size"),
    )


def size_bytes(size: Column) -> Column:
    """Response size as bigint; ``-`` (no body) and junk become null."""
    return F.when(size.rlike(r"^[0-9]+$"), size.try_cast("bigint"))
