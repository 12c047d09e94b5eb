"""File listing as a DataFrame (no file contents read)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _ci_glob(fragment: str) -> str:
    out = []
    for ch in fragment:
        if ch.isalpha():
            out.append(f"[{ch.lower()}{ch.upper()}]")
        elif ch in "*?[]{}\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "*" + "".join(out) + "*"


def list_files(spark: SparkSession, root: str, name_contains: str) -> DataFrame:
    """(path, length, modificationTime) of files under ``root`` whose name contains
    ``name_contains`` in any case.  Spark file sources skip names starting with '_' or '.'."""
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", _ci_glob(name_contains))
          .load(root))
    return df.select("path", "length", "modificationTime")  # content is never requested

