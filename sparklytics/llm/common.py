"""Helpers shared by the training-data operators (DataFrame side)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is the same (and quicker) on pure ASCII text."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes the rows to the shared folder and reads them back."""
    return written(df, scratch(df.sparkSession, name))


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage: Spark deletes the shuffle files of finished jobs only then, and a driver
    that has little to do may not collect any for hours, while the files of all jobs before add up.  Reports of
    finished jobs that listeners have not read yet still hold their plans, so they are waited for; the first
    collection frees what holds the last job, the second its files."""
    sc = spark.sparkContext
    try:
        sc._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    except Py4JJavaError:  # listeners are slow: files may stay until the next call
        pass
    for _ in range(2):
        sc._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def one_row_each(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row of each ``key``: the one of the smallest text hash, then of the smallest columns.  Reduced
    before the shuffle, so a key with many rows is one row of each task."""
    rest = [c for c in rows.columns if c not in key]
    first = F.min(F.struct(F.xxhash64("text").alias("text_hash"), *rest)).alias("first")
    return rows.groupBy(*key).agg(first).select(*key, *[f"first.{c}" for c in rest])


def with_group_first(rows: DataFrame, key: list[str], order: list[str], salts: int = 64, singles: bool = False) -> DataFrame:
    """Rows whose ``key`` occurs more than once (all rows with ``singles``), with ``first`` (the smallest ``order`` struct of the
    key) and ``n_rows``.  Rows are reduced by (key, salt) before they are reduced by key, and the
    result goes back to the rows by (key, salt): a key that holds a third of all rows is spread over
    ``salts`` tasks both ways.  The salt is a hash of the ordering columns."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    partial = salted.groupBy(*key, "salt").agg(F.min(F.struct(*order)).alias("first"), F.count(F.lit(1)).alias("salt_rows"))
    groups = (partial.groupBy(*key)
              .agg(F.min("first").alias("first"), F.sum("salt_rows").alias("n_rows"), F.collect_list("salt").alias("salts"))
              .filter(F.lit(singles) | (F.col("n_rows") > 1)).select(*key, "first", "n_rows", F.explode("salts").alias("salt")))
    return salted.join(groups, [*key, "salt"]).drop("salt")
