"""Operator 5: exact deduplication against a persistent digest index (DataFrame functions only).

The index is a parquet table bucketed and sorted by digest, one row per distinct text ever seen:
``digest`` (SHA-256 of the text after lower-casing A-Z), ``keep_id`` and ``group_size`` of the batch
that brought it.  A batch of new rows is first reduced to one row per digest, anti-joined with the
index by sort-merge (the index side is neither shuffled nor, with one file per bucket, sorted) and
the digests that are new are appended.

Skew: the batch is reduced by (digest, salt) on the map side before it is reduced by digest, and
the way back from digest to row is a join on (digest, salt), so that a text that fills a third of
the table is spread over ``SALTS`` tasks.

Defined results: null text is the empty text; a null ``doc_id`` is smaller than any other and its
row stays only if its text has no row with an id; of repeated rows (same id and text) exactly one
stays; an empty batch gives no rows and leaves the index as it is; other columns are ignored.
A batch given again (a retry after a lost driver) gets the same answer, because the index
remembers which id stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, lower_az, parts, scratch, text_or_empty

SALTS = 64
COLUMNS = "digest binary, keep_id bigint, group_size bigint"


class DigestIndex:
    """The persistent index at ``path``; opened again (another session) it finds its bucket count."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        try:
            buckets = spark.read.parquet(f"{self.path}/layout").first()["buckets"]
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            buckets = buckets or parts(spark)
            spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{self.path}/layout")
        self.buckets = buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} ({COLUMNS}) USING parquet CLUSTERED BY (digest) "
                  f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/digests'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Appends digests that the index lacks: sort-merge anti-join, then a bucketed, sorted write.
        The rows leave the join partitioned like the buckets, so each task writes one file."""
        fresh = groups.join(self.rows().hint("merge"), "digest", "left_anti")
        (fresh.select("digest", "keep_id", "group_size").repartition(self.buckets, "digest")
         .write.insertInto(self.table))


def with_digest(docs: DataFrame) -> DataFrame:
    digest = F.unhex(F.sha2(lower_az(text_or_empty()), 256))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest.alias("digest"))


def exact_dedup(docs: DataFrame, index: DigestIndex, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size (in this batch), kept, text_sha256.

    ``keep_id`` is the id that stays of the equal texts: the largest of the batch that first
    brought the text.  Appends the batch's new digests to the index.
    """
    # 40 bytes a row, written once, so that the texts are read and hashed once
    salted = cut(with_digest(docs).withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(salts))), "digests")
    partial = salted.groupBy("digest", "salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = (partial.groupBy("digest")
              .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"),
                   F.collect_list("salt").alias("salts")))  # at most ``salts`` entries
    index.append(groups)
    known = index.rows().select("digest", F.col("keep_id").alias("index_id"))
    spread = (groups.join(known.hint("merge"), "digest")
              .select("digest", F.col("index_id").alias("keep_id"), "group_size", F.explode("salts").alias("salt")))
    one = Window.partitionBy("digest", "salt", "doc_id").orderBy(F.lit(0))
    return (salted.join(spread, ["digest", "salt"])
            .withColumn("copy", F.row_number().over(one))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, scratch(spark, "digest-index"))
    return exact_dedup(documents(spark, sf_dir), index)


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w
         AND row_number() OVER (PARTITION BY h, doc_id) = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)
"""
