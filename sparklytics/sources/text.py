"""Line- and document-shaped text inputs.

* ``read_lines``: text files as (file, line_key, value) where ``line_key`` orders the lines of
  all files (file, then split start, then position inside the split).  Large files stay split
  across tasks; no whole-file rows.
* ``read_documents``: whole files as (path, text), ordered by path (a book of chapters).
* ``access_log_lines`` / ``error_log_lines`` / ``book_documents``: the stand-ins over the
  driver's ``events`` and ``documents`` tables (FIXTURES.md §4.3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import require_utc
from .tables import read_table


def read_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """(file, line_key, value): one row per line; ``line_key`` orders lines across and within files."""
    df = spark.read.options(**options).text(path)
    key = F.struct(F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("pos"))
    return df.select(F.col("_metadata.file_path").alias("file"), key.alias("line_key"), "value")


def read_documents(spark: SparkSession, path: str, **options) -> DataFrame:
    df = spark.read.options(**options).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _client(uid):
    return F.concat(F.lit("10.0."), (uid % 5).cast("string"), F.lit("."), uid.cast("string"))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Common-Log-Format line per event: (line_no, value)."""
    require_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    uid, et = F.col("user_id"), F.col("event_type")
    method = F.when(et.isin("signup", "purchase"), F.lit("POST")).otherwise(F.lit("GET"))
    size = F.when(F.col("event_id") % 23 == 0, F.lit("-")).otherwise(
        F.floor(F.col("value")).cast("bigint").cast("string"))
    line = F.concat(_client(uid), F.lit(" - - ["),
                    F.date_format(F.col("ts"), "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
                    method, F.lit(" /e/"), et, F.when(F.col("event_id") % 41 == 0, F.lit(" odd")).otherwise(F.lit("")), F.lit("?u="), uid.cast("string"), F.lit(" HTTP/1.1\" "),
                    F.when(et == "error", F.lit("500")).otherwise(F.lit("200")), F.lit(" "), size)
    return ev.select(F.col("event_id").alias("line_no"), line.alias("value"))


def error_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apache-style error lines for the ``error`` events: (line_no, value)."""
    require_utc(spark)
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    k = F.col("event_id")
    msg = F.when(k % 2 == 0, F.concat(F.lit("File does not exist: /var/www/e/"), k.cast("string"))) \
        .otherwise(F.concat(F.lit("Invalid method in request "), k.cast("string")))
    line = F.concat(F.lit("["), F.date_format(F.col("ts"), "EEE MMM dd HH:mm:ss yyyy"),
                    F.lit("] [error] [client "), _client(F.col("user_id")), F.lit("] "), msg)
    return ev.select(k.alias("line_no"), line.alias("value"))


def book_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as a book: (doc_id, text), chapters in ``doc_id`` order."""
    return read_table(spark, sf_dir, "documents", "doc_id", "text")
