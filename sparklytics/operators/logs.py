"""

Line order is a column (``order``), never the physical row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.logparse import parse_access_log, size_bytes
from ..sources.files import list_files


def find_files_by_name(spark: SparkSession, root: str, name_contains: str = "_log") -> DataFrame:
    """Files under ``root`` whose name contains ``name_contains``, any case."""
    return list_files(spark, root, name_contains)


def lines_containing(lines: DataFrame, needle: str = K.MISSING_FILE_TEXT, value: str = "value") -> DataFrame:
    """Lines that contain ``needle`` literally."""
    return lines.filter(F.col(value).contains(needle))


def first_quoted_requests(lines: DataFrame, order: str, word: str = K.REQUEST_WORD, n: int = K.FIRST_REQUESTS,
                          value: str = "value") -> DataFrame:
    """The first ``n`` lines containing ``word``, reduced to the text between the first and
    the last double quote (quotes dropped)."""
    first = lines.filter(F.col(value).contains(word)).orderBy(order).limit(n)
    return first.select(order, F.regexp_extract(F.col(value), r'"(.*)"', 1).alias("request"))


def post_requests(lines: DataFrame, value: str = "value") -> DataFrame:
    """(time, client, path, status, size) of POST requests (method field, D19)."""
    p = parse_access_log(lines, value).filter(F.col("method") == K.POST_METHOD)
    return p.select("time", "client", "path", F.col("status").try_cast("int").alias("status"),
                    size_bytes(F.col("size")).alias("size"))


def largest_post_response(lines: DataFrame, value: str = "value") -> DataFrame:
    """E5: (client, path) of the POST with the largest response (``-`` counts 0); ties by client, path desc."""
    p = post_requests(lines, value)
    return (p.orderBy(F.coalesce("size", F.lit(0)).desc(), F.col("client").desc(), F.col("path").desc())
            .limit(1).select("client", "path"))


def top_post_client(lines: DataFrame, value: str = "value") -> DataFrame:
    """(requests, client) of the client with most POST requests; ties by client desc."""
    p = post_requests(lines, value)
    per = p.groupBy("client").agg(F.count(F.lit(1)).alias("requests"))
    return per.orderBy(F.col("requests").desc(), F.col("client").desc()).limit(1).select("requests", "client")


def access_log_to_csv(lines: DataFrame, value: str = "value") -> DataFrame:
    """Client,Time,Type,Path,Status,Size as text columns, quotes and '[' removed."""
    p = parse_access_log(lines, value)
    return p.select(F.col("client").alias("Client"), F.col("time").alias("Time"),
                    F.col("method").alias("Type"), F.col("path").alias("Path"),
                    F.col("status").alias("Status"), F.col("size").alias("Size"))


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """CSV sink for E7 (no header, like the shell version); an existing folder is an error unless ``mode`` says otherwise."""
    df.write.mode(mode).option("header", header).csv(path)
