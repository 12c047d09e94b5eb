"""Commit-shaped inputs.

* ``read_commits`` reads real commit JSON (one document per line, or multi-line) with an
  explicit schema.
* ``commit_view`` / ``event_commit_view`` / ``geo_view`` derive the same nested shape from
  the driver's tables (``orders`` + ``lineitem``, ``events``), so every operator runs on
  data whose size grows with the scale factor.  Formulas are listed in FIXTURES.md §4.

The views are plain projections and one aggregate-join; Catalyst removes the
``lineitem`` side when a query reads neither ``files`` nor ``stats``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import require_utc
from .tables import read_table

# Fixed values of the stand-in binding (FIXTURES.md §4): file extensions by part key % 8,
# event type -> extension / status, geo offsets in minutes by event id % 4.
FILE_EXTENSIONS = [".java", ".scala", ".js", ".py", ".png", "", ".", ".test.js"]
EVENT_EXTENSIONS = {"click": ".java", "view": ".scala", "purchase": ".js"}  # others: .py
EVENT_STATUS = {"signup": "added", "error": "removed"}  # others: modified
GEO_OFFSET_MINUTES = [-60, 30, 31, 0]
API_PREFIX = "https://api.github.com/repos/"


TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX"
CORRUPT = "_corrupt_record"
OID_RE = r'"\$oid"\s*:\s*"([^"]*)"'


def _json(reader, schema: T.StructType, quarantine: bool):
    """A broken document stops the read, or with ``quarantine`` is a row of nulls with its text in
    ``_corrupt_record``."""
    if not quarantine:
        return reader.schema(schema).option("mode", "FAILFAST").option("timestampFormat", TIMESTAMPS)
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("timestampFormat", TIMESTAMPS))


def plain_id(commits: DataFrame) -> DataFrame:
    """``_id`` as the plain object id: exports write it as ``{"$oid": "..."}``."""
    oid = F.regexp_extract("_id", OID_RE, 1)
    return commits.withColumn("_id", F.when(oid != "", oid).otherwise(F.col("_id")))


def read_commits(spark: SparkSession, path: str, multi_line: bool = False, infer_schema: bool = False,
                 quarantine: bool = False) -> DataFrame:
    """Commit JSON with the explicit schema of §1.2 and a plain ``_id``; broken documents fail, or are
    kept apart with ``quarantine``.

    ``infer_schema=True`` lets Spark infer the schema instead (an extra full pass over the data,
    and types follow the data: avoid at scale)."""
    require_utc(spark)
    if infer_schema:
        return (spark.read.option("multiLine", multi_line).option("timestampFormat", TIMESTAMPS)
                .option("inferTimestamp", True).json(path))
    return plain_id(_json(spark.read, schemas.COMMIT, quarantine).option("multiLine", multi_line).json(path))


def read_geo(spark: SparkSession, path: str, quarantine: bool = False) -> DataFrame:
    """Commit-geo JSON lines: (sha, createdAt, continent)."""
    require_utc(spark)
    return _json(spark.read, schemas.COMMIT_GEO, quarantine).json(path)


def read_geo_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    quarantine: bool = False) -> DataFrame:
    """Streaming commit-geo JSON lines from a directory."""
    require_utc(spark)
    r = _json(spark.readStream, schemas.COMMIT_GEO, quarantine)
    return (r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r).json(path)


MONTH_COLUMN = "commit_month"  # partition column of stored commit tables: committer month, yyyy-MM


def write_commit_table(commits: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store nested commits as parquet partitioned by committer month.

    Rows are range-partitioned on the commit time first, so each writer covers a narrow time
    span (few files per month) and a very busy month is split across writers; inside a file rows
    are sorted by sha, which keeps row-group statistics useful for sha lookups."""
    month = F.date_format(F.col("commit.committer.date"), "yyyy-MM")
    (commits.withColumn("_t", F.col("commit.committer.date")).repartitionByRange("_t")
     .withColumn(MONTH_COLUMN, month).sortWithinPartitions(MONTH_COLUMN, "sha").drop("_t")
     .write.mode(mode).partitionBy(MONTH_COLUMN).parquet(path))


def read_commit_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``write_commit_table`` (the month column comes from the folder names)."""
    require_utc(spark)
    return spark.read.option("basePath", path).parquet(path)


def read_commit_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       quarantine: bool = False) -> DataFrame:
    """Streaming commit JSON lines from a directory; ids and broken documents as in ``read_commits``."""
    require_utc(spark)
    r = _json(spark.readStream, schemas.COMMIT, quarantine)
    return plain_id((r.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else r).json(path))


def _str(c: Column) -> Column:
    return c.cast("string")


def _user(name: Column, date: Column) -> Column:
    return F.struct(name.alias("name"),
                    F.concat(name, F.lit("@users.noreply.github.com")).alias("email"),
                    date.alias("date"))


def _commit_struct(sha: Column, url: Column, author: Column, author_date: Column,
                   committer: Column, committer_date: Column, message: Column,
                   parents: Column, stats: Column, files: Column) -> dict[str, Column]:
    body = F.struct(
        _user(author, author_date).alias("author"),
        _user(committer, committer_date).alias("committer"),
        message.alias("message"),
        F.struct(sha.alias("sha")).alias("tree"),
        F.lit(0).cast("bigint").alias("comment_count"),
        F.struct(F.lit(False).alias("verified"), F.lit("unsigned").alias("reason"),
                 F.lit(None).cast("string").alias("signature"),
                 F.lit(None).cast("string").alias("payload")).alias("verification"))
    account = lambda n: F.struct(F.lit(None).cast("bigint").alias("id"), n.alias("login"),
                                 F.lit(None).cast("string").alias("avatar_url"),
                                 F.lit("User").alias("type"), F.lit(False).alias("site_admin"))
    return {"_id": F.lit(None).cast("string"), "node_id": F.base64(sha), "sha": sha, "url": url, "commit": body,
            "author": account(author), "committer": account(committer), "parents": parents, "stats": stats,
            "files": files}


def _named(cols: dict[str, Column], drop: tuple[str, ...] = ()) -> list[Column]:
    return [c.alias(n) for n, c in cols.items() if n not in drop]


def _file_struct(sha, filename, status, additions, deletions, changes) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(sha.alias("sha"), filename.alias("filename"), status.alias("status"),
                    additions.alias("additions"), deletions.alias("deletions"), changes.alias("changes"),
                    none.alias("blob_url"), none.alias("raw_url"), none.alias("contents_url"),
                    none.alias("patch"))


def _sha(prefix: str, k: Column) -> Column:
    return F.md5(F.concat(F.lit(prefix), _str(k)))


def lineitem_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file record per ``lineitem`` row: (l_orderkey, file struct)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_returnflag")
    pk = F.col("l_partkey")
    ext = F.element_at(F.array(*[F.lit(e) for e in FILE_EXTENSIONS]), (pk % 8 + 1).cast("int"))
    filename = F.when(pk % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("src/f"), _str(pk % 50), ext))
    fsha = F.md5(F.concat_ws("|", *[_str(F.col(c)) for c in ("l_orderkey", "l_partkey", "l_suppkey",
                                                                "l_linenumber")],
                             _str(F.round(F.col("l_extendedprice") * 100).cast("bigint"))))
    status = (F.when(F.col("l_returnflag") == "A", "added")
              .when(F.col("l_returnflag") == "R", "removed").otherwise("modified"))
    adds = F.col("l_quantity").cast("bigint")
    dels = (F.col("l_linenumber") * 6).cast("bigint")
    return li.select("l_orderkey", _file_struct(fsha, filename, status, adds, dels, adds + dels).alias("file"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")


def _order_commit(stats: Column, files: Column) -> dict[str, Column]:
    """The commit columns of one ``orders`` row (FIXTURES.md §4.1), with the given stats/files."""
    k = F.col("o_orderkey")
    sha = _sha("c", k)
    owner = F.concat(F.lit("own"), _str(k % 37 + 20))
    repo = F.concat(F.lit("repo"), _str(k % 11))
    url = F.concat(F.lit(API_PREFIX), owner, F.lit("/"), repo, F.lit("/commits/"), sha)
    author = F.concat(F.lit("own"), _str(F.col("o_custkey") % 40))
    committer = F.when(k % 211 == 0, F.lit(None).cast("string")).when(k % 5 == 0, F.lit("GitHub")).otherwise(author)
    cdate = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + (k * 7919) % 86400)
    adate = F.timestamp_seconds(F.unix_seconds(cdate) - (k % 4) * 25200)
    message = F.concat(F.when(k % 9 == 0, F.lit("Oops, ")).otherwise(F.lit("")),
                       F.repeat(F.lit("Revert "), (k % 4).cast("int")), F.lit("change "), _str(k))
    p1 = F.when(k % 13 == 0, k - 1).otherwise(k - 407)
    p2 = F.when(k % 17 == 0, k - 814)
    parents = F.transform(F.filter(F.array(p1, p2), lambda p: p >= 0),
                          lambda p: F.struct(_sha("c", p).alias("sha")))
    return _commit_struct(sha, url, author, adate, committer, cdate, message, parents, stats, files)


def commit_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch commits: one per ``orders`` row, files from its ``lineitem`` rows (§4.1)."""
    require_utc(spark)
    o = _orders(spark, sf_dir)
    files = (lineitem_files(spark, sf_dir)
             .groupBy("l_orderkey")
             # files ordered by file sha: the struct's first field
             .agg(F.sort_array(F.collect_list("file")).alias("files"),
                  F.sum("file.changes").alias("_tot"), F.sum("file.additions").alias("_add"),
                  F.sum("file.deletions").alias("_del")))
    j = o.join(files, o.o_orderkey == files.l_orderkey, "left")
    k = F.col("o_orderkey")
    stats = F.when(k % 10 != 3, F.struct(
        F.coalesce(F.col("_tot"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.col("_add"), F.lit(0)).cast("bigint").alias("additions"),
        F.coalesce(F.col("_del"), F.lit(0)).cast("bigint").alias("deletions")))
    file_list = F.coalesce(F.col("files"), F.array().cast("array<" + schemas.FILE.simpleString() + ">"))
    return j.select(*_named(_order_commit(stats, file_list)))


def commit_stats_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per commit and file with the committer (``commit``) and the file's share of the commit's
    ``stats`` (null without stats): sums per committer equal those over ``commit_view``, a filter on
    commit columns reaches the orders before anything is joined or summed."""
    require_utc(spark)
    o = _orders(spark, sf_dir)
    f = lineitem_files(spark, sf_dir)
    j = o.join(f, o.o_orderkey == f.l_orderkey, "left")
    stats = F.when(F.col("o_orderkey") % 10 != 3, F.struct(
        F.col("file.changes").alias("total"), F.col("file.additions").alias("additions"),
        F.col("file.deletions").alias("deletions")))
    return j.select(*_named(_order_commit(stats, F.lit(None)), drop=("files",)))


def commit_file_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per committed file: the commit columns (without ``stats``/``files``) plus ``file``.

    Equal to exploding ``commit_view``'s ``files``, but built as a plain join of ``lineitem`` with
    its order, so file-level analytics skip gathering and re-exploding per-commit arrays."""
    require_utc(spark)
    o = _orders(spark, sf_dir)
    f = lineitem_files(spark, sf_dir)
    j = f.join(o, f.l_orderkey == o.o_orderkey)
    return j.select(*_named(_order_commit(F.lit(None), F.lit(None)), drop=("stats", "files")), "file")


def _event_commit_columns(ev: DataFrame) -> DataFrame:
    k = F.col("event_id")
    u = F.col("user_id") % 12
    sha = _sha("e", k)
    repo = F.concat(F.lit("repo"), _str(u))
    owner = F.concat(F.lit("own"), _str(u % 5))
    url = F.concat(F.lit(API_PREFIX), owner, F.lit("/"), repo, F.lit("/commits/"), sha)
    committer = F.concat(F.lit("dev"), _str(u), F.lit("_"), _str(F.least(k % 4, u % 3 + 1)))
    amount = F.floor(F.col("value")).cast("bigint")
    stats = F.when(k % 10 != 3, F.struct(amount.alias("total"), amount.alias("additions"),
                                         amount.alias("deletions")))
    et = F.col("event_type")
    ext = F.lit(".py")
    for t, e in reversed(list(EVENT_EXTENSIONS.items())):
        ext = F.when(et == t, F.lit(e)).otherwise(ext)
    status = F.lit("modified")
    for t, s in EVENT_STATUS.items():
        status = F.when(et == t, F.lit(s)).otherwise(status)
    filename = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("src/f"), _str(F.col("user_id") % 50), ext))
    fsha = _sha("f", k)
    files = F.array(_file_struct(fsha, filename, status, F.lit(0).cast("bigint"), amount, amount))
    ts = F.col("ts").cast("timestamp")
    return ev.select(*_named(_commit_struct(sha, url, committer, ts, committer, ts,
                                            F.concat(F.lit("event "), _str(k)),
                                            F.array().cast("array<struct<sha:string>>"), stats, files)))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    require_utc(spark)
    return read_table(spark, sf_dir, "events")


def event_commit_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream commits: one per ``events`` row, one file each (§4.2)."""
    return _event_commit_columns(_events(spark, sf_dir))


def events_to_commits(events: DataFrame) -> DataFrame:
    """The §4.2 projection on any (static or streaming) ``events``-shaped DataFrame."""
    return _event_commit_columns(events)


def events_to_geo(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    offs = F.element_at(F.array(*[F.lit(m) for m in GEO_OFFSET_MINUTES]), (k % 4 + 1).cast("int"))
    created = F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), offs)
    return events.select(_sha("e", k).alias("sha"), created.alias("createdAt"),
                         F.concat(F.lit("k"), _str(F.col("user_id") % 6)).alias("continent"))


def geo_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit-geo events: (sha, createdAt, continent), createdAt near the commit's time (§4.2)."""
    return events_to_geo(_events(spark, sf_dir))
