"""Derived commit fields, computed once and null-safe.

Repository identity comes from the API url ``https://api.github.com/repos/<owner>/<repo>/commits/<sha>``.
An url that does not have that shape gives null (never the url itself).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

_URL_RE = r"/repos/([^/]+/[^/]+)/commits(/|$)"


def _u(url) -> Column:
    return F.col(url) if isinstance(url, str) else url


def full_name(url: Column | str = "url") -> Column:
    """``owner/repo`` from the url: one regex evaluation; owner and repo are cut from it."""
    return F.nullif(F.regexp_extract(_u(url), _URL_RE, 1), F.lit(""))


def owner(url: Column | str = "url") -> Column:
    return F.substring_index(full_name(url), "/", 1)


def repo(url: Column | str = "url") -> Column:
    return F.substring_index(full_name(url), "/", -1)


def repo_key(url: Column | str = "url", use_full_name: bool = False) -> Column:
    """Repository key: name only (the batch families), or ``owner/repo``."""
    return full_name(url) if use_full_name else repo(url)


def last_dot_part(filename: Column) -> Column:
    """Text after the last '.', or the whole name if it has none (collection / stream families)."""
    return F.substring_index(filename, ".", -1)


def extension_or_unknown(filename: Column) -> Column:
    """Extension of the base name with trailing dots removed; ``unknown`` without one."""
    base = F.regexp_replace(F.substring_index(filename, "/", -1), r"\.+$", "")
    return F.when(base.contains("."), F.substring_index(base, ".", -1)).otherwise(F.lit(K.UNKNOWN_EXTENSION))


def stat(field: str, stats: Column | str = "stats") -> Column:
    """A stats counter with absent stats counted as 0."""
    s = F.col(stats) if isinstance(stats, str) else stats
    return F.coalesce(s.getField(field), F.lit(0).cast("bigint"))


def file_rows(commits: DataFrame) -> DataFrame:
    """One row per committed file with its commit's columns and a ``file`` struct.

    Accepts nested commits (explodes ``files``) or a DataFrame that already has one ``file`` per
    row (e.g. ``sources.commits.commit_file_view``); unused commit columns are pruned by Catalyst."""
    if "file" in commits.columns:
        return commits
    keep = [c for c in commits.columns if c not in ("files",)]
    return commits.select(*keep, F.explode("files").alias("file"))


def keep_names(df: DataFrame, column: str, names: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in ``names``: a plain list becomes an ``isin`` that reaches the scan; a
    DataFrame of names (its first column) a left-semi join that Spark plans by its size."""
    if isinstance(names, DataFrame):
        wanted = names.select(F.col(names.columns[0]).alias("_wanted"))
        return df.join(wanted, df[column] == F.col("_wanted"), "left_semi")
    return df.filter(F.col(column).isin(list(dict.fromkeys(names))))
