"""Explicit schemas for the nested records (no schema inference at scale)."""

from pyspark.sql import types as T

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMMIT_USER = _struct(("name", _S), ("email", _S), ("date", _TS))
ACCOUNT = _struct(("id", _L), ("login", _S), ("avatar_url", _S), ("type", _S), ("site_admin", _B))
STATS = _struct(("total", _L), ("additions", _L), ("deletions", _L))
FILE = _struct(("sha", _S), ("filename", _S), ("status", _S), ("additions", _L), ("deletions", _L),
               ("changes", _L), ("blob_url", _S), ("raw_url", _S), ("contents_url", _S), ("patch", _S))
PARENT = _struct(("sha", _S))
VERIFICATION = _struct(("verified", _B), ("reason", _S), ("signature", _S), ("payload", _S))
COMMIT_BODY = _struct(("author", COMMIT_USER), ("committer", COMMIT_USER), ("message", _S),
                      ("tree", _struct(("sha", _S))), ("comment_count", _L), ("verification", VERIFICATION))

COMMIT = _struct(
    ("_id", _S), ("node_id", _S), ("sha", _S), ("url", _S),
    ("commit", COMMIT_BODY),
    ("author", ACCOUNT), ("committer", ACCOUNT),
    ("parents", T.ArrayType(PARENT, True)),
    ("stats", STATS),
    ("files", T.ArrayType(FILE, True)),
)

COMMIT_GEO = _struct(("sha", _S), ("createdAt", _TS), ("continent", _S))
