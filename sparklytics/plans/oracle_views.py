"""DuckDB versions of the stand-in views (FIXTURES.md §4), as CTEs the oracle queries share.

They mirror ``sparklytics.sources`` formula by formula; the oracle SQL in ``oracle.py`` only
references the CTEs it needs (DuckDB does not evaluate the others).
"""

FILE_FLAT = """
file_flat AS (
  SELECT l_orderkey AS k,
         md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                       CAST(round(l_extendedprice * 100) AS BIGINT))) AS file_sha,
         CASE WHEN l_partkey % 97 = 0 THEN NULL
              ELSE 'src/f' || (l_partkey % 50)
                   || ['.java', '.scala', '.js', '.py', '.png', '', '.', '.test.js'][l_partkey % 8 + 1] END
           AS filename,
         CASE l_returnflag WHEN 'A' THEN 'added' WHEN 'R' THEN 'removed' ELSE 'modified' END AS status,
         CAST(l_quantity AS BIGINT) AS additions,
         CAST(l_linenumber * 6 AS BIGINT) AS deletions,
         CAST(l_quantity AS BIGINT) + CAST(l_linenumber * 6 AS BIGINT) AS changes
  FROM lineitem)"""

COMMIT_FLAT = """
commit_base AS (
  SELECT o_orderkey AS k,
         md5('c' || o_orderkey) AS sha,
         'own' || (20 + o_orderkey % 37) AS owner,
         'repo' || (o_orderkey % 11) AS repo,
         'own' || (o_custkey % 40) AS author,
         CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'GitHub' ELSE 'own' || (o_custkey % 40) END AS committer,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS cdate,
         (CASE WHEN o_orderkey % 9 = 0 THEN 'Oops, ' ELSE '' END)
           || repeat('Revert ', CAST(o_orderkey % 4 AS INTEGER)) || 'change ' || o_orderkey AS message
  FROM orders),
file_sums AS (
  SELECT k, sum(changes) AS s_total, sum(additions) AS s_add, sum(deletions) AS s_del, count(*) AS n_files
  FROM file_flat GROUP BY k),
commit_flat AS (
  SELECT c.k, c.sha, c.owner, c.repo, c.owner || '/' || c.repo AS full_name,
         'https://api.github.com/repos/' || c.owner || '/' || c.repo || '/commits/' || c.sha AS url,
         c.author, c.committer, c.cdate, c.cdate - to_seconds((c.k % 4) * 25200) AS adate, c.message,
         c.k % 10 <> 3 AS has_stats,
         CASE WHEN c.k % 10 <> 3 THEN CAST(coalesce(s.s_total, 0) AS BIGINT) END AS total,
         CASE WHEN c.k % 10 <> 3 THEN CAST(coalesce(s.s_add, 0) AS BIGINT) END AS additions,
         CASE WHEN c.k % 10 <> 3 THEN CAST(coalesce(s.s_del, 0) AS BIGINT) END AS deletions
  FROM commit_base c LEFT JOIN file_sums s ON c.k = s.k)"""

PARENT_FLAT = """
parent_flat AS (
  SELECT k AS child_k, md5('c' || k) AS child_sha, p AS parent_k, md5('c' || p) AS parent_sha
  FROM (SELECT o_orderkey AS k,
               CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey - 1 ELSE o_orderkey - 407 END AS p
        FROM orders
        UNION ALL
        SELECT o_orderkey AS k, o_orderkey - 814 AS p FROM orders WHERE o_orderkey % 17 = 0)
  WHERE p >= 0)"""

EVENT_COMMIT = """
ev_commit AS (
  SELECT event_id AS k, ts, md5('e' || event_id) AS sha,
         'repo' || (user_id % 12) AS repo, 'own' || ((user_id % 12) % 5) AS owner,
         'own' || ((user_id % 12) % 5) || '/' || 'repo' || (user_id % 12) AS full_name,
         'dev' || (user_id % 12) || '_' || least(event_id % 4, (user_id % 12) % 3 + 1) AS committer,
         CASE WHEN event_id % 10 = 3 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS stat_amount,
         CASE WHEN event_id % 97 = 0 THEN NULL
              ELSE 'src/f' || (user_id % 50)
                   || CASE event_type WHEN 'click' THEN '.java' WHEN 'view' THEN '.scala'
                                      WHEN 'purchase' THEN '.js' ELSE '.py' END END AS filename,
         CASE event_type WHEN 'signup' THEN 'added' WHEN 'error' THEN 'removed' ELSE 'modified' END AS status,
         CAST(floor(value) AS BIGINT) AS changes,
         CAST(floor(value) AS BIGINT) AS deletions,
         CAST(0 AS BIGINT) AS additions
  FROM events)"""

EVENT_GEO = """
ev_geo AS (
  SELECT md5('e' || event_id) AS sha,
         ts + to_minutes([-60, 30, 31, 0][event_id % 4 + 1]) AS created_at,
         'k' || (user_id % 6) AS continent
  FROM events)"""

# Access log: one line per event (FIXTURES.md §4.3).
ACCESS_LOG = """
access_log AS (
  SELECT event_id AS line_no,
         '10.0.' || (user_id % 5) || '.' || user_id || ' - - ['
           || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
           || CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END
           || ' /e/' || event_type || CASE WHEN event_id % 41 = 0 THEN ' odd' ELSE '' END || '?u=' || user_id || ' HTTP/1.1" '
           || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ' '
           || CASE WHEN event_id % 23 = 0 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
           AS line
  FROM events)"""

ERROR_LOG = """
error_log AS (
  SELECT event_id AS line_no,
         '[' || strftime(ts, '%a %b %d %H:%M:%S %Y') || '] [error] [client 10.0.' || (user_id % 5) || '.'
           || user_id || '] '
           || CASE WHEN event_id % 2 = 0 THEN 'File does not exist: /var/www/e/' || event_id
                   ELSE 'Invalid method in request ' || event_id END AS line
  FROM events WHERE event_type = 'error')"""

PARSED_LOG = """
parsed_log AS (
  SELECT line_no, line,
         string_split(line, ' ')[1] AS client,
         substr(string_split(line, ' ')[4], 2) AS time,
         replace(string_split(line, ' ')[6], '"', '') AS method,
         string_split(line, ' ')[7] AS path,
         string_split(line, ' ')[9] AS status,
         string_split(line, ' ')[10] AS size
  FROM access_log)"""

ORDER_LIST = """
order_items AS (
  SELECT l_orderkey AS list_id,
         md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                       CAST(round(l_extendedprice * 100) AS BIGINT))) AS item_key,
         CAST(l_quantity AS BIGINT) AS value,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS opt_value,
         l_linestatus AS grp, l_suppkey AS supp
  FROM lineitem),
order_list AS (
  SELECT list_id, list(value ORDER BY item_key) AS xs, list(opt_value ORDER BY item_key) AS oxs
  FROM order_items GROUP BY list_id)"""

ALL = {"file_flat": FILE_FLAT, "commit_flat": COMMIT_FLAT, "parent_flat": PARENT_FLAT,
       "ev_commit": EVENT_COMMIT, "ev_geo": EVENT_GEO, "access_log": ACCESS_LOG, "error_log": ERROR_LOG,
       "parsed_log": PARSED_LOG, "order_list": ORDER_LIST}
# which CTE blocks each block needs first
DEPENDS = {"commit_flat": ["file_flat"], "parsed_log": ["access_log"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTE blocks ``names`` (and what they depend on), in order."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",".join(ALL[n] for n in order) + "\n" + sql
