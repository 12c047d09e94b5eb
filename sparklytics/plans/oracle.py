"""DuckDB oracle SQL, one per catalogue key (same column names as the Spark results)."""

from __future__ import annotations

import datetime as _dt

from . import catalog as cat
from .oracle_views import with_views


def _in_list(names) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


_SNAP = int(_dt.datetime.fromisoformat(cat.SNAPSHOT.replace("Z", "+00:00")).timestamp())

# md5 long id (B11) in DuckDB: top 64 bits of the v3 name UUID of md5(x) without leading zeros.
_ID = ("CAST(CAST(CAST('0x' || substr(md5(ltrim(md5({x}), '0')), 1, 12) || '3' || "
       "substr(md5(ltrim(md5({x}), '0')), 14, 3) AS UBIGINT) AS HUGEINT) - CASE WHEN "
       "substr(md5(ltrim(md5({x}), '0')), 1, 1) >= '8' THEN CAST(18446744073709551616 AS HUGEINT) ELSE 0 END "
       "AS BIGINT)")

_B2_EXT = r"""CASE WHEN b IS NOT NULL AND contains(b, '.') THEN regexp_extract(b, '\.([^.]*)$', 1)
                   ELSE 'unknown' END"""
_LAST_DOT = r"CASE WHEN contains(filename, '.') THEN regexp_extract(filename, '\.([^.]*)$', 1) ELSE filename END"

ORACLE: dict[str, str] = {
    # ---- A ----
    "commits_by_authors": with_views(f"""
SELECT committer, sha, cdate AS timestamp FROM commit_base WHERE committer IN ({_in_list(cat.AUTHORS)})""",
                                     "commit_flat"),
    "weekly_commits_per_repo": with_views("""
SELECT repo AS repository, CAST(weekofyear(cdate) AS BIGINT) AS week, CAST(year(cdate) AS BIGINT) AS year,
       count(*) AS count
FROM commit_base GROUP BY ALL""", "commit_flat"),
    "commit_age_seconds": with_views(f"""
SELECT sha, cdate AS date, CAST({_SNAP} - epoch_us(cdate) // 1000000 AS BIGINT) AS age FROM commit_base""",
                                     "commit_flat"),
    "days_since_previous_commit": with_views(f"""
SELECT sha AS "$oid", committer AS name, cdate AS date,
       CAST(coalesce(date_diff('day', CAST(lag(cdate) OVER w AS DATE), CAST(cdate AS DATE)), 0) AS BIGINT)
         AS time_diff
FROM commit_base WHERE committer = '{cat.FOCUS_COMMITTER}'
WINDOW w AS (PARTITION BY committer ORDER BY cdate, sha)""", "commit_flat"),
    "days_since_previous_commit_all": with_views("""
SELECT sha AS "$oid", committer AS name, cdate AS date,
       CAST(coalesce(date_diff('day', CAST(lag(cdate) OVER w AS DATE), CAST(cdate AS DATE)), 0) AS BIGINT)
         AS time_diff
FROM commit_base WINDOW w AS (PARTITION BY committer ORDER BY cdate, sha)""", "commit_flat"),
    "commits_per_weekday": with_views("""
SELECT CAST(dayofweek(cdate) + 1 AS BIGINT) AS day, count(*) AS commits_per_day FROM commit_base GROUP BY 1""",
                                      "commit_flat"),
    "author_committer_lag_seconds": with_views("""
SELECT sha, CAST((epoch_us(cdate) - epoch_us(adate)) // 1000000 AS BIGINT) AS commit_time_diff
FROM commit_flat""", "commit_flat"),
    "branch_points": with_views("""
SELECT parent_sha AS sha, count(DISTINCT child_sha) AS times_parent FROM parent_flat
WHERE parent_sha IN (SELECT sha FROM commit_base)
GROUP BY parent_sha HAVING count(DISTINCT child_sha) > 1""", "commit_flat", "parent_flat"),
    "fork_points": with_views("""
SELECT DISTINCT p.owner || '/' || p.repo AS repo_name, c.owner || '/' || c.repo AS child_repo_name,
       e.parent_sha, e.child_sha
FROM parent_flat e JOIN commit_base c ON c.sha = e.child_sha JOIN commit_base p ON p.sha = e.parent_sha
WHERE p.owner || '/' || p.repo <> c.owner || '/' || c.repo""", "commit_flat", "parent_flat"),
    # the line of first parents above each fork, walked commit by commit
    "fork_first_commits": with_views("""
, line AS (
  SELECT c.k, c.sha, c.owner || '/' || c.repo AS full_name, p.parent_k FROM commit_base c
  LEFT JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey - 1 ELSE o_orderkey - 407 END AS parent_k
             FROM orders) p ON p.k = c.k AND p.parent_k IN (SELECT k FROM commit_base)),
fork AS (
  SELECT u.full_name AS repo_name, c.full_name AS child_repo_name, u.sha AS parent_sha, c.sha AS child_sha, u.k AS pos
  FROM line c JOIN line u ON c.parent_k = u.k WHERE c.full_name <> u.full_name),
above AS (
  SELECT child_sha, child_repo_name, pos FROM fork
  UNION ALL SELECT a.child_sha, a.child_repo_name, l.parent_k FROM above a JOIN line l ON l.k = a.pos WHERE l.parent_k IS NOT NULL)
SELECT repo_name, child_repo_name, parent_sha, child_sha FROM fork
WHERE child_sha NOT IN (SELECT a.child_sha FROM above a JOIN line l ON l.k = a.pos WHERE l.full_name = a.child_repo_name)""",
                                     "commit_flat").replace("WITH ", "WITH RECURSIVE ", 1),
    "time_diff_summary": with_views(f"""
, diffs AS (
  SELECT coalesce(date_diff('day', CAST(lag(cdate) OVER w AS DATE), CAST(cdate AS DATE)), 0) AS x
  FROM commit_base WHERE committer = '{cat.FOCUS_COMMITTER}' WINDOW w AS (PARTITION BY committer ORDER BY cdate, sha))
SELECT count(*) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS stddev, CAST(min(x) AS BIGINT) AS min,
       CAST(max(x) AS BIGINT) AS max, CAST(quantile_disc(x, 0.25) AS BIGINT) AS p25, CAST(quantile_disc(x, 0.5) AS BIGINT) AS p50,
       CAST(quantile_disc(x, 0.75) AS BIGINT) AS p75
FROM diffs""", "commit_flat"),
    "common_committers": with_views(f"""
, rows AS (SELECT year(cdate) AS year, 'https://api.github.com/repos/' || owner || '/' || repo AS repo_url, committer FROM commit_base)
SELECT repo_url, committer, count(*) AS n FROM (
  SELECT repo_url, committer FROM rows WHERE year < {cat.FOCUS_YEAR}
  INTERSECT ALL SELECT repo_url, committer FROM rows WHERE year >= {cat.FOCUS_YEAR}) GROUP BY ALL""", "commit_flat"),
    # ---- B ----
    "commit_count": with_views("SELECT count(*) AS commits FROM commit_base", "commit_flat"),
    "file_extension_counts": with_views(f"""
SELECT {_B2_EXT} AS extension, count(*) AS count
FROM (SELECT regexp_replace(regexp_replace(filename, '^.*/', ''), '\\.+$', '') AS b FROM file_flat)
GROUP BY 1""", "file_flat"),
    "author_rank": with_views("""
SELECT CAST(row_number() OVER (ORDER BY commits DESC, author) - 1 AS BIGINT) AS rank, author, commits
FROM (SELECT author, count(*) AS commits FROM commit_base GROUP BY author)""", "commit_flat"),
    "committer_stats_totals": with_views(f"""
SELECT committer, CAST(sum(coalesce(total, 0)) AS BIGINT) AS total,
       CAST(sum(coalesce(additions, 0)) AS BIGINT) AS additions,
       CAST(sum(coalesce(deletions, 0)) AS BIGINT) AS deletions
FROM commit_flat WHERE committer IN ({_in_list(cat.USERS)}) GROUP BY committer""", "commit_flat"),
    "exclusive_owners_or_authors": with_views("""
SELECT name FROM (SELECT author AS name, 1 AS a, 0 AS o FROM commit_base
                  UNION ALL SELECT owner, 0, 1 FROM commit_base)
WHERE name IS NOT NULL GROUP BY name HAVING max(a) + max(o) = 1""", "commit_flat"),
    "longest_revert_streak": with_views("""
, s AS (SELECT author, CAST((length(message) - length(replace(message, 'Revert', ''))) // 6 AS BIGINT) AS streak
        FROM commit_base WHERE starts_with(message, 'Revert')),
  m AS (SELECT author, max(streak) AS longest FROM s GROUP BY author)
SELECT s.author, m.longest, count(*) AS how_often FROM s JOIN m ON s.author = m.author AND s.streak = m.longest
GROUP BY s.author, m.longest""", "commit_flat"),
    "repo_commits_and_committers": with_views("""
SELECT repo AS repository, committer, count(*) AS commits FROM commit_base GROUP BY repo, committer""", "commit_flat"),
    "repo_commit_totals": with_views("""
SELECT repo AS repository, count(*) AS commits, count(DISTINCT committer) AS committers
FROM commit_base GROUP BY repo""", "commit_flat"),
    "latest_files_per_repo": with_views("""
SELECT repository, filename, sha, status, additions, deletions, changes FROM (
  SELECT c.repo AS repository, f.filename, f.file_sha AS sha, f.status, f.additions, f.deletions, f.changes,
         row_number() OVER (PARTITION BY c.repo, f.filename ORDER BY c.adate DESC, c.sha DESC, f.file_sha DESC)
           AS rn
  FROM file_flat f JOIN commit_flat c ON c.k = f.k WHERE f.filename IS NOT NULL)
WHERE rn = 1""", "commit_flat"),
    "repo_file_overview": with_views(f"""
, f AS (SELECT f.filename, c.sha, f.changes, f.additions, f.deletions
        FROM file_flat f JOIN commit_base c ON c.k = f.k
        WHERE c.repo = '{cat.FOCUS_REPO}' AND f.filename IS NOT NULL),
  t AS (SELECT filename, CAST(sum(changes) AS BIGINT) AS total, CAST(sum(additions) AS BIGINT) AS additions,
               CAST(sum(deletions) AS BIGINT) AS deletions FROM f GROUP BY filename)
SELECT DISTINCT f.filename, f.sha, t.total, t.additions, t.deletions FROM f JOIN t ON f.filename = t.filename""",
                                     "commit_flat"),
    "committer_repo_stats": with_views("""
SELECT committer, repo AS repository, CAST(sum(total) AS BIGINT) AS total,
       CAST(sum(additions) AS BIGINT) AS additions, CAST(sum(deletions) AS BIGINT) AS deletions
FROM commit_flat GROUP BY committer, repo""", "commit_flat"),
    "md5_long_id": with_views(f"SELECT sha, {_ID.format(x='sha')} AS id FROM commit_base", "commit_flat"),
    "developer_repo_graph": with_views(f"""
, pairs AS (SELECT DISTINCT committer AS developer, repo AS repository FROM commit_base WHERE committer IS NOT NULL),
  v AS (SELECT developer AS name, 'developer' AS kind, count(*) AS degree FROM pairs GROUP BY developer
        UNION ALL SELECT repository, 'repository', count(*) FROM pairs GROUP BY repository)
SELECT {_ID.format(x='name')} AS id, kind, name, CAST(degree AS BIGINT) AS degree FROM v""", "commit_flat"),
    "developer_repo_vertices": with_views(f"""
, v AS (SELECT DISTINCT committer AS name, 'developer' AS kind FROM commit_base WHERE committer IS NOT NULL
        UNION ALL SELECT DISTINCT repo, 'repository' FROM commit_base WHERE committer IS NOT NULL)
SELECT {_ID.format(x='name')} AS id, kind, name FROM v""", "commit_flat"),
    "developer_repo_edges": with_views(f"""
, pairs AS (SELECT DISTINCT committer, repo FROM commit_base WHERE committer IS NOT NULL)
SELECT {_ID.format(x='committer')} AS src, 'developer' AS src_kind, {_ID.format(x='repo')} AS dst,
       'repository' AS dst_kind, 'committed_to' AS relation FROM pairs""", "commit_flat"),
    # ---- D ----
    "avg_additions": with_views("""
SELECT CAST(sum(additions) // count(additions) AS BIGINT) AS avg_additions FROM commit_flat WHERE has_stats""",
                                "commit_flat"),
    "peak_js_hour": with_views("""
SELECT CAST(hour(c.cdate) AS BIGINT) AS hour, count(*) AS files
FROM file_flat f JOIN commit_base c ON c.k = f.k WHERE ends_with(f.filename, '.js')
GROUP BY 1 ORDER BY files DESC, hour LIMIT 1""", "commit_flat"),
    "top_committer_of_repo": with_views(f"""
SELECT committer AS name, count(*) AS commits FROM commit_base
WHERE repo = '{cat.FOCUS_REPO}' OR owner || '/' || repo = '{cat.FOCUS_REPO}'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""", "commit_flat"),
    "commits_per_repo_in_year": with_views(f"""
SELECT owner || '/' || repo AS repository, count(*) AS commits FROM commit_base
WHERE cdate >= TIMESTAMP '{cat.FOCUS_YEAR}-01-01' AND cdate < TIMESTAMP '{cat.FOCUS_YEAR + 1}-01-01'
GROUP BY 1""", "commit_flat"),
    "top_file_formats": with_views(f"""
SELECT {_LAST_DOT} AS extension, count(*) AS count FROM file_flat WHERE filename IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""", "file_flat"),
}

_LONE_I = r"(^|[^\p{L}\p{N}\p{M}_])i([^\p{L}\p{N}\p{M}_]|$)"
_POSTS = """SELECT time, client, path, TRY_CAST(status AS INTEGER)::BIGINT AS status,
       CASE WHEN regexp_matches(size, '^[0-9]+$') THEN CAST(size AS BIGINT) END AS size
FROM parsed_log WHERE method = 'POST'"""

ORACLE.update({
    # ---- E ----
    "lines_containing": with_views(f"""
SELECT line_no, line AS value FROM error_log WHERE contains(line, '{cat.ERROR_NEEDLE}')""", "error_log"),
    "first_quoted_requests": with_views("""
SELECT line_no, regexp_extract(line, '"(.*)"', 1) AS request FROM access_log
WHERE contains(line, 'GET') ORDER BY line_no LIMIT 3""", "access_log"),
    "post_requests": with_views(_POSTS, "parsed_log"),
    "largest_post_response": with_views(f"""
SELECT client, path FROM ({_POSTS}) ORDER BY coalesce(size, 0) DESC, client DESC, path DESC LIMIT 1""",
                                        "parsed_log"),
    "top_post_client": with_views("""
SELECT count(*) AS requests, client FROM parsed_log WHERE method = 'POST'
GROUP BY client ORDER BY 1 DESC, client DESC LIMIT 1""", "parsed_log"),
    "access_log_to_csv": with_views("""
SELECT client AS "Client", time AS "Time", method AS "Type", path AS "Path", status AS "Status", size AS "Size"
FROM parsed_log""", "parsed_log"),
    "top_words": r"""
SELECT n, word FROM (
  SELECT word, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all(lower(text), '(\p{L}+)', 1)) AS word FROM documents)
  GROUP BY word)
ORDER BY n DESC, word DESC LIMIT 10""",
    "first_sentences": r"""
SELECT doc_id, pos, sentence FROM (
  SELECT doc_id, CAST(pos AS BIGINT) AS pos, trim(s) AS sentence FROM (
    SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, string_split(regexp_replace(text, '\r\n|\r|\n', ' ', 'g'), '.') AS parts
          FROM documents)))
WHERE sentence <> '' ORDER BY doc_id, pos LIMIT 7""",
    "fix_lowercase_i": f"""
SELECT doc_id, regexp_replace(regexp_replace(text, '{_LONE_I}', '\\1I\\2', 'g'), '{_LONE_I}', '\\1I\\2', 'g')
       AS text
FROM documents""",
    # ---- F ----
    "array_map": with_views("""
SELECT list_id, array_to_string(list_transform(xs, lambda x: x + 1), ',') AS result FROM order_list""",
                            "order_list"),
    "array_filter": with_views("""
SELECT list_id, array_to_string(list_filter(xs, lambda x: x > 25), ',') AS result FROM order_list""",
                               "order_list"),
    "array_flatten_deep": with_views("""
, inner_l AS (SELECT list_id, grp, list(value ORDER BY item_key) AS xs FROM order_items GROUP BY list_id, grp),
  nested AS (SELECT list_id, list(xs ORDER BY grp) AS xss FROM inner_l GROUP BY list_id)
SELECT n.list_id, array_to_string(list_concat(flatten(n.xss), o.xs), ',') AS result
FROM nested n JOIN order_list o ON n.list_id = o.list_id""", "order_list"),
    "array_flatten_typed": with_views("""
, inner_l AS (SELECT list_id, grp, list(value ORDER BY item_key) AS xs FROM order_items GROUP BY list_id, grp)
SELECT list_id, array_to_string(flatten(list(xs ORDER BY grp)), ',') AS result FROM inner_l GROUP BY list_id""",
                                      "order_list"),
    "array_fold_left": with_views(f"""
SELECT list_id, list_reduce(xs, lambda acc, x: (acc * 31 + x) % {cat.FOLD_MOD}, CAST({cat.FOLD_INIT} AS BIGINT)) AS result
FROM order_list""", "order_list"),
    "array_fold_right": with_views(f"""
SELECT list_id, list_reduce(list_reverse(xs), lambda acc, x: (acc * 31 + x) % {cat.FOLD_MOD}, CAST({cat.FOLD_INIT} AS BIGINT))
       AS result
FROM order_list""", "order_list"),
    "array_zip_shortest": with_views("""
SELECT list_id, array_to_string(list_transform(range(1, len(xs)), lambda i: xs[i] || ':' || xs[i + 1]), ',')
       AS result
FROM order_list""", "order_list"),
    "array_first_n": with_views("""
SELECT list_id, array_to_string(xs[1:3], ',') AS result FROM order_list""", "order_list"),
    "list_max": with_views("SELECT list_id, list_max(xs) AS result FROM order_list", "order_list"),
    "list_sum": with_views("""
SELECT list_id, CAST(coalesce(list_sum(xs), 0) AS BIGINT) AS result FROM order_list""", "order_list"),
    "list_sum_defined": with_views("""
SELECT list_id, CAST(coalesce(list_sum(list_filter(oxs, lambda x: x IS NOT NULL)), 0) AS BIGINT) AS result
FROM order_list""", "order_list"),
    "list_first_divisible": with_views("""
SELECT list_id, list_filter(xs, lambda x: x % 7 = 0)[1] AS result FROM order_list""", "order_list"),
    "list_even_defined": with_views("""
SELECT list_id, array_to_string(list_filter(oxs, lambda x: x IS NOT NULL AND x % 2 = 0), ',') AS result
FROM order_list""", "order_list"),
    "list_avg_first_n_above": with_views("""
SELECT list_id, CASE WHEN len(s) > 0 THEN CAST(list_sum(s) // len(s) AS BIGINT) END AS result
FROM (SELECT list_id, list_filter(xs, lambda x: x > 25)[1:3] AS s FROM order_list)""", "order_list"),
    "list_sum_first_n_above": with_views("""
SELECT list_id, CAST(coalesce(sum(value) FILTER (value > 25 AND rn <= 10), 0) AS BIGINT) AS total FROM (
  SELECT supp AS list_id, value, row_number() OVER (PARTITION BY supp ORDER BY value > 25 DESC, item_key) AS rn
  FROM order_items)
GROUP BY list_id""", "order_list"),
    "passing_students": with_views("""
SELECT CAST(count_if(n > 0 AND s >= 5.75 * n AND mn >= 4) AS BIGINT) AS passing FROM (
  SELECT list_id, sum(value % 11) AS s, count(*) AS n, min(value % 11) AS mn FROM order_items GROUP BY list_id)""",
                                   "order_list"),
    "first_head_sums_tail": with_views("""
SELECT CAST(arg_min(len(xs), list_id) AS BIGINT) AS size FROM order_list
WHERE len(xs) >= 1 AND xs[1] = coalesce(list_sum(xs[2:]), 0)""", "order_list"),
    "fizzbuzz_label": """
SELECT label, count(*) AS n FROM (
  SELECT CASE WHEN q % 15 = 0 THEN 'FizzBuzz' WHEN q % 5 = 0 THEN 'Buzz' WHEN q % 3 = 0 THEN 'Fizz'
              ELSE CAST(q AS VARCHAR) END AS label
  FROM (SELECT CAST(l_quantity AS BIGINT) AS q FROM lineitem))
GROUP BY label""",
})

_EXT = r"regexp_extract(filename, '\.([^.]*)$', 1)"
_C9 = """
, ev AS (SELECT full_name AS repository, filename, ts, status FROM ev_commit
         WHERE filename IS NOT NULL AND status IN ('added', 'removed'))
SELECT DISTINCT r.repository, r.filename
FROM ev r JOIN ev a ON a.repository = r.repository AND a.filename = r.filename
 AND a.status = 'added' AND r.status = 'removed' AND r.ts > a.ts AND r.ts < a.ts + INTERVAL {h}"""

ORACLE.update({
    # ---- C (batch evaluation of the stream analytics) ----
    "stream_commit_shas": with_views("SELECT sha FROM ev_commit", "ev_commit"),
    "stream_large_additions": with_views("SELECT sha FROM ev_commit WHERE stat_amount >= 20", "ev_commit"),
    "stream_large_deletion_files": with_views("""
SELECT filename FROM ev_commit WHERE filename IS NOT NULL AND deletions > 30""", "ev_commit"),
    "stream_extension_counts": with_views(f"""
SELECT {_EXT} AS extension, count(*) AS count FROM ev_commit
WHERE ends_with(filename, '.java') OR ends_with(filename, '.scala') GROUP BY 1""", "ev_commit"),
    "stream_extension_status_counts": with_views(f"""
SELECT {_EXT} AS extension, status, count(*) AS count FROM ev_commit
WHERE (ends_with(filename, '.js') OR ends_with(filename, '.py')) AND status IS NOT NULL GROUP BY 1, 2""",
                                                 "ev_commit"),
    "stream_daily_commits": with_views("""
SELECT strftime(time_bucket(INTERVAL 1 day, ts, TIMESTAMP '1970-01-01'), '%d-%m-%Y') AS date, count(*) AS count
FROM ev_commit GROUP BY 1""", "ev_commit"),
    "stream_size_class_counts": with_views("""
SELECT window_end, size_class, count(*) AS count FROM (
  SELECT time_bucket(INTERVAL 12 hours, ts, TIMESTAMP '1970-01-01') - to_hours(12 * i) + INTERVAL 48 hours
           AS window_end,
         CASE WHEN coalesce(stat_amount, 0) BETWEEN 0 AND 20 THEN 'small' ELSE 'large' END AS size_class
  FROM ev_commit, range(4) t(i))
GROUP BY ALL""", "ev_commit"),
    "stream_daily_repo_summary": with_views("""
, pp AS (SELECT full_name AS repo, time_bucket(INTERVAL 1 day, ts, TIMESTAMP '1970-01-01') AS d, committer,
                count(*) AS n, sum(coalesce(stat_amount, 0)) AS changes
         FROM ev_commit GROUP BY ALL),
  pr AS (SELECT repo, d, sum(n) AS c, count(*) AS m, sum(changes) AS t, max(n) AS top FROM pp GROUP BY repo, d),
  tops AS (SELECT pp.repo, pp.d, string_agg(pp.committer, ',' ORDER BY pp.committer) AS names
           FROM pp JOIN pr ON pp.repo = pr.repo AND pp.d = pr.d AND pp.n = pr.top GROUP BY pp.repo, pp.d)
SELECT pr.repo, strftime(pr.d, '%d-%m-%Y') AS date, CAST(pr.c AS BIGINT) AS "amountOfCommits",
       CAST(pr.m AS BIGINT) AS "amountOfCommitters", CAST(pr.t AS BIGINT) AS "totalChanges",
       tops.names AS "topCommitter"
FROM pr JOIN tops ON tops.repo = pr.repo AND tops.d = pr.d
WHERE pr.c > 20 AND pr.m <= 2""", "ev_commit"),
    "stream_weekly_java_changes_by_continent": with_views("""
, c AS (SELECT sha, ts, CASE WHEN ends_with(filename, '.java') THEN changes ELSE 0 END AS java FROM ev_commit)
SELECT time_bucket(INTERVAL 7 days, c.ts, TIMESTAMP '1970-01-01') AS week_start, g.continent,
       CAST(sum(c.java) AS BIGINT) AS amount
FROM c JOIN ev_geo g ON g.sha = c.sha AND g.created_at >= c.ts - INTERVAL 1 hour
                    AND g.created_at <= c.ts + INTERVAL 30 minutes
GROUP BY ALL HAVING sum(c.java) > 0""", "ev_commit", "ev_geo"),
    "stream_added_then_removed": with_views(_C9.format(h="1 day"), "ev_commit"),
    "stream_added_then_removed_1h": with_views(_C9.format(h="1 hour"), "ev_commit"),
})
for _k in ("stream_daily_commits", "stream_size_class_counts", "stream_daily_repo_summary",
           "stream_weekly_java_changes_by_continent", "stream_added_then_removed",
           "stream_extension_status_counts", "stream_extension_counts", "stream_commit_shas",
           "stream_large_additions", "stream_large_deletion_files"):
    ORACLE[_k + "_replay"] = ORACLE[_k]

ORACLE["array_flatten_variant"] = ORACLE["array_flatten_deep"]
ORACLE["stream_added_then_removed_keyed_replay"] = ORACLE["stream_added_then_removed"]
ORACLE["stream_weekly_java_changes_by_continent_two_sources_replay"] = ORACLE["stream_weekly_java_changes_by_continent"]
_RUNNING = """
, ev AS (SELECT sha, ts, CAST(0 AS BIGINT) AS position, {ext} AS extension, status FROM ev_commit
         WHERE ({names}) AND filename IS NOT NULL)
SELECT sha, ts, position, {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY ts NULLS FIRST, sha, position) AS count FROM ev"""
ORACLE["stream_running_extension_counts"] = with_views(_RUNNING.format(
    ext=_EXT, names="ends_with(filename, '.java') OR ends_with(filename, '.scala')", keys="extension"), "ev_commit")
ORACLE["stream_running_extension_counts_replay"] = ORACLE["stream_running_extension_counts"]
ORACLE["stream_running_extension_status_counts"] = with_views(_RUNNING.format(
    ext=_EXT, names="ends_with(filename, '.js') OR ends_with(filename, '.py')", keys="extension, status"), "ev_commit")
# arrival batches, and what each finds behind the newest event of the batches before it
_LATE = f"""
, arriving AS (
  SELECT event_id, ts, ts + CASE WHEN event_id % {cat.LATE_EVERY} = 0 THEN INTERVAL {cat.LATE_BY} ELSE INTERVAL 0 DAY END AS arrival
  FROM events),
ends AS (SELECT epoch_us(min(arrival)) AS lo, epoch_us(max(arrival)) AS hi FROM arriving),
batched AS (
  SELECT event_id, ts, (SELECT count(*) FROM range(1, {cat.REPLAY_BATCHES}) r(i)
                        WHERE epoch_us(arrival) >= lo + (hi - lo) * i // {cat.REPLAY_BATCHES}) AS batch
  FROM arriving, ends),
newest AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
           FROM batched GROUP BY batch),
placed AS (SELECT event_id, ts, coalesce(ts < mark - INTERVAL {cat.LATENESS}, false) AS late FROM batched JOIN newest USING (batch))"""
ORACLE["stream_late_rows_replay"] = with_views(_LATE + """
SELECT md5('e' || event_id) AS sha, ts FROM placed WHERE late""", "ev_commit")
ORACLE["stream_daily_commits_on_time_replay"] = with_views(_LATE + """
SELECT strftime(time_bucket(INTERVAL 1 day, ts, TIMESTAMP '1970-01-01'), '%d-%m-%Y') AS date, count(*) AS count
FROM placed WHERE NOT late GROUP BY 1""", "ev_commit")
