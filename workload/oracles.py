"""DuckDB SQL for every checked query, straight from the `events` table."""

from .derive import BLOCK, BUCKET, DENSE_DAY, ORG, SPLIT_DAY

AUDIT = f"""
base AS (
  SELECT event_id AS i, lpad(CAST(user_id % 7 + 1 AS VARCHAR), 12, '0') AS acct,
         CASE event_type WHEN 'click' THEN 'us-east-1' WHEN 'view' THEN 'eu-west-1' ELSE 'ap-south-1' END AS rg,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, md5(CAST(event_id AS VARCHAR)) AS eid
  FROM events),
records AS (
  SELECT *, CASE WHEN i % 70 = 3 THEN '{{"eventID":"' || eid ELSE
    '{{"eventTime":"' || CASE WHEN i % 50 = 0 THEN 'not-a-time' ELSE iso END || '","eventID":"' || eid ||
    '","awsRegion":"' || CASE WHEN i % 90 = 5 THEN '' ELSE rg END || '","userIdentity":{{"accountId":"' ||
    CASE WHEN i % 60 = 2 THEN '' ELSE acct END || '"}}' ||
    CASE WHEN i % 60 = 2 OR i % 40 = 1 THEN '' ELSE ',"recipientAccountId":"' || acct || '"' END || '}}' END AS raw
  FROM base),
audit AS (
  SELECT *, 0 AS trail_rank, 'org-trail' AS trail FROM records
  UNION ALL SELECT *, 1, 'local-trail' FROM records WHERE i % 10 = 4),
checked AS (
  SELECT *, CASE WHEN json_valid(raw) THEN raw END AS j FROM audit),
fields AS (
  SELECT *, coalesce(j ->> '$.eventTime', '') AS event_time, coalesce(j ->> '$.eventID', '') AS event_id,
         coalesce(j ->> '$.awsRegion', '') AS region,
         coalesce(j ->> '$.userIdentity.accountId', '') AS identity_account_id,
         coalesce(j ->> '$.recipientAccountId', '') AS recipient_account_id
  FROM checked),
resolved AS (
  SELECT *, coalesce(nullif(recipient_account_id, ''), nullif(identity_account_id, '')) AS account_id,
         try_strptime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS instant
  FROM fields),
classified AS (
  SELECT *, CASE WHEN j IS NULL THEN 'malformed' WHEN instant IS NULL THEN 'bad_time'
                 WHEN account_id IS NULL THEN 'no_account' END AS reject_reason,
         account_id || '/' || region || '/' || strftime(instant, '%Y/%m/%d/%H') AS route,
         substr(event_time, 9, 2) AS day
  FROM resolved),
good AS (SELECT * FROM classified WHERE reject_reason IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY trail_rank, i) AS copy_no FROM good),
firsts AS (SELECT * FROM ranked WHERE copy_no = 1),
seen AS (SELECT DISTINCT event_id FROM good WHERE day < '{SPLIT_DAY}')"""

FILES = f"""
hours AS (
  SELECT lpad(CAST(user_id % 7 + 1 AS VARCHAR), 12, '0') AS acct,
         CASE event_type WHEN 'click' THEN 'us-east-1' WHEN 'view' THEN 'eu-west-1' ELSE 'ap-south-1' END AS rg,
         date_trunc('hour', ts) AS hr, count(*) AS n_records
  FROM events GROUP BY ALL),
audit_files AS (
  SELECT CASE WHEN acct <= '000000000003' THEN 'org-trail' ELSE 'local-trail' END AS trail,
         '{BUCKET}' AS bucket, CASE WHEN acct <= '000000000003' THEN 'logs' ELSE '' END AS prefix,
         CASE WHEN acct <= '000000000003' THEN 'logs/AWSLogs/{ORG}/' ELSE 'AWSLogs/' END || acct || '/CloudTrail/' ||
         rg || '/' || strftime(hr, '%Y/%m/%d/') || acct || '_CloudTrail_' || rg || '_' ||
         strftime(hr, '%Y%m%dT%H00Z') || '_' || substr(md5(acct || rg || strftime(hr, '%Y%m%dT%H00Z')), 1, 8) ||
         CASE WHEN day(hr) % 9 = 0 THEN '.json.gz.tmp' ELSE '.json.gz' END AS key,
         CASE WHEN acct <= '000000000003' THEN '{ORG}' ELSE '' END AS org_id,
         acct AS account_id, rg AS region, strftime(hr, '%d') AS day, n_records
  FROM hours),
logs AS (SELECT * FROM audit_files WHERE key LIKE '%.json.gz'),
checkpoints AS (
  SELECT bucket, prefix, account_id, region, max(key) AS last_processed_key, count(*) AS files_processed,
         count(*) // 100 + 1 AS commits
  FROM logs WHERE day < '{SPLIT_DAY}' AND account_id <= '000000000005' GROUP BY ALL),
pending AS (
  SELECT l.* FROM logs l LEFT JOIN checkpoints c USING (bucket, prefix, account_id, region)
  WHERE l.key > coalesce(c.last_processed_key, ''))"""

# Log files as written: one per trail, account, region and block of event numbers.
STORED = AUDIT + f""",
stored AS (
  SELECT *, CASE WHEN i % 70 = 3 THEN '{{"eventID":' || i || '}}' ELSE raw END AS record, i // {BLOCK} AS block,
         CASE WHEN trail = 'org-trail' THEN 'logs/AWSLogs/{ORG}/' ELSE 'AWSLogs/' END || acct || '/CloudTrail/' || rg ||
         '/2024/01/' || lpad(CAST(i // {BLOCK} AS VARCHAR), 10, '0') || '.json.gz' AS key
  FROM audit)"""

ROUTES = "SELECT route, count(*) AS events FROM firsts GROUP BY route"
COUNTERS = """
  (SELECT count(*) FROM classified) AS events_processed,
  (SELECT count(*) FROM firsts) AS events_written,
  (SELECT count(*) FROM ranked WHERE copy_no > 1) AS events_duplicate,
  (SELECT count(*) FROM classified WHERE reject_reason = 'malformed') AS events_malformed,
  (SELECT count(*) FROM classified WHERE reject_reason = 'bad_time') AS events_bad_time,
  (SELECT count(*) FROM classified WHERE reject_reason = 'no_account') AS events_no_account,
  (SELECT count(DISTINCT route) FROM firsts) AS hour_buffers"""


def _audit(sql: str) -> str:
    return f"WITH {AUDIT} {sql}"


def _dense(sql: str) -> str:
    """The same with all events on one day."""
    whole = f"WITH {STORED} {sql}"
    return whole.replace("strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", f"strftime(ts, '{DENSE_DAY}T%H:%M:%SZ')")


def _files(sql: str) -> str:
    return f"WITH {FILES} {sql}"


def _stored(sql: str) -> str:
    return f"WITH {STORED} {sql}"


def oracle_sql() -> dict[str, str]:
    after_seen = "SELECT trail, i, event_id, raw FROM {} g WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.event_id = g.event_id)"
    return {
        "base_prefixes": _files("""
            SELECT trail, prefix, CASE WHEN prefix <> '' THEN prefix || '/' ELSE '' END || 'AWSLogs/' AS base,
                   count(*) AS objects FROM audit_files GROUP BY ALL"""),
        "search_prefixes": _files("""
            SELECT CASE WHEN prefix <> '' THEN prefix || '/' ELSE '' END || 'AWSLogs/' ||
                   CASE WHEN org_id <> '' THEN org_id || '/' ELSE '' END || account_id || '/CloudTrail/' AS account_prefix,
                   region, count(*) FILTER (key LIKE
                     CASE WHEN prefix <> '' THEN prefix || '/' ELSE '' END || 'AWSLogs/' ||
                     CASE WHEN org_id <> '' THEN org_id || '/' ELSE '' END || account_id || '/CloudTrail/' || region || '/%'
                   ) AS objects_below
            FROM audit_files GROUP BY ALL"""),
        "parse_object_keys": _files("""
            SELECT key, regexp_extract(key, 'AWSLogs/(?:(o-[^/]+)/)?([^/]+)/CloudTrail/([^/]+)/', 1) AS org_id,
                   regexp_extract(key, 'AWSLogs/(?:(o-[^/]+)/)?([^/]+)/CloudTrail/([^/]+)/', 2) AS account_id,
                   regexp_extract(key, 'AWSLogs/(?:(o-[^/]+)/)?([^/]+)/CloudTrail/([^/]+)/', 3) AS region
            FROM audit_files"""),
        "account_ids": _audit("""
            SELECT acct, eid, CASE WHEN regexp_full_match(acct, '[0-9]{12}') THEN 'yes' ELSE 'no' END AS acct_ok,
                   CASE WHEN regexp_full_match(substr(eid, 1, 12), '[0-9]{12}') THEN 'yes' ELSE 'no' END AS eid_ok
            FROM audit"""),
        "state_keys": _files("""
            SELECT bucket || ':' || account_id || ':' || region AS state_key, count(*) AS objects
            FROM audit_files GROUP BY ALL"""),
        "discover_accounts": _files("SELECT DISTINCT bucket, org_id, account_id FROM audit_files"),
        "discover_account_regions": _files("SELECT DISTINCT bucket, org_id, account_id, region FROM audit_files"),
        "list_log_objects": _stored(f"SELECT DISTINCT trail, '{BUCKET}' AS bucket, key FROM stored"),
        "scan_records": _stored("""
            SELECT trail, key, row_number() OVER (PARTITION BY key ORDER BY i) - 1 AS ordinal, record AS raw FROM stored"""),
        "minimal_projection": _audit("""
            SELECT trail, i, event_time, event_id, region, identity_account_id, recipient_account_id,
                   CASE WHEN j IS NULL THEN 'yes' ELSE 'no' END AS malformed FROM fields WHERE j IS NOT NULL
            UNION ALL SELECT trail, i, '', '', '', '', '', 'yes' FROM fields WHERE j IS NULL"""),
        "resolve_account": _audit("SELECT trail, i, account_id FROM resolved"),
        "event_times": _audit("""
            SELECT trail, i, epoch_us(instant) AS event_micros, strftime(instant, '%Y/%m/%d/%H') AS hour_path FROM resolved"""),
        "route_counts": _audit("SELECT route, count(*) AS events FROM good GROUP BY route"),
        "reject_reasons": _audit("""
            SELECT trail, coalesce(reject_reason, 'ok') AS outcome, count(*) AS events FROM classified GROUP BY ALL"""),
        "dedup_first": _audit("""
            SELECT f.trail, f.i, f.event_id, f.raw, c.copies FROM firsts f
            JOIN (SELECT event_id, count(*) AS copies FROM good GROUP BY event_id) c USING (event_id)"""),
        "mark_duplicates": _audit("""
            SELECT trail, i, event_id, CASE WHEN copy_no > 1 THEN 'repeat' ELSE 'first' END AS mark FROM ranked"""),
        "drop_seen": _audit(after_seen.format("good")),
        "drop_seen_by_date": _audit(after_seen.format("good")),
        "union_trails": _audit("SELECT event_id, trail, i FROM firsts"),
        "distinct_objects": _files("SELECT bucket, key, trail, n_records FROM audit_files"),
        "pending_objects": _files("SELECT key, account_id, region, n_records FROM pending"),
        "advance_checkpoints": _files("""
            SELECT bucket, prefix, account_id, region, max(key) AS last_processed_key, count(*) AS files_processed,
                   count(*) // 100 + 1 AS commits FROM logs GROUP BY ALL"""),
        "merge_checkpoints": _files("""
            SELECT bucket, prefix, account_id, region, max(last_processed_key) AS last_processed_key,
                   CAST(sum(files_processed) AS BIGINT) AS files_processed, CAST(sum(commits) AS BIGINT) AS commits
            FROM (SELECT * FROM checkpoints UNION ALL
                  SELECT bucket, prefix, account_id, region, max(key), count(*), count(*) // 100 + 1
                  FROM pending GROUP BY ALL) GROUP BY ALL"""),
        "checkpoint_marks": _files("""
            SELECT bucket, prefix, account_id, region, key, n AS file_no, CASE WHEN key = last THEN 'yes' ELSE 'no' END AS is_last
            FROM (SELECT *, row_number() OVER w AS n, max(key) OVER (PARTITION BY bucket, prefix, account_id, region) AS last
                  FROM logs WINDOW w AS (PARTITION BY bucket, prefix, account_id, region ORDER BY key))
            WHERE n % 100 = 0 OR key = last"""),
        "file_assignment": _audit("""
            SELECT route, event_id, (n - 1) // 2 AS file_no, printf('events_%05d.jsonl', (n - 1) // 2) AS file_name
            FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY date_trunc('second', instant),
                    event_id, trail_rank, i) AS n
                  FROM firsts)"""),
        "write_read_back": _audit("""
            SELECT account_id, region, strftime(instant, '%Y') AS year, strftime(instant, '%m') AS month, strftime(instant, '%d') AS day,
                   strftime(instant, '%H') AS hour, raw AS value FROM firsts"""),
        "run_metrics": f"""
            WITH {AUDIT}, {FILES.replace('checkpoints AS', 'marks AS').replace('LEFT JOIN checkpoints', 'LEFT JOIN marks')}
            SELECT {COUNTERS}, (SELECT count(*) FROM logs WHERE n_records <> 1) AS files_listed,
              (SELECT count(*) FROM logs WHERE n_records <> 4) AS files_downloaded,
              (SELECT count(*) FROM logs WHERE n_records < 3) AS files_processed,
              (SELECT CAST(sum(n_records) AS BIGINT) FROM logs WHERE n_records <> 4) AS bytes_downloaded,
              (SELECT count(*) FROM logs WHERE n_records >= 3) AS errors""",
        "metric_rates": _files("""
            SELECT account_id, region, CAST(floor(count(*) / 8 * 1000) AS BIGINT) AS download_rate,
                   CAST(floor(sum(n_records) / 8 * 1000) AS BIGINT) AS event_rate,
                   CAST(floor(sum(n_records) * 4096 / 8 / 1024 / 1024 * 1000) AS BIGINT) AS mib_per_second
            FROM logs GROUP BY ALL"""),
        "bloom_members": _audit("""
            SELECT count(*) AS ids, count(*) AS found, 'yes' AS few_false FROM (SELECT DISTINCT event_id FROM good)"""),
        "bloom_merge": _audit("SELECT count(DISTINCT event_id) AS ids, count(DISTINCT event_id) AS found FROM good"),
        "bloom_dedup": _audit(after_seen.format("firsts")),
        "reject_files": _stored("""
            SELECT DISTINCT key, CASE WHEN acct >= '000000000004' THEN 'bad' ELSE 'good' END AS state FROM stored"""),
        "ingest_batch": _audit(f"{ROUTES}"),
        "ingest_counters": _stored(f"""
            SELECT {COUNTERS}, (SELECT count(DISTINCT key) FROM stored) AS files_listed,
                   (SELECT count(DISTINCT key) FROM stored) AS files_processed, CAST(0 AS BIGINT) AS errors"""),
        "ingest_incremental": _audit(f"{ROUTES}"),
        "ingest_checkpoints": _stored(f"""
            SELECT '{BUCKET}' AS bucket, CASE WHEN trail = 'org-trail' THEN 'logs' ELSE '' END AS prefix,
                   acct AS account_id, rg AS region, max(key) AS last_processed_key,
                   count(DISTINCT key) AS files_processed FROM stored GROUP BY ALL"""),
        "stream_ingest": _audit(f"{ROUTES}"),
        "stream_checkpoint_table": _stored(f"""
            SELECT '{BUCKET}' AS bucket, CASE WHEN trail = 'org-trail' THEN 'logs' ELSE '' END AS prefix,
                   acct AS account_id, rg AS region, max(key) AS last_processed_key,
                   count(DISTINCT key) AS files_processed FROM stored GROUP BY ALL"""),
        "stream_resume": _stored("SELECT acct AS account_id, count(*) AS records FROM stored GROUP BY ALL"),
        "stream_dedup": _audit(f"{ROUTES}"),
        **{name: _dense(ROUTES) for name in ("ingest_approx_resized", "ingest_approx_overfull", "trails_from_table",
                                             "stream_late_keys", "stream_second_query", "ingest_rebucketed",
                                             "stream_listed_late_keys")},
        "stream_progress": _dense(f"""
            SELECT '{BUCKET}' AS bucket, CASE WHEN trail = 'org-trail' THEN 'logs' ELSE '' END AS prefix,
                   acct AS account_id, rg AS region, max(key) AS last_processed_key,
                   count(DISTINCT key) AS files_processed, (SELECT count(*) FROM firsts) AS state_ids
            FROM stored GROUP BY ALL"""),
        "merged_hours": _dense("""
            SELECT route, count(*) AS events, CAST(ceil(count(*) / 20) AS BIGINT) AS files FROM firsts GROUP BY route"""),
        "loser_bitmaps": _dense("""
            SELECT s.key, count(*) AS records, count(*) FILTER (r.copy_no IS NULL OR r.copy_no = 1) AS "left"
            FROM stored s LEFT JOIN ranked r ON s.trail = r.trail AND s.i = r.i GROUP BY s.key"""),
        "known_ids": _audit("SELECT DISTINCT g.event_id FROM good g JOIN seen USING (event_id) WHERE g.i % 97 = 4"),
        "layered_sketch": _audit("""
            SELECT count(*) AS ids, count(*) AS found, 'yes' AS few_false FROM (SELECT DISTINCT event_id FROM good)"""),
        "ingest_file_counters": _dense("""
            SELECT (SELECT count(DISTINCT key) FROM stored) AS files_listed,
                   (SELECT count(DISTINCT key) FROM stored WHERE acct < '000000000004') AS files_processed,
                   (SELECT count(DISTINCT key) FROM stored WHERE acct >= '000000000004') AS errors,
                   (SELECT count(DISTINCT route) FROM good WHERE acct < '000000000004') AS hour_buffers,
                   'yes' AS downloads_ok, 'yes' AS outputs_ok"""),
        "list_after_checkpoint": _dense(f"""
            SELECT DISTINCT '{BUCKET}' AS bucket, key
            FROM (SELECT key, min(key) OVER (PARTITION BY trail, acct, rg) AS first FROM stored) WHERE key > first"""),
        "stream_bad_files": _dense("SELECT DISTINCT key FROM stored WHERE acct >= '000000000004'"),
    }
