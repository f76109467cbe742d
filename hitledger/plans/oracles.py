"""What the registered queries must return, as SQL over the source tables.

The SQL never parses a line. It works out each record from the event's columns by the scheme of
:mod:`hitledger.plans.rendered`, so a fault in the parser shows as a difference.
"""

from __future__ import annotations

_FORMS = """
forms AS (
  SELECT event_id, event_id % 40 AS k,
         CASE WHEN event_id % 40 = 18 THEN ts + to_days(CAST(30 * (event_id // 40 % 13) AS INTEGER)) ELSE ts END
           AS moment,
         'host' || (user_id % 97) || '.example.com' AS plain_host,
         '/' || event_type || '/' || (event_id * 31 % 37) || '.html' AS path,
         [200, 200, 200, 304, 302, 404, 403, 500, 501, 200][CAST(event_id * 7 % 10 AS INTEGER) + 1]
           AS code,
         event_id * 7919 % 65536 AS size
  FROM events
),
stamps AS (
  SELECT *,
         CASE k
           WHEN 10 THEN '31/Feb/2024' || strftime(moment, ':%H:%M:%S -0400')
           WHEN 11 THEN strftime(moment, '%d/Foo/%Y:%H:%M:%S -0400')
           WHEN 12 THEN upper(strftime(moment, '%d/%b/%Y')) || strftime(moment, ':%H:%M:%S -0400')
           WHEN 22 THEN strftime(moment, '%d/%b/%Y')
           WHEN 23 THEN day(moment) || strftime(moment, '/%b/%Y/x:%H:%M:%S -0400')
           WHEN 29 THEN strftime(moment, '%d/%b/%Y:25:%M:%S -0400')
           ELSE strftime(moment, '%d/%b/%Y:%H:%M:%S -0400')
         END AS stamp,
         CASE k WHEN 16 THEN '' WHEN 24 THEN 'h"]' || plain_host ELSE plain_host END AS any_host
  FROM forms
)"""

_RECORDS = (
    _FORMS
    + """,
records AS (
  SELECT event_id,
         CASE WHEN k IN (0, 26) THEN NULL ELSE any_host END AS host,
         CASE WHEN k IN (0, 1, 26) THEN NULL ELSE stamp END AS timestamp,
         CASE WHEN k IN (0, 1, 11, 26) THEN NULL WHEN k = 10 THEN '2024-02-31'
              ELSE strftime(moment, '%Y-%m-%d') END AS log_date,
         CAST(CASE WHEN k IN (0, 1, 11, 22, 26) THEN 0 WHEN k = 29 THEN 25 ELSE hour(moment) END AS INTEGER)
           AS log_hour,
         CASE WHEN k IN (0, 1, 2, 8, 14, 15, 26, 27) THEN NULL WHEN k = 9 THEN '' ELSE 'GET' END AS http_method,
         CASE WHEN k IN (0, 1, 2, 7, 9, 14, 19, 26, 27) THEN NULL WHEN k = 28 THEN '/é' || path
              ELSE path END AS resource_path,
         CASE WHEN k IN (0, 1, 2, 6, 8, 9, 19, 26, 27) THEN NULL ELSE 'HTTP/1.0' END AS protocol_version,
         CAST(CASE WHEN k IN (0, 1, 3, 25, 26, 27) THEN 0 WHEN k = 20 THEN 404 ELSE code END AS INTEGER) AS status_code,
         CAST(CASE WHEN k IN (0, 1, 3, 4, 5, 17, 21, 25, 26, 27) THEN 0 WHEN k = 20 THEN -5 ELSE size END AS BIGINT)
           AS bytes_transferred,
         CAST(CASE WHEN k IN (0, 1, 10, 11, 26) THEN 0 ELSE isoyear(moment) * 100 + weekofyear(moment) END AS INTEGER)
           AS batch_id,
         k IN (0, 1, 2, 3, 11, 22, 25, 26, 27) AS malformed
  FROM stamps
),
valid AS (SELECT * FROM records WHERE NOT malformed)"""
)

_LINES = (
    _FORMS
    + """,
pieces AS (
  SELECT *,
         CASE k
           WHEN 2 THEN 'GET ' || path || ' x HTTP/1.0'
           WHEN 6 THEN 'GET ' || path
           WHEN 7 THEN 'GET HTTP/1.0'
           WHEN 8 THEN path
           WHEN 9 THEN ''
           WHEN 13 THEN chr(9) || 'GET  ' || path || ' HTTP/1.0 '
           WHEN 14 THEN 'HTTP/1.0'
           WHEN 15 THEN 'HTTP/1.0 ' || path
           WHEN 19 THEN 'GET'
           WHEN 28 THEN 'GET /é' || path || ' HTTP/1.0'
           ELSE 'GET ' || path || ' HTTP/1.0'
         END AS request,
         CASE k WHEN 3 THEN 'abc' WHEN 20 THEN '+404' WHEN 25 THEN code || '.5' ELSE code || '' END
         || CASE k WHEN 4 THEN ' -' WHEN 5 THEN '' WHEN 17 THEN ' xyz' WHEN 20 THEN ' -5'
                   WHEN 21 THEN ' 99999999999999999999' ELSE ' ' || size END AS rest
  FROM stamps
),
lines AS (
  SELECT event_id,
         CASE WHEN event_id % 80 = 0 THEN ''
              WHEN k = 0 THEN ' ' || chr(9) || ' '
              WHEN k = 1 THEN any_host || ' - - "' || request || '" ' || rest
              WHEN k = 26 THEN 'nospace' || event_id
              WHEN k = 27 THEN any_host || ' - - [' || stamp || '] "' || request || ' ' || rest
              ELSE any_host || ' - - [' || stamp || '] "' || request || '" ' || rest END AS value
  FROM pieces
)"""
)

_RECORD = (
    "host, timestamp, log_date, log_hour, http_method, resource_path, protocol_version, "
    "status_code, bytes_transferred, batch_id, malformed"
)

_Q1 = """
q1 AS (
  SELECT batch_id, log_date, status_code, count(*) AS request_count,
         CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes
  FROM valid GROUP BY ALL
)"""

_STATS = """
stats AS (
  SELECT batch_id, coalesce(nullif(resource_path, ''), '(empty)') AS resource_path, count(*) AS request_count,
         CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, count(DISTINCT host) AS distinct_host_count
  FROM valid GROUP BY batch_id, coalesce(nullif(resource_path, ''), '(empty)')
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY request_count DESC, resource_path) AS rn FROM stats
),
q2 AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn <= 20)"""

# Rates are rounded half up, in whole numbers.
_Q3 = """
counted AS (
  SELECT batch_id, log_date, log_hour,
         count(*) FILTER (status_code BETWEEN 400 AND 599) AS error_request_count,
         count(*) AS total_request_count,
         count(DISTINCT host) FILTER (status_code BETWEEN 400 AND 599) AS distinct_error_hosts
  FROM valid GROUP BY batch_id, log_date, log_hour
),
q3 AS (
  SELECT batch_id, log_date, log_hour, error_request_count, total_request_count,
         ((2 * 1000000 * error_request_count + total_request_count) // (2 * total_request_count)) / 1000000.0
           AS error_rate,
         distinct_error_hosts
  FROM counted
)"""

_COUNTS = """
counts AS (SELECT batch_id, count(*) AS record_count FROM valid GROUP BY batch_id)"""

# 31 February 2024 is stored as 2 March.
_STORED_DATE = "CASE WHEN log_date = '2024-02-31' THEN '2024-03-02' ELSE log_date END"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_SLICES = (
    _with(
        _RECORDS,
        _COUNTS,
        """
timed AS (
  SELECT q.query_name, q.runtime, batch_id, record_count,
         CAST(q.runtime AS DOUBLE) * record_count / sum(record_count) OVER (PARTITION BY q.query_name) AS exact
  FROM counts, (VALUES ('Q1', 1234), ('Q2', 98765), ('Q3', 7)) AS q(query_name, runtime)
),
shared AS (
  SELECT *, CAST(floor(exact) AS BIGINT) AS share,
         row_number() OVER (PARTITION BY query_name ORDER BY exact - floor(exact) DESC, batch_id) AS rn,
         runtime - sum(CAST(floor(exact) AS BIGINT)) OVER (PARTITION BY query_name) AS left_over
  FROM timed
)""",
    )
    + """SELECT query_name, batch_id, record_count,
       CAST(share + CASE WHEN rn <= left_over THEN 1 ELSE 0 END AS BIGINT) AS batch_runtime_ms FROM shared"""
)

_RUNS = """
runs AS (
  SELECT CAST(1 AS INTEGER) AS run_id, 'Spark' AS pipeline_name, CAST(10000 AS INTEGER) AS batch_size,
         CAST(count(DISTINCT batch_id) FILTER (NOT malformed) AS INTEGER) AS total_batches,
         coalesce(count(*) FILTER (NOT malformed)
                  / nullif(CAST(count(DISTINCT batch_id) FILTER (NOT malformed) AS DOUBLE), 0), 0.0) AS avg_batch_size,
         count(*) FILTER (NOT malformed) AS total_records, count(*) FILTER (malformed) AS malformed_count,
         CAST(1234 AS BIGINT) AS q1_runtime_ms, CAST(98765 AS BIGINT) AS q2_runtime_ms,
         CAST(7 AS BIGINT) AS q3_runtime_ms, CAST(100006 AS BIGINT) AS runtime_ms
  FROM records
)"""

_BLANKED = """SELECT event_id,
       CASE WHEN malformed {keep_rule} THEN '' ELSE coalesce(host, '') END AS host,
       CASE WHEN malformed {keep_rule} THEN '' ELSE coalesce(log_date, '') END AS log_date,
       CASE WHEN malformed {keep_rule} THEN 0 ELSE log_hour END AS log_hour,
       CASE WHEN malformed {keep_rule} THEN '' ELSE coalesce(http_method, '') END AS http_method,
       CASE WHEN malformed {keep_rule} THEN '' ELSE coalesce(resource_path, '') END AS resource_path,
       CASE WHEN malformed {keep_rule} THEN '' ELSE coalesce(protocol_version, '') END AS protocol_version,
       CASE WHEN malformed {keep_rule} THEN 0 ELSE status_code END AS status_code,
       CASE WHEN malformed {keep_rule} THEN 0 ELSE bytes_transferred END AS bytes_transferred,
       CASE WHEN malformed THEN 0 ELSE batch_id END AS batch_id,
       CAST(malformed AS INTEGER) AS malformed
FROM records"""

_STAGED = """SELECT host, log_date, log_hour, coalesce(http_method, '') AS http_method,
       coalesce(resource_path, '') AS resource_path, coalesce(protocol_version, '') AS protocol_version,
       status_code, bytes_transferred, batch_id, malformed FROM valid"""

_R = _with(_RECORDS)
_WITH_Q1 = _with(_RECORDS, _Q1)
_WITH_STATS = _with(_RECORDS, _STATS)
_WITH_Q3 = _with(_RECORDS, _Q3)

_COUNTERS = """SELECT count(*) AS total_lines, count(*) FILTER (NOT malformed) AS valid_records,
       count(*) FILTER (malformed) AS malformed_records FROM records"""

ORACLES: dict[str, str] = {
    "scan_lines": _with(_LINES) + "SELECT value FROM lines",
    "scan_latin1": _with(_LINES) + "SELECT value FROM lines",
    "scan_lines_view": _with(_LINES) + "SELECT nullif(value, '') AS line, count(*) AS copies FROM lines GROUP BY 1",
    "filter_blank": _with(_LINES) + "SELECT event_id, value FROM lines WHERE trim(value, ' ') <> ''",
    "parse_fields": _R + f"SELECT event_id, {_RECORD} FROM records",
    "filter_valid": _R + f"SELECT event_id, {_RECORD} FROM valid",
    "malformed_rows": _R + f"SELECT event_id, {_RECORD} FROM records WHERE malformed",
    "blank_malformed": _R + _BLANKED.format(keep_rule=""),
    "fill_missing": _R + _BLANKED.format(keep_rule="AND FALSE"),
    "week_batch_id": _R
    + """SELECT log_date, CAST(count(*) AS BIGINT) AS lines,
         CASE WHEN log_date IS NULL OR log_date = '2024-02-31' THEN 0 ELSE max(batch_id) END AS week
       FROM records GROUP BY log_date""",
    "normalize_path": _R
    + "SELECT event_id, coalesce(nullif(resource_path, ''), '(empty)') AS resource_path FROM valid",
    "flag_errors": _R
    + "SELECT event_id, status_code, status_code >= 400 AND status_code <= 599 AS is_error FROM valid",
    "etl_counters": _R
    + """SELECT count(*) AS total_lines, count(*) FILTER (NOT malformed) AS valid_records,
         count(*) FILTER (malformed) AS malformed_records FROM records""",
    "batch_catalog": _R + "SELECT DISTINCT batch_id FROM valid",
    "batch_record_counts": _with(_RECORDS, _COUNTS) + "SELECT * FROM counts",
    "valid_per_batch": _with(_RECORDS, _COUNTS) + "SELECT * FROM counts",
    "q1_daily_traffic": _WITH_Q1 + "SELECT * FROM q1",
    "resource_stats": _WITH_STATS + "SELECT * FROM stats",
    "resource_ranks": _WITH_STATS + "SELECT * FROM ranked",
    "host_sets": _WITH_STATS + "SELECT batch_id, resource_path, distinct_host_count FROM stats",
    "q2_top_resources": _WITH_STATS + "SELECT * FROM q2",
    "q2_top_resources_array": _WITH_STATS + "SELECT * FROM q2",
    "q2_top_resources_global": _R
    + """SELECT coalesce(nullif(resource_path, ''), '(empty)') AS resource_path, count(*) AS request_count,
         CAST(sum(bytes_transferred) AS BIGINT) AS total_bytes, count(DISTINCT host) AS distinct_host_count
       FROM valid GROUP BY 1 ORDER BY request_count DESC, 1 LIMIT 20""",
    "q3_hourly_error": _WITH_Q3 + "SELECT * FROM q3",
    "stage_write": _R + _STAGED,
    "stage_write_orc": _R + _STAGED,
    "stage_scan_pruned": _WITH_Q1 + "SELECT * FROM q1 WHERE batch_id <> 0",
    "sql_over_stage": _WITH_STATS + "SELECT * FROM q2",
    "audit_stage": _R + f"SELECT {_RECORD} FROM records",
    "audit_two_loads": _R + f"SELECT {_RECORD} FROM records",
    "parsed_view": _R + f"SELECT {_RECORD[:_RECORD.index('malformed')]}CAST(malformed AS INTEGER) AS malformed FROM records",
    "stream_ingest": _R + f"SELECT {_RECORD} FROM records",
    "tsv_roundtrip": _WITH_Q1 + "SELECT * FROM q1",
    "tsv_roundtrip_q2": _WITH_STATS + "SELECT * FROM q2",
    "tsv_roundtrip_q3": _WITH_Q3 + "SELECT * FROM q3",
    "run_through_text": _WITH_STATS + "SELECT CAST(1 AS INTEGER) AS run_id, * FROM q2",
    "run_one_query": _WITH_Q3
    + """SELECT CAST(1 AS INTEGER) AS query, CAST(0 AS BIGINT) AS result_rows UNION ALL SELECT 2, 0
         UNION ALL SELECT 3, count(*) FROM q3""",
    "report_totals": _with(_RECORDS, _Q1, _Q3)
    + """SELECT 'q1_daily_traffic' AS listing, count(*) AS total_rows FROM q1
         UNION ALL SELECT 'q3_hourly_error', count(*) FROM q3""",
    "runtime_slices": _SLICES,
    "run_metadata": _with(_RECORDS, _RUNS) + "SELECT * FROM runs",
    "latest_run": _with(_RECORDS, _RUNS)
    + """SELECT CAST(max(id) AS INTEGER) AS run_id, total_records FROM runs, (VALUES (1), (2), (3)) AS v(id)
         GROUP BY total_records""",
    "report_batches": _SLICES.replace("SELECT query_name,", "SELECT CAST(1 AS INTEGER) AS run_id, query_name,"),
    "report_q1": _WITH_Q1
    + f"""SELECT CAST(1 AS INTEGER) AS run_id, batch_id, {_STORED_DATE} AS log_date, status_code, request_count,
          total_bytes FROM q1""",
    "report_q2": _WITH_STATS
    + """SELECT CAST(1 AS INTEGER) AS run_id, batch_id,
         CASE WHEN length(resource_path) > 44 THEN left(resource_path, 41) || '...' ELSE resource_path END
           AS resource_path, request_count, total_bytes, distinct_host_count FROM q2""",
    "report_q3": _WITH_Q3
    + f"""SELECT CAST(1 AS INTEGER) AS run_id, batch_id, {_STORED_DATE} AS log_date, log_hour, error_request_count,
          total_request_count,
          CAST(CAST(round(CAST(error_rate AS DECIMAL(18, 6)), 4) AS DECIMAL(18, 4)) AS VARCHAR) AS error_rate,
          distinct_error_hosts FROM q3""",
    "report_run": _with(_RECORDS, _RUNS)
    + "SELECT * REPLACE (CAST(CAST(avg_batch_size AS DECIMAL(18, 1)) AS VARCHAR) AS avg_batch_size) FROM runs",
    "report_with_run": _with(_RECORDS, _Q1, _RUNS)
    + f"""SELECT CAST(1 AS INTEGER) AS run_id, batch_id, {_STORED_DATE} AS log_date, status_code, request_count,
          total_bytes, pipeline_name, total_records FROM q1, runs""",
    "whole_run": _with(_RECORDS, _COUNTS, _RUNS)
    + """SELECT run_id, pipeline_name, batch_size, total_batches, avg_batch_size, total_records, malformed_count,
         query_name, batch_id, record_count
       FROM runs, counts, (VALUES ('Q1'), ('Q2'), ('Q3')) AS q(query_name)""",
    "observed_counters": _R + _COUNTERS,
    "observed_batches": _with(_RECORDS, _COUNTS) + "SELECT * FROM counts",
    "stream_counters": _R + _COUNTERS,
    "q1_by_batch": _WITH_Q1 + "SELECT * FROM q1",
    "q2_by_batch": _WITH_STATS + "SELECT * FROM q2",
    "q3_by_batch": _WITH_Q3 + "SELECT * FROM q3",
    "parse_log_line_sql": _R + f"SELECT event_id, {_RECORD} FROM records",
    "table_raw_logs": _with(_LINES) + "SELECT value AS line, count(*) AS copies FROM lines GROUP BY 1",
    "table_audit": _R + f"SELECT {_RECORD} FROM records",
    "table_batch_ids": _R + "SELECT DISTINCT batch_id FROM valid",
    "table_top_resources": _WITH_STATS + "SELECT * FROM q2",
    "table_q3_hourly_error": _WITH_Q3 + "SELECT * FROM q3",
    "compacted_stage": _R + f"SELECT {_RECORD} FROM records",
    "run_history": _with(_RECORDS, _RUNS)
    + """SELECT run_id, 'finished' AS event, total_batches, total_records, malformed_count FROM runs
         UNION ALL SELECT 2, 'failed', 0, 0, 0 UNION ALL SELECT 3, 'started', 0, 0, 0""",
    "top_rows_sql": _WITH_STATS
    + """SELECT batch_id, resource_path, request_count,
         CAST(row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, place) - 1 AS INTEGER) AS place
       FROM (
         SELECT batch_id, resource_path, CAST(request_count AS VARCHAR) AS request_count, request_count AS n, resource_path AS place
         FROM q2
         UNION ALL SELECT DISTINCT batch_id, '/no-number', 'many', 0, '0' FROM q2
         UNION ALL SELECT DISTINCT batch_id, '/no-count', NULL, 0, '1' FROM q2)""",
    "run_side_by_side": _WITH_Q3
    + f"SELECT CAST(1 AS INTEGER) AS run_id, * REPLACE ({_STORED_DATE} AS log_date) FROM q3",
}
