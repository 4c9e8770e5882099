"""Equivalent SQL for the registered queries, straight from ``events`` without any log lines."""

from __future__ import annotations

HALF = "TIMESTAMP '2024-01-16'"
LATE = "TIMESTAMP '2024-01-29'"

# mode, epoch seconds, day, position and bucketed amount of every event
_EVENTS = """
ev AS (
  SELECT *, 'u' || user_id AS mode, epoch_us(ts) / 1e6 AS t, date_trunc('day', ts) AS day,
         'dashboard_data_' || strftime(ts, '%Y%m%d') || '_000000.jsnl' AS file_name,
         trunc(epoch_us(ts) / 1e6 * 1e9)::BIGINT AS time_ns,
         floor(value / 10)::DOUBLE AS eq,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

# is there a start message before the line?
_GATED = _EVENTS + """,
gated AS (
  SELECT *, coalesce(max(CASE WHEN event_type = 'signup' THEN 1 END) OVER (
             PARTITION BY user_id ORDER BY day, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS is_open
  FROM ev
),
good AS (SELECT * FROM gated WHERE event_type <> 'signup' AND is_open),
equities AS (SELECT * FROM good WHERE event_type <> 'error')"""

_KEPT = _GATED + """,
compared AS (SELECT *, lag(eq) OVER (PARTITION BY user_id ORDER BY day, event_id) AS prev FROM equities),
kept AS (SELECT * FROM compared WHERE prev IS NULL OR prev <> eq)"""

# malformed variants: what each line turns into
_NOISY = _EVENTS + """,
opened AS (
  SELECT *, coalesce(max(CASE WHEN event_type = 'signup' THEN 1 END) OVER (
             PARTITION BY user_id ORDER BY day, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS is_open
  FROM ev
),
judged AS (
  SELECT *,
    CASE WHEN event_type = 'signup' THEN 'start' WHEN k = 0 THEN 'blank' ELSE 'data' END AS kind,
    CASE WHEN event_type = 'signup' OR k = 0 THEN 'ok'
         WHEN k IN (1, 2) THEN 'bad_json' WHEN k = 6 THEN 'not_object' WHEN k IN (3, 4, 13) THEN 'missing'
         WHEN NOT is_open THEN 'no_config'
         WHEN k = 5 THEN 'bad_timestamp' WHEN k IN (7, 8, 14) THEN 'bad_value' ELSE 'ok' END AS reason,
    CASE WHEN k = 10 THEN 0.0 WHEN k IN (11, 15) THEN 1.0 WHEN k = 9 OR event_type = 'error' THEN NULL
         ELSE eq END::DOUBLE AS line_eq,
    CASE WHEN k IN (10, 15) THEN true WHEN k = 11 THEN false ELSE event_type = 'view' END AS has_others,
    CASE WHEN k IN (10, 11, 15) THEN false ELSE event_type = 'purchase' END AS has_trade
  FROM opened
),
lined AS (SELECT *, kind = 'data' AND reason = 'ok' AND line_eq IS NOT NULL AS stored FROM judged),
noisy_equities AS (
  SELECT *, lag(line_eq) OVER (PARTITION BY user_id ORDER BY day, event_id) AS prev FROM lined WHERE stored
),
noisy_kept AS (SELECT * FROM noisy_equities WHERE prev IS NULL OR prev <> line_eq)"""

_LATER = _EVENTS + f""",
earlier AS (SELECT DISTINCT user_id FROM ev WHERE event_type = 'signup' AND ts < {HALF}),
later AS (
  SELECT ev.*, earlier.user_id IS NOT NULL OR coalesce(max(CASE WHEN event_type = 'signup' THEN 1 END) OVER (
           PARTITION BY ev.user_id ORDER BY day, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS is_open
  FROM ev LEFT JOIN earlier USING (user_id) WHERE ts >= {HALF}
)"""

_REGISTERED_BEFORE = """
  SELECT mode, max(event_id) AS event_id FROM ev
  WHERE event_type = 'signup' AND ts < {until} GROUP BY mode"""

_VIEWS = "SELECT *, file_name AS src FROM good WHERE event_type = 'view'"

_DESIGNATOR = "CASE WHEN event_id % 2 = 0 THEN 'strand_live' ELSE 'strand_simulation' END"

_DAYS = """
  SELECT date_trunc('day', ts) AS day, strftime(ts, '%Y%m%d') AS stamp, count(*) AS n, sum(event_id)::BIGINT AS total
  FROM {source} GROUP BY ALL"""

_DAY_NAME = """CASE WHEN day(day) % 2 = 1 THEN 'export-' || stamp || '.jsnl'
       ELSE 'dashboard_data_' || stamp || '_060000.jsnl' END"""


def _compact(grain: str, prefix: str, pattern: str) -> str:
    return f"""WITH {_GATED}
SELECT mode, '{prefix}_' || strftime(date_trunc('{grain}', ts), '{pattern}') AS period,
       count(*) AS n_rows, min(t) AS first_ts, max(t) AS last_ts
FROM good WHERE event_type = 'view' GROUP BY 1, 2"""


_EQUITY_ON_CHANGE = f"WITH {_KEPT} SELECT mode, time_ns, eq AS equity FROM kept"

ORACLES = {
    "equity_on_change": _EQUITY_ON_CHANGE,
    "equity_all": f"WITH {_GATED} SELECT mode, time_ns, eq AS equity FROM equities",
    "equity_resume": _EQUITY_ON_CHANGE,
    "batch_on_change": _EQUITY_ON_CHANGE,
    "stream_on_change": _EQUITY_ON_CHANGE,
    "equity_noisy": f"WITH {_NOISY} SELECT mode, time_ns, line_eq AS equity FROM noisy_kept",
    "line_stats": f"""WITH {_NOISY},
changes AS (SELECT file_name, count(*) AS n FROM noisy_kept GROUP BY 1),
counts AS (
  SELECT file_name,
    count(*) FILTER (kind = 'data' AND reason <> 'bad_json') AS total_records,
    count(*) FILTER (kind = 'data' AND reason IN ('bad_json', 'not_object', 'bad_timestamp', 'bad_value')) AS invalid_records,
    count(*) FILTER (kind = 'data' AND reason IN ('missing', 'no_config')) AS missing_fields,
    count(*) FILTER (stored) AS with_equity,
    count(*) FILTER (stored AND has_trade) AS trade_records,
    count(*) FILTER (stored AND NOT has_others) AS skipped_db_only_records,
    count(*) FILTER (stored AND has_others) AS archived_rows,
    count(*) FILTER (kind = 'blank') AS empty_lines
  FROM lined GROUP BY 1
)
SELECT file_name, total_records, invalid_records, missing_fields, coalesce(n, 0) AS equity_records, trade_records,
       skipped_db_only_records, with_equity - coalesce(n, 0) AS skipped_equity_records, empty_lines, archived_rows,
       total_records - invalid_records - missing_fields - skipped_db_only_records AS processed,
       CAST(0 AS BIGINT) AS undated_records
FROM counts LEFT JOIN changes USING (file_name)""",
    "line_reasons": f"WITH {_NOISY} SELECT kind, reason, count(*) AS n FROM lined GROUP BY 1, 2",
    "config_gate": f"""WITH {_GATED}
SELECT mode, count(*) FILTER (is_open) AS n_kept, count(*) FILTER (NOT is_open) AS n_dropped
FROM gated WHERE event_type <> 'signup' GROUP BY 1""",
    "registry_gate": f"""WITH {_LATER}
SELECT mode, count(*) FILTER (is_open) AS n_kept, count(*) FILTER (NOT is_open) AS n_dropped
FROM later WHERE event_type <> 'signup' GROUP BY 1""",
    "live_as_of": f"""WITH {_GATED},
flagged AS (
  SELECT *, last_value(CASE WHEN event_type = 'signup' THEN event_id % 2 = 0 END IGNORE NULLS) OVER (
           PARTITION BY user_id ORDER BY day, event_id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS flag
  FROM gated
),
by_day AS (SELECT user_id, day, arg_max(flag, event_id) AS live FROM flagged WHERE flag IS NOT NULL GROUP BY 1, 2)
SELECT mode, time_ns, CAST(coalesce(live, false) AS VARCHAR) AS live
FROM equities LEFT JOIN by_day USING (user_id, day)""",
    "live_after_registry": f"""WITH {_LATER},
ends AS (
  SELECT d.user_id, d.day, arg_max(s.event_id % 2 = 0, s.event_id) AS live
  FROM (SELECT DISTINCT user_id, day FROM later) d
  JOIN (SELECT user_id, day, event_id FROM ev WHERE event_type = 'signup') s
    ON s.user_id = d.user_id AND s.day <= d.day
  GROUP BY 1, 2
)
SELECT mode, CAST(coalesce(live, false) AS VARCHAR) AS live, count(*) AS n_rows
FROM later LEFT JOIN ends USING (user_id, day)
WHERE is_open AND event_type NOT IN ('signup', 'error') GROUP BY 1, 2""",
    "item_classes": f"""WITH {_NOISY},
parsed AS (SELECT * FROM lined WHERE kind = 'data' AND k NOT IN (1, 2, 3, 4, 5, 6, 7, 13, 14)),
usual AS (SELECT * FROM parsed WHERE k NOT IN (8, 9, 10, 11, 15)),
items AS (
  SELECT 'equity' AS cls, 'e' AS tag FROM usual WHERE event_type <> 'error'
  UNION ALL SELECT 'trade', 'open' FROM usual WHERE event_type = 'purchase'
  UNION ALL SELECT 'other', 'c' FROM usual WHERE event_type IN ('view', 'error')
  UNION ALL SELECT 'equity', 'e' FROM parsed WHERE k IN (8, 9, 10, 11, 15)
  UNION ALL SELECT 'trade', 'close' FROM parsed WHERE k = 8
  UNION ALL SELECT 'trade', 'open' FROM parsed WHERE k = 9
  UNION ALL SELECT 'other', 'c' FROM parsed WHERE k IN (9, 10)
  UNION ALL SELECT 'dropped', '0' FROM parsed WHERE k = 15
  UNION ALL SELECT 'other', '0' FROM parsed WHERE k = 15
)
SELECT cls, tag, count(*) AS n FROM items GROUP BY 1, 2""",
    "trades": f"""WITH {_GATED},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY mode, time_ns ORDER BY day DESC, event_id DESC) AS rn
  FROM good WHERE event_type = 'purchase'
)
SELECT time_ns, mode, 'open' AS data_type, 'NAS100_USD' AS instrument, value AS price, 1.0::DOUBLE AS units,
       0.0::DOUBLE AS profit, CAST(event_id AS VARCHAR) AS id
FROM ranked WHERE rn = 1""",
    "trade_table": f"""WITH {_GATED},
ranked AS (
  SELECT *, hour(ts) * 3600000000000 AS key_ns,
         row_number() OVER (PARTITION BY mode, hour(ts) ORDER BY day DESC, event_id DESC) AS rn
  FROM good WHERE event_type = 'purchase'
)
SELECT mode, key_ns::BIGINT AS time_ns, 'open' AS data_type, value AS price, CAST(event_id AS VARCHAR) AS payload_id
FROM ranked WHERE rn = 1""",
    "upsert_equity": f"""WITH {_GATED},
ranked AS (
  SELECT *, hour(ts) * 3600000000000 AS key_ns,
         row_number() OVER (PARTITION BY mode, hour(ts) ORDER BY day DESC, event_id DESC) AS rn
  FROM equities
)
SELECT mode, key_ns::BIGINT AS time_ns, eq AS equity FROM ranked WHERE rn = 1""",
    "archive_rows": f"""WITH {_GATED}
SELECT t AS timestamp, mode, 'strand' AS component, src, value AS close, event_id AS volume, 1::BIGINT AS n_items
FROM ({_VIEWS})""",
    "registry": f"""WITH {_EVENTS},
last_start AS (SELECT mode, max(event_id) AS event_id FROM ev WHERE event_type = 'signup' GROUP BY 1)
SELECT mode, {_DESIGNATOR} AS component, CAST(event_id AS VARCHAR) AS designator,
       CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS live, '2024-02-01T00:00:00' AS processed_at,
       '/etc/strand.json' AS data_config_path, {_DESIGNATOR} AS data_designator,
       CAST(event_id AS VARCHAR) AS data_strand_id,
       CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS data_live,
       '2024-02-01T00:00:00' AS data_processed_at
FROM last_start""",
    "registry_touch": f"""WITH {_EVENTS},
first_rows AS ({_REGISTERED_BEFORE.format(until=LATE)})
SELECT mode, {_DESIGNATOR} AS component, CAST(event_id AS VARCHAR) AS designator, '2024-03-01' AS processed_at,
       'none' AS cached_stats, '2024-03-01' AS data_processed_at
FROM first_rows
WHERE mode IN (SELECT mode FROM ev WHERE ts >= {LATE} AND event_type <> 'signup')
  AND mode NOT IN (SELECT mode FROM ev WHERE ts >= {LATE} AND event_type = 'signup')""",
    "registry_known": f"""WITH {_EVENTS},
first_rows AS ({_REGISTERED_BEFORE.format(until=HALF)}),
last_rows AS (SELECT mode, max(event_id) AS event_id FROM ev WHERE event_type = 'signup' GROUP BY 1),
stored AS (SELECT * FROM first_rows
           UNION ALL SELECT * FROM last_rows WHERE mode NOT IN (SELECT mode FROM first_rows))
SELECT mode, {_DESIGNATOR} AS component, CAST(event_id AS VARCHAR) AS designator FROM stored""",
    "compact_hour": _compact("hour", "hourly", "%Y%m%d%H"),
    "compact_day": _compact("day", "daily", "%Y%m%d"),
    "compact_week": _compact("week", "weekly", "%Y%m%d"),
    "compact_month": _compact("month", "monthly", "%Y%m"),
    "archive_slice": f"""WITH {_GATED}
SELECT t AS timestamp, mode, src FROM ({_VIEWS}) WHERE mode = 'u1' AND t >= 1704412800.0 AND t < 1706140800.0""",
    "stored_time_range": f"""WITH {_GATED}
SELECT 'weekly_' || strftime(date_trunc('week', ts), '%Y%m%d') AS period, CAST(count(*) AS BIGINT) AS n_rows, min(t) AS first_ts, max(t) AS last_ts
FROM good WHERE event_type = 'view' GROUP BY 1""",
    "time_range": f"WITH {_GATED} SELECT min(t) AS first_ts, max(t) AS last_ts FROM ({_VIEWS})",
    "modes": f"WITH {_GATED} SELECT DISTINCT mode FROM ({_VIEWS})",
    "mode_files": f"WITH {_GATED} SELECT mode, src, count(*) AS n_rows FROM ({_VIEWS}) GROUP BY 1, 2",
    "distinct_ts": f"WITH {_GATED} SELECT file_name, count(DISTINCT t) AS n_timestamps FROM good GROUP BY 1",
    "equity_with_candle": f"""WITH {_GATED}
SELECT mode, time_ns, eq AS equity, CASE WHEN event_type = 'view' THEN value END AS open,
       CASE WHEN event_type = 'view' THEN value + 1 END AS high, CASE WHEN event_type = 'view' THEN value - 1 END AS low,
       CASE WHEN event_type = 'view' THEN value END AS close, CASE WHEN event_type = 'view' THEN event_id END AS volume
FROM equities""",
    "pick_files": f"""WITH days AS ({_DAYS.format(source='events')})
SELECT {_DAY_NAME} AS file_name,
       (epoch(day) + CASE WHEN day(day) % 2 = 1 THEN 3600 ELSE 21600 END)::DOUBLE AS file_ts
FROM days ORDER BY file_ts, file_name LIMIT 7""",
    "new_files": f"""WITH days AS ({_DAYS.format(source='events')}),
known AS ({_DAYS.format(source=f"(SELECT * FROM events WHERE ts < {HALF} OR event_type <> 'error')")}),
named AS (SELECT {_DAY_NAME} AS file_name, md5(stamp || ':' || n || ':' || total) AS file_id FROM days),
known_names AS (SELECT {_DAY_NAME} AS file_name, md5(stamp || ':' || n || ':' || total) AS file_id FROM known)
SELECT file_name, file_id, replace(file_name, '.jsnl', '') || '_' || file_id || '.parquet' AS src
FROM named WHERE (file_name, file_id) NOT IN (SELECT (file_name, file_id) FROM known_names)""",
    "partition_names": f"""WITH {_EVENTS}
SELECT DISTINCT mode, 'p_' || substr(md5(mode), 1, 8) AS partition_name FROM ev""",
    "delete_mode": f"""WITH {_GATED},
left_over AS (
  SELECT 'equity' AS table_name, mode FROM equities
  UNION ALL SELECT 'trades', mode FROM good WHERE event_type = 'purchase'
  UNION ALL SELECT DISTINCT 'instances', mode FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT 'archive_week', mode FROM good WHERE event_type = 'view'
)
SELECT table_name, mode, count(*) AS n_rows FROM left_over WHERE mode <> 'u1' GROUP BY 1, 2""",
    "delete_mode_dry": f"""WITH {_GATED}
SELECT 'equity' AS table_name, count(*) AS n_rows FROM equities WHERE mode = 'u1'
UNION ALL SELECT 'trades', count(*) FROM good WHERE event_type = 'purchase' AND mode = 'u1'
UNION ALL SELECT 'instances', count(DISTINCT mode) FROM ev WHERE event_type = 'signup' AND mode = 'u1'
UNION ALL SELECT 'archive_week', count(*) FROM good WHERE event_type = 'view' AND mode = 'u1'""",
}
ORACLES["batch_repeat"] = ORACLES["stream_repeat"] = ORACLES["batch_in_rounds"] = ORACLES["batch_on_change"]
# the files up to their last line before noon, then the rest of them
ORACLES["grown_files"] = f"""WITH {_EVENTS},
noon AS (SELECT day, max(event_id) AS last FROM ev WHERE event_type <> 'signup' AND t - epoch(day) < 43200 GROUP BY day),
runs AS (
  SELECT ev.*, event_id <= coalesce(last, -1) AS early, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS opens
  FROM ev LEFT JOIN noon USING (day)
),
judged AS (
  SELECT *, coalesce(max(opens) OVER (PARTITION BY user_id, early ORDER BY day, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS in_run,
         NOT early AND max(CASE WHEN early THEN opens ELSE 0 END) OVER (PARTITION BY user_id) = 1 AS known
  FROM runs
)
SELECT t AS timestamp, mode FROM judged WHERE event_type = 'view' AND (in_run OR known)"""
ORACLES["stream_then_batch"] = f"""WITH {_GATED}
SELECT 'files' AS table_name, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 'trades', count(*) FROM good WHERE event_type = 'purchase'
UNION ALL SELECT 'instances', count(DISTINCT mode) FROM ev WHERE event_type = 'signup'
UNION ALL SELECT 'archive_week', count(*) FROM ({_VIEWS})"""
ORACLES["compact_merged"] = ORACLES["compact_week"]
# taking the last days in once more changes nothing
ORACLES["upsert_merged"] = ORACLES["upsert_equity"]
