"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement runs on the test tables registered as views and must return
the same columns, by name and type, as the Spark builder of the same name.
"""

from __future__ import annotations

DIM = """dim AS (
  SELECT c.c_custkey AS user_id, c.c_name, n.n_name, c.c_mktsegment,
         CASE c.c_mktsegment WHEN 'FURNITURE' THEN 20.0::DOUBLE WHEN 'HOUSEHOLD' THEN 10.0::DOUBLE
              WHEN 'MACHINERY' THEN 15.0::DOUBLE ELSE NULL::DOUBLE END AS alarm_low,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 60.0::DOUBLE WHEN 'HOUSEHOLD' THEN 80.0::DOUBLE
              WHEN 'MACHINERY' THEN 75.0::DOUBLE ELSE NULL::DOUBLE END AS alarm_high
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

LATEST = """latest AS (
  SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value,
         arg_max(event_type, ts) AS event_type, arg_max(event_id, ts) AS event_id
  FROM events GROUP BY user_id
)"""

ENRICHED = """enriched AS (
  SELECT l.user_id, l.ts, l.value, l.event_type, l.event_id,
         d.c_name, d.n_name, d.c_mktsegment, d.alarm_low, d.alarm_high
  FROM latest l LEFT JOIN dim d ON l.user_id = d.user_id
)"""

STATUS = """CASE WHEN alarm_high IS NOT NULL AND value > alarm_high THEN 'HIGH'
            WHEN alarm_low IS NOT NULL AND value < alarm_low THEN 'LOW' ELSE 'OK' END"""

LIVE = f"""live AS (
  SELECT *, {STATUS} AS status FROM enriched
)"""

UPD = "ts + to_milliseconds(event_id % 5000)"

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
WINDOW = "INTERVAL 10 DAY"

BASE = f"WITH {DIM},\n{LATEST},\n{ENRICHED},\n{LIVE}\n"

SQL: dict[str, str] = {}

SQL["latest_per_key"] = f"WITH {LATEST} SELECT * FROM latest"

SQL["enrich_left"] = BASE + "SELECT * FROM enriched"

SQL["status_classify"] = f"""WITH {DIM}
SELECT e.event_id, e.user_id, e.value, d.alarm_low, d.alarm_high,
       {STATUS.replace('alarm_', 'd.alarm_').replace('value', 'e.value')} AS status
FROM events e LEFT JOIN dim d ON e.user_id = d.user_id"""

LIVE_COLS = ("user_id, ts, value, event_type, event_id, c_name, n_name, c_mktsegment, "
             "alarm_low, alarm_high, status")

SQL["stream_scan_count"] = "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type"

SQL["insert_only_stream"] = "SELECT event_id, user_id, event_type, ts, value FROM events"

SQL["live_state"] = BASE + f"SELECT {LIVE_COLS} FROM live"

SQL["stream_dir_scan"] = SQL["stream_scan_count"]

SQL["stream_restart"] = "SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value FROM events GROUP BY user_id"

SQL["live_state_stateless"] = BASE + f"SELECT {LIVE_COLS} FROM live"

SQL["composite_key_upsert"] = """SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value
FROM events GROUP BY user_id, event_type"""

SQL["point_lookup"] = BASE + f"SELECT {LIVE_COLS} FROM live WHERE user_id = 7"

SQL["wire_timestamp"] = """SELECT event_id, epoch_us(ts) AS ts_micros, make_timestamp(epoch_us(ts)) AS ts_back,
       value, CAST(192 AS INTEGER) AS quality_code, make_timestamp(epoch_us(ts)) = ts AS same
FROM events"""

SQL["json_parse"] = """SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
       count(CAST(json_extract(props, '$.k') AS INTEGER)) AS k_count
FROM events GROUP BY event_type"""

SQL["clip_range"] = """SELECT event_id, value,
       CASE WHEN value IS NOT NULL THEN round(least(100.0::DOUBLE, greatest(1.0::DOUBLE, value)), 3) END AS clipped
FROM events"""

SQL["dim_expand"] = """WITH kinds AS (
  SELECT p_type, min(p_partkey) AS first, min(p_size) AS low, max(p_size) AS high FROM part GROUP BY p_type),
specs AS (
  SELECT r.r_name AS type, upper(p_type) AS key, lower(p_type) AS measurement_type,
         CASE WHEN low > 1 THEN CAST(low AS DOUBLE) END AS alarm_low, CAST(high AS DOUBLE) AS alarm_high
  FROM (SELECT *, first % 5 AS rest FROM kinds UNION ALL SELECT *, (first + 2) % 5 FROM kinds) k
  JOIN region r ON r.r_regionkey % 5 = k.rest),
plants AS (
  SELECT n.n_name AS site_code, r.r_name AS type, upper(substr(r.r_name, 1, 3)) AS unit_prefix,
         n.n_nationkey % 3 + 1 AS num_units
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)
SELECT printf('%s-%s%02d-%s', p.site_code, p.unit_prefix, g.u, s.key) AS sensor_asset_id,
       printf('%s_%s%02d_%s_PV', p.site_code, p.unit_prefix, g.u, s.key) AS scada_tag,
       p.site_code, p.type, printf('%s-%s%02d', p.site_code, p.unit_prefix, g.u) AS unit_id,
       s.measurement_type, 'pcs' AS unit_of_measure, s.alarm_low, s.alarm_high
FROM plants p JOIN specs s ON s.type = p.type, generate_series(1, p.num_units) AS g(u)"""

SQL["alarms_now"] = BASE + """SELECT user_id, ts, value, status, c_mktsegment FROM live
WHERE status <> 'OK' ORDER BY ts DESC"""

SQL["recent_updates"] = BASE + f"""SELECT user_id, {UPD} AS upd, ts, value, status FROM live
ORDER BY upd DESC, user_id LIMIT 20"""

SQL["alarm_counts"] = BASE + """SELECT count(*) FILTER (WHERE status = 'HIGH') AS high,
       count(*) FILTER (WHERE status = 'LOW') AS low, count(*) AS total FROM live"""

SQL["status_breakdown"] = BASE + "SELECT status, count(*) AS rows FROM live GROUP BY status"

_WIN = f"upd > {AS_OF} - {WINDOW}"
SQL["landing_report"] = f"""WITH {LATEST},
u AS (SELECT user_id, ts, {UPD} AS upd FROM latest)
SELECT count(*) AS total,
       count(*) FILTER (WHERE {_WIN}) AS win_upserts,
       count(DISTINCT user_id) FILTER (WHERE {_WIN}) AS win_sensors,
       round((epoch_us({AS_OF}) - epoch_us(max(upd))) / 1000.0::DOUBLE) AS staleness_ms,
       round(quantile_cont((epoch_us(upd) - epoch_us(ts)) / 1000.0::DOUBLE / 1000.0::DOUBLE, 0.5)
             FILTER (WHERE {_WIN}) * 1000) AS p50_ms,
       round(quantile_cont((epoch_us(upd) - epoch_us(ts)) / 1000.0::DOUBLE / 1000.0::DOUBLE, 0.95)
             FILTER (WHERE {_WIN}) * 1000) AS p95_ms,
       count(*) FILTER (WHERE {_WIN}) / 864000.0::DOUBLE AS upserts_per_s
FROM u"""

PROGRESS = """progress AS (
  SELECT date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', hour) AS batch_id,
         hour + INTERVAL 1 HOUR AS event_ts,
         n AS num_input_rows,
         CASE WHEN hour(hour) >= 3 THEN users ELSE -1 END AS num_output_rows,
         n / 3600.0::DOUBLE AS input_rps,
         n * 1000.0::DOUBLE / (id_span + 1) AS processed_rps,
         CASE WHEN hour(hour) >= 5 THEN CAST(id_span AS DOUBLE) END AS batch_duration_ms
  FROM (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(DISTINCT user_id) AS users,
               max(event_id) - min(event_id) AS id_span
        FROM events GROUP BY 1)
)"""

SQL["progress_parse"] = f"WITH {PROGRESS} SELECT * FROM progress"

SQL["progress_report"] = f"""WITH {PROGRESS}
SELECT count(*) AS batches,
       CAST(coalesce(sum(num_input_rows), 0) AS BIGINT) AS in_rows,
       CAST(coalesce(sum(nullif(num_output_rows, -1)), 0) AS BIGINT) AS out_rows,
       round(avg(processed_rps)) AS proc_rps,
       round(avg(batch_duration_ms)) AS batch_ms,
       bool_or(num_output_rows = -1) AS out_unknown,
       CAST(coalesce(sum(nullif(num_output_rows, -1)), 0) AS BIGINT) / 864000.0::DOUBLE AS writes_per_s
FROM progress WHERE event_ts > {AS_OF} - {WINDOW}"""

SQL["progress_running_total"] = """SELECT day, rows, CAST(sum(rows) OVER (ORDER BY day) AS BIGINT) AS cumulative_rows
FROM (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, count(*) AS rows FROM events GROUP BY 1)"""

FIFO = """s AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
      FROM events WHERE event_type = 'click'),
a AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
      FROM events WHERE event_type = 'view'),
m AS (SELECT coalesce(s.user_id, a.user_id) AS user_id, coalesce(s.n, a.n) AS n,
             s.ts AS sent_ts, a.ts AS acked_ts,
             (epoch_us(a.ts) - epoch_us(s.ts)) / 1000.0::DOUBLE AS latency_ms
      FROM s FULL OUTER JOIN a ON s.user_id = a.user_id AND s.n = a.n)"""

SQL["fifo_match"] = f"WITH {FIFO} SELECT user_id, n, sent_ts, acked_ts, latency_ms FROM m"
SQL["fifo_match_stream"] = SQL["fifo_match"] + " WHERE sent_ts IS NOT NULL AND acked_ts IS NOT NULL"


def _nearest(value: str, group: str, src: str, names: dict[str, float], where: str = "") -> str:
    picks = ",\n       ".join(
        f"max({value}) FILTER (WHERE i = least(c - 1, CAST(round_even((c - 1) * {q}::DOUBLE, 0) AS BIGINT))) AS {n}"
        for n, q in names.items())
    return f"""(SELECT {group}, {picks}
 FROM (SELECT {group}, {value}, row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS i,
              count(*) OVER (PARTITION BY {group}) AS c
       FROM {src} WHERE {value} IS NOT NULL {where}) GROUP BY {group})"""


SQL["nearest_rank"] = "SELECT * FROM " + _nearest("value", "event_type", "events", {"p50": 0.5, "p95": 0.95})

SQL["delivery_report"] = f"""WITH {FIFO},
pct AS {_nearest("latency_ms", "user_id", "m", {"p50_ms": 0.5, "p95_ms": 0.95})},
cnt AS (SELECT user_id, count(sent_ts) AS sent, count(acked_ts) AS acked,
               count(*) FILTER (WHERE sent_ts IS NOT NULL AND acked_ts IS NULL) AS in_flight,
               max(latency_ms) AS max_ms
        FROM m GROUP BY user_id)
SELECT coalesce(cnt.user_id, e.user_id) AS user_id, coalesce(sent, 0) AS sent, coalesce(acked, 0) AS acked,
       coalesce(in_flight, 0) AS in_flight, max_ms, pct.p50_ms, pct.p95_ms, coalesce(e.errors, 0) AS errors
FROM cnt LEFT JOIN pct ON cnt.user_id = pct.user_id
FULL JOIN (SELECT user_id, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY user_id) e ON e.user_id = cnt.user_id"""

SQL["delivery_per_second"] = f"""WITH {FIFO},
x AS (SELECT date_trunc('second', sent_ts) AS second, 1 AS s, 0 AS a, 0 AS e, 0 AS k, NULL::DOUBLE AS latency_ms FROM m WHERE sent_ts IS NOT NULL
      UNION ALL SELECT date_trunc('second', acked_ts), 0, 1, 0, CASE WHEN sent_ts IS NULL THEN 0 ELSE 1 END, latency_ms FROM m WHERE acked_ts IS NOT NULL
      UNION ALL SELECT date_trunc('second', ts), 0, 0, 1, 0, NULL FROM events WHERE event_type = 'error'),
per AS (SELECT second, CAST(sum(s) AS BIGINT) AS sent, CAST(sum(a) AS BIGINT) AS acked, CAST(sum(e) AS BIGINT) AS errors,
               sum(s) - sum(k) AS d, max(latency_ms) AS max_ms FROM x GROUP BY second),
pct AS {_nearest("latency_ms", "second", "x", {"p50_ms": 0.5, "p95_ms": 0.95})}
SELECT per.second, sent, acked, errors, max_ms, CAST(sum(d) OVER (ORDER BY per.second) AS BIGINT) AS in_flight, p50_ms, p95_ms
FROM per LEFT JOIN pct ON pct.second = per.second"""

SQL["delivery_stream"] = f"""WITH {FIFO},
x AS (SELECT date_trunc('second', sent_ts) AS second, 1 AS s, 0 AS a, 0 AS e, NULL::DOUBLE AS latency_ms FROM m WHERE sent_ts IS NOT NULL
      UNION ALL SELECT date_trunc('second', acked_ts), 0, 1, 0, NULL FROM m WHERE acked_ts IS NOT NULL
      UNION ALL SELECT date_trunc('second', greatest(sent_ts, acked_ts)), 0, 0, 0, latency_ms FROM m WHERE latency_ms IS NOT NULL
      UNION ALL SELECT date_trunc('second', ts), 0, 0, 1, NULL FROM events WHERE event_type = 'error'),
per AS (SELECT second, CAST(sum(s) AS BIGINT) AS sent, CAST(sum(a) AS BIGINT) AS acked, CAST(sum(e) AS BIGINT) AS errors,
               count(latency_ms) AS matched, max(latency_ms) AS max_ms FROM x GROUP BY second),
pct AS {_nearest("latency_ms", "second", "x", {"p50_ms": 0.5, "p95_ms": 0.95})}
SELECT per.second, sent, acked, errors, matched, max_ms, CAST(sum(sent - matched) OVER (ORDER BY per.second) AS BIGINT) AS in_flight, p50_ms, p95_ms
FROM per LEFT JOIN pct ON pct.second = per.second"""

SQL["delivery_overall"] = f"""WITH {FIFO},
g AS (SELECT *, 0 AS one FROM m),
pct AS {_nearest("latency_ms", "one", "g", {"p50_ms": 0.5, "p95_ms": 0.95})}
SELECT count(sent_ts) AS sent, count(acked_ts) AS acked, count(*) FILTER (WHERE sent_ts IS NOT NULL AND acked_ts IS NULL) AS in_flight,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS errors,
       CASE WHEN max(acked_ts) > min(sent_ts) THEN count(acked_ts) * 1000.0::DOUBLE / ((epoch_us(max(acked_ts)) - epoch_us(min(sent_ts))) / 1000.0::DOUBLE) END AS acked_per_s,
       max(latency_ms) AS max_ms, (SELECT p50_ms FROM pct) AS p50_ms, (SELECT p95_ms FROM pct) AS p95_ms
FROM m"""

SQL["history_append"] = """SELECT 'S' || CAST(user_id % 7 AS VARCHAR) AS site_code, count(*) AS readings, max(value) AS max_value
FROM events GROUP BY 1"""

SQL["history_clustered"] = """WITH r AS (SELECT event_type AS scada_tag, 'S' || CAST(user_id % 7 AS VARCHAR) AS site, ts, value FROM events)
SELECT scada_tag, 'site' AS filter, count(*) AS readings, max(value) AS max_value, max(ts) AS newest FROM r WHERE site = 'S3' GROUP BY 1
UNION ALL
SELECT scada_tag, 'day', count(*), max(value), max(ts) FROM r
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00' GROUP BY 1"""

SQL["sync_triggered"] = """SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type,
       arg_max(event_id, ts) AS event_id FROM events GROUP BY user_id"""

SQL["keyed_changes"] = """WITH v2 AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders
  UNION ALL SELECT o_orderkey + 10000000, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS change_type,
       a.o_totalprice AS old_o_totalprice, b.o_totalprice AS new_o_totalprice, a.o_orderstatus AS old_o_orderstatus, b.o_orderstatus AS new_o_orderstatus
FROM orders a FULL JOIN v2 b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus"""

SQL["sync_snapshot"] = "SELECT * FROM customer"

SQL["change_history"] = """WITH v2 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus = 'P'
)
SELECT * FROM (
  SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
         CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete'
              WHEN a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
                OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_orderdate IS DISTINCT FROM b.o_orderdate
                OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'update' END AS change_type,
         2 AS version,
         a.o_totalprice AS old_o_totalprice, b.o_totalprice AS new_o_totalprice,
         a.o_orderstatus AS old_o_orderstatus, b.o_orderstatus AS new_o_orderstatus
  FROM orders a FULL OUTER JOIN v2 b ON a.o_orderkey = b.o_orderkey
) WHERE change_type IS NOT NULL"""
