"""DuckDB twins of the named queries, written over the ``events`` table.

Most state the expected result directly; ``cdc_decode`` builds and reads the JSON a second way.
"""

from __future__ import annotations

_RAW = "epoch_us(ts)"
_DENSE = "(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60)"


def _base(dense: bool, place: str = "event_type") -> str:
    """CTEs m (base table) and r (readings)."""
    micros = _DENSE if dense else _RAW
    return f"""
    e AS (SELECT *, {micros} AS us, 'sensor_' || CAST(user_id % 5 + 1 AS VARCHAR) AS sensor_id,
                 CAST(380.0 AS DOUBLE) + value AS co2_level, {place} AS place FROM events),
    m AS (SELECT event_id + 1 AS id, sensor_id, co2_level, make_timestamp(us) AS measurement_time,
                 place AS location FROM e),
    r AS (SELECT event_id AS seq, CASE WHEN event_id % 20 = 3 THEN event_id ELSE event_id + 1 END AS id,
                 sensor_id, co2_level, make_timestamp(us // 1000 * 1000) AS measurement_time,
                 place AS location,
                 CASE event_id % 20 WHEN 2 THEN 'r' WHEN 3 THEN 'u' ELSE 'c' END AS op
          FROM e WHERE event_id % 20 <> 0)"""


def _windows(size: str, measures: str, source: str = "r") -> str:
    return f"""SELECT sensor_id, location,
        time_bucket(INTERVAL '{size}', measurement_time) + INTERVAL '{size}' AS window_end, {measures}
        FROM {source} GROUP BY 1, 2, 3"""


_AVG = "avg(co2_level) AS avg_co2"
_AVG_MIN_MAX = f"{_AVG}, min(co2_level) AS min_co2, max(co2_level) AS max_co2"
_ROUND_MIN_MAX = "sensor_id, location, window_end, round(avg_co2, 9) AS avg_co2, min_co2, max_co2"
# The labels and messages users already see (config.py names them).
_ALERTS = """SELECT sensor_id, location, co2_level, measurement_time AS alert_time,
    CASE WHEN co2_level > 420 THEN 'High CO2 Level Detected' ELSE 'Elevated CO2 Level Detected' END AS message
    FROM r WHERE co2_level > 400"""
_STATUS = """SELECT sensor_id, co2_level,
    CASE WHEN co2_level > 420 THEN 'CRITICAL' WHEN co2_level > 400 THEN 'WARNING' ELSE 'NORMAL' END AS status,
    measurement_time AS last_updated, location
    FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id
          ORDER BY measurement_time DESC, seq DESC, id DESC) AS n FROM r) WHERE n = 1"""
_CLOSED = "(SELECT max(measurement_time) - INTERVAL '5 seconds' FROM r)"
_STATE = """state AS (
    SELECT id, sensor_id, co2_level, make_timestamp(us) AS measurement_time, place AS location FROM (
        SELECT *, CASE WHEN event_id % 20 IN (0, 3) THEN event_id ELSE event_id + 1 END AS id,
               row_number() OVER (PARTITION BY CASE WHEN event_id % 20 IN (0, 3) THEN event_id
                                  ELSE event_id + 1 END ORDER BY event_id DESC) AS n
        FROM e) WHERE n = 1 AND event_id % 20 <> 0)"""
_SUMMARY = """SELECT CAST(measurement_time AS DATE) AS measurement_date, location,
    round(avg(co2_level), 9) AS avg_co2, max(co2_level) AS max_co2,
    count(*) FILTER (WHERE co2_level > 400) AS alerts_count"""
_ALERT_HOURS = f"""SELECT date_trunc('hour', alert_time) AS alert_hour, location, count(*) AS alert_count
    FROM ({_ALERTS}) GROUP BY 1, 2"""

# event_id % 13 of the damaged feed: 1 delete, 2 not JSON, 3 tombstone, 4 no location, 5 quoted
# numbers, 6 text as level, 7 number as sensor id, 8 no payload, 9 empty, 10 object as id, 11 decimal
# id, 12 time with an exponent.
_DIRTY = """d AS (
    SELECT event_id AS seq, event_id % 13 AS k,
        k IN (1, 2, 3, 8, 9) AS lost,
        CASE WHEN lost OR k = 10 THEN NULL ELSE event_id + 1 END AS id,
        CASE WHEN lost THEN NULL WHEN k = 7 THEN CAST(user_id AS VARCHAR)
             ELSE 'sensor_' || CAST(user_id % 5 + 1 AS VARCHAR) END AS sensor_id,
        CASE WHEN lost OR k = 6 THEN NULL ELSE CAST(380.0 AS DOUBLE) + value END AS co2_level,
        CASE WHEN lost THEN NULL ELSE epoch_us(ts) END AS measurement_time,
        CASE WHEN lost OR k = 4 THEN NULL ELSE event_type END AS location,
        CASE WHEN k = 1 THEN 'd' WHEN lost THEN NULL ELSE 'c' END AS op
    FROM events)"""


_VALID = """r AS (SELECT seq, id, sensor_id, co2_level, location,
        make_timestamp(measurement_time // 1000 * 1000) AS measurement_time
    FROM d WHERE id IS NOT NULL AND co2_level IS NOT NULL)"""


def oracle_sql() -> dict[str, str]:
    dense, raw = _base(True), _base(False)
    minute = "SELECT sensor_id, location, window_end, round(avg_co2, 9) AS avg_co2 FROM"
    closed_minutes = f"({_windows('1 minute', _AVG)}) WHERE window_end <= {_CLOSED}"
    closed_hours = f"({_windows('1 hour', _AVG_MIN_MAX)}) WHERE window_end <= {_CLOSED}"
    queries = {
        "cdc_decode": f"""
            WITH {dense},
            row_json AS (SELECT event_id, us, json_object(
                'id', CASE WHEN event_id % 20 IN (0, 3) THEN event_id ELSE event_id + 1 END,
                'sensor_id', sensor_id, 'co2_level', co2_level, 'measurement_time', us,
                'location', place) AS body FROM e),
            doc AS (SELECT event_id AS seq, json_object('payload', json_object(
                'before', CASE WHEN event_id % 20 IN (0, 3) THEN body END,
                'after', CASE WHEN event_id % 20 <> 0 THEN body END,
                'op', CASE event_id % 20 WHEN 0 THEN 'd' WHEN 2 THEN 'r' WHEN 3 THEN 'u' ELSE 'c' END,
                'ts_ms', us // 1000)) AS value FROM row_json)
            SELECT seq, CAST(value ->> '$.payload.after.id' AS BIGINT) AS id,
                value ->> '$.payload.after.sensor_id' AS sensor_id,
                CAST(value ->> '$.payload.after.co2_level' AS DOUBLE) AS co2_level,
                CAST(value ->> '$.payload.after.measurement_time' AS BIGINT) AS measurement_time,
                value ->> '$.payload.after.location' AS location, value ->> '$.payload.op' AS op,
                CAST(value ->> '$.payload.before.id' AS BIGINT) AS before_id,
                CAST(value ->> '$.payload.ts_ms' AS BIGINT) AS ts_ms FROM doc""",
        "cdc_decode_dirty": f"""
            WITH {_DIRTY}
            SELECT seq, id, sensor_id, co2_level, measurement_time, location, op,
                   id IS NOT NULL AS kept FROM d""",
        "readings": f"WITH {dense} SELECT * FROM r",
        "change_op_profile": """
            SELECT CASE event_id % 20 WHEN 0 THEN 'd' WHEN 2 THEN 'r' WHEN 3 THEN 'u' ELSE 'c' END AS op,
                   count(*) AS changes FROM events GROUP BY 1""",
        "table_state_from_changes": f"WITH {raw}, {_STATE} SELECT * FROM state",
        "time_expressions": f"""
            WITH {raw}
            SELECT seq, epoch_ms(measurement_time) AS millis, measurement_time AS local_time,
                time_bucket(INTERVAL '1 minute', measurement_time) + INTERVAL '1 minute' AS minute_end,
                time_bucket(INTERVAL '1 hour', measurement_time) + INTERVAL '1 hour' AS hour_end,
                CAST(extract(hour FROM measurement_time) AS INTEGER) AS hour_of_day,
                CAST(measurement_time AS DATE) AS day,
                CAST(date_trunc('hour', measurement_time) AS TIMESTAMP) AS hour_start,
                measurement_time - INTERVAL '5 seconds' AS watermark_bound,
                measurement_time - INTERVAL '24 hours' AS day_before FROM r""",
        "alerts": f"WITH {dense} {_ALERTS}",
        "status_feed": f"""
            WITH {dense}
            SELECT sensor_id, co2_level, location, measurement_time,
                CASE WHEN co2_level > 420 THEN 'High Warning' WHEN co2_level > 400 THEN 'Warning'
                     ELSE 'Normal' END AS status FROM r WHERE op IN ('r', 'c', 'u')""",
        "current_status": f"WITH {dense} {_STATUS}",
        "avg_1m": f"WITH {dense} {minute} ({_windows('1 minute', _AVG)})",
        "hourly_aggregates": f"WITH {dense} SELECT {_ROUND_MIN_MAX} FROM ({_windows('1 hour', _AVG_MIN_MAX)})",
        "null_location_groups": f"""
            WITH {_base(True, "nullif(event_type, 'error')")}
            SELECT {_ROUND_MIN_MAX} FROM ({_windows('1 hour', _AVG_MIN_MAX)})""",
        "sink_constraint_check": f"""
            WITH {_DIRTY},
            c AS (SELECT *, nullif(concat_ws('; ',
                CASE WHEN id IS NULL THEN 'id is null' END,
                CASE WHEN sensor_id IS NULL THEN 'sensor_id is null' END,
                CASE WHEN length(sensor_id) > 50 THEN 'sensor_id over 50 chars' END,
                CASE WHEN co2_level IS NULL THEN 'co2_level is null' END,
                CASE WHEN measurement_time IS NULL THEN 'measurement_time is null' END,
                CASE WHEN length(CASE WHEN seq % 3 = 0 THEN repeat(location, 30) ELSE location END) > 100
                     THEN 'location over 100 chars' END), '') AS violations FROM d)
            SELECT seq, id, co2_level, violations, violations IS NULL AS is_valid FROM c""",
        "daily_patterns": f"""
            WITH {raw}
            SELECT CAST(extract(hour FROM measurement_time) AS INTEGER) AS hour_of_day, location,
                   round(avg(co2_level), 9) AS avg_co2 FROM m GROUP BY 1, 2""",
        "daily_summary": f"WITH {raw} {_SUMMARY} FROM m GROUP BY 1, 2",
        "daily_summary_from_changes": f"WITH {raw}, {_STATE} {_SUMMARY} FROM state GROUP BY 1, 2",
        "alert_summary_hourly": f"WITH {raw} {_ALERT_HOURS}",
        "sensor_stats_24h": f"""
            WITH {raw}, h AS ({_windows('1 hour', _AVG)})
            SELECT sensor_id, location, window_end AS time_bucket, round(avg_co2, 9) AS hourly_avg,
                round(avg(avg_co2) OVER (PARTITION BY sensor_id ORDER BY window_end
                    RANGE BETWEEN INTERVAL '24 hours' PRECEDING AND CURRENT ROW), 9) AS rolling_24h_avg
            FROM h""",
        "sql_views": f"""
            WITH {raw},
            s AS (SELECT CAST(measurement_time AS DATE) AS measurement_date, location,
                    max(co2_level) AS max_co2, avg(co2_level) AS avg_co2, count(*) FILTER (WHERE co2_level > 400) AS alerts_count
                  FROM m GROUP BY 1, 2),
            a AS (SELECT CAST(alert_time AS DATE) AS alert_date, location, count(*) AS stream_alerts
                  FROM ({_ALERTS}) GROUP BY 1, 2)
            SELECT s.measurement_date, s.location, s.alerts_count,
                   coalesce(a.stream_alerts, 0) AS stream_alerts, round(s.max_co2, 9) AS max_co2,
                   CASE WHEN max_co2 > 420 THEN 'CRITICAL' WHEN max_co2 > 400 THEN 'WARNING' ELSE 'NORMAL' END AS peak_status,
                   CASE WHEN avg_co2 > 420 THEN 'High Warning' WHEN avg_co2 > 400 THEN 'Warning' ELSE 'Normal' END AS usual_label,
                   CASE WHEN max_co2 > 420 THEN 'High CO2 Level Detected' WHEN max_co2 > 400 THEN 'Elevated CO2 Level Detected'
                        END AS peak_message
            FROM s LEFT JOIN a ON a.alert_date = s.measurement_date
                AND a.location IS NOT DISTINCT FROM s.location""",
        "current_status_dirty": f"WITH {_DIRTY}, {_VALID} {_STATUS}",
        "current_status_dirty_stream": f"WITH {_DIRTY}, {_VALID} {_STATUS}",
        "hourly_with_backfill": f"WITH {dense} SELECT {_ROUND_MIN_MAX} FROM {closed_hours}",
        "daily_summary_from_bronze": f"WITH {raw}, {_STATE} {_SUMMARY} FROM state GROUP BY 1, 2",
        "views_over_stored_tables": f"""
            WITH {dense}, {_STATE},
            hours AS (SELECT * FROM {closed_hours}), found AS ({_ALERT_HOURS}),
            h AS (SELECT window_end, location, max(max_co2) AS readings_max FROM hours GROUP BY 1, 2),
            p AS (SELECT extract(hour FROM measurement_time) AS hour_of_day, location,
                    count(*) AS rows_of_hour FROM state GROUP BY 1, 2)
            SELECT h.window_end, h.location, h.readings_max, coalesce(a.alert_count, 0) AS alert_count,
                   p.rows_of_hour, (SELECT count(DISTINCT sensor_id) FROM r) AS sensors
            FROM h LEFT JOIN found a ON a.alert_hour = h.window_end - INTERVAL 1 HOUR
                    AND a.location IS NOT DISTINCT FROM h.location
                LEFT JOIN p ON p.hour_of_day = extract(hour FROM h.window_end - INTERVAL 1 HOUR)
                    AND p.location IS NOT DISTINCT FROM h.location""",
        "cdc_decode_stream": f"""
            WITH {dense} SELECT *, CAST(NULL AS VARCHAR) AS violations,
                CAST(measurement_time AS DATE) AS event_date FROM r""",
        "alerts_stream": f"WITH {dense} {_ALERTS}",
        "avg_1m_stream": f"WITH {dense} {minute} {closed_minutes}",
        "hourly_stream": f"WITH {dense} SELECT {_ROUND_MIN_MAX} FROM {closed_hours}",
        "current_status_stream": f"WITH {dense} {_STATUS}",
        "daily_patterns_from_partials": f"""
            WITH {raw}, {_STATE}
            SELECT CAST(extract(hour FROM measurement_time) AS INTEGER) AS hour_of_day, location,
                   round(avg(co2_level), 9) AS avg_co2 FROM state GROUP BY 1, 2""",
        "quarantine_by_kind": """
            SELECT CASE event_id % 13 WHEN 2 THEN 'unreadable' WHEN 8 THEN 'no payload' WHEN 9 THEN 'empty'
                    ELSE 'no row' END AS problem, count(*) AS documents, min(event_id) AS first_seq,
                max(event_id) AS last_seq, count(*) FILTER (WHERE event_id % 13 = 10) AS with_sensor, 0 AS with_id
            FROM events WHERE event_id % 13 IN (1, 2, 8, 9, 10) GROUP BY 1""",
        "avg_1m_two_sources": f"""
            WITH {dense},
            came AS (SELECT r.*, e.user_id % 5 >= 3 AS second FROM r JOIN e ON e.event_id = r.seq
                WHERE e.us < 1704067200000000 + 43200000000 - CASE WHEN e.user_id % 5 >= 3 THEN 3600000000 ELSE 0 END),
            marks AS (SELECT max(measurement_time) - INTERVAL '5 seconds' AS mark FROM came GROUP BY second)
            {minute} ({_windows('1 minute', _AVG, 'came')}) WHERE window_end <= (SELECT min(mark) FROM marks)""",
        "late_rows": f"""
            WITH {dense},
            placed AS (SELECT r.*, least((epoch_us(make_timestamp(e.us)) - 1704067200000000
                    + CASE WHEN e.event_id % 7 = 3 THEN 5400000000 ELSE 0 END) // 10800000000, 3) AS slice
                  FROM r JOIN e ON e.event_id = r.seq),
            marks AS (SELECT slice, max(max(measurement_time)) OVER (ORDER BY slice
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '5 seconds' AS mark
                  FROM placed GROUP BY slice),
            kept AS (SELECT p.* FROM placed p JOIN marks USING (slice) WHERE mark IS NULL
                OR time_bucket(INTERVAL '1 minute', measurement_time) + INTERVAL '1 minute' > mark)
            {minute} ({_windows('1 minute', _AVG, 'kept')}) WHERE window_end <= {_CLOSED}""",
        "pipeline_all_sinks": f"""
            WITH {dense}, minutes AS (SELECT * FROM {closed_minutes}),
            hours AS (SELECT * FROM {closed_hours}), found AS ({_ALERTS}), latest AS ({_STATUS})
            SELECT 'co2_aggregated' AS output, sensor_id, location, window_end AS "at",
                CAST(NULL AS DOUBLE) AS co2_level, round(avg_co2, 9) AS avg_co2,
                CAST(NULL AS DOUBLE) AS min_co2, CAST(NULL AS DOUBLE) AS max_co2,
                CAST(NULL AS VARCHAR) AS label FROM minutes
            UNION ALL SELECT 'co2_hourly_aggregates', sensor_id, location, window_end, NULL,
                round(avg_co2, 9), round(min_co2, 9), round(max_co2, 9), NULL FROM hours
            UNION ALL SELECT 'co2_alerts', sensor_id, location, alert_time, round(co2_level, 9),
                NULL, NULL, NULL, message FROM found
            UNION ALL SELECT 'current_co2_status', sensor_id, location, last_updated,
                round(co2_level, 9), NULL, NULL, NULL, status FROM latest""",
    }
    queries["current_status_ranked"] = queries["current_status"]
    queries["current_status_upserts"] = queries["current_status"]
    queries["daily_summary_from_partials"] = queries["daily_summary_from_changes"]
    queries["alert_summary_refresh"] = queries["alert_summary_hourly"]
    return queries
