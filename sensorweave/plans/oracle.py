"""DuckDB SQL for the named queries, used to check their results."""

from __future__ import annotations

from sensorweave.sources.config import DEFAULTS


def _raw(
    file_format: str = "%Y-%m-%d", ts: str = "ts", source: str = "concat('sensor_', CAST(user_id AS VARCHAR))"
) -> str:
    """The event adapter in SQL."""
    return f"""
raw AS (
  SELECT event_id * 2 + d AS row_index,
         CASE WHEN event_id % 307 = 0 THEN NULL ELSE {source} END AS sensor_id,
         CASE WHEN event_id % 211 = 0 THEN 'INVALID_TS'
              WHEN event_id % 10 = 1 THEN strftime(t, '%m/%d/%Y %I:%M %p')
              ELSE strftime(t, '%Y-%m-%dT%H:%M:%S') END AS "timestamp",
         CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'humidity'
              WHEN 'signup' THEN 'soil_moisture' WHEN 'error' THEN 'light_intensity' ELSE 'ph_level' END AS reading_type,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value + 1000.0 * d END AS value,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS battery_level,
         concat(strftime(t, '{file_format}'), '.parquet') AS file_name
  FROM (SELECT *, {ts} AS t FROM events), (VALUES (0), (1)) AS dup(d)
  WHERE d = 0 OR event_id % 50 = 0
)"""


_HOURS = "CASE WHEN event_id % 3 = 0 THEN ts ELSE CAST(date_trunc('hour', ts) AS TIMESTAMP) END"
DAY = _raw()
MONTH = _raw("%Y-%m")
MINUTE = _raw("%Y-%m-%dT%H%M")
HOURLY = _raw(ts=_HOURS)
GATEWAY = _raw(source="concat('gateway_', CAST(floor(CAST(json_extract(props, '$.k') AS DOUBLE) / 10) AS BIGINT))")
HOURLY_MONTH = _raw("%Y-%m", _HOURS)

CONFIG = "config(reading_type, lo, hi, m, b) AS (VALUES " + ", ".join(
    f"('{t}', {float(c['min'])}::DOUBLE, {float(c['max'])}::DOUBLE, "
    f"{c['calibration']['multiplier']}::DOUBLE, {c['calibration']['offset']}::DOUBLE)"
    for t, c in DEFAULTS.items()
) + ")"

_BAD = "(value < 0 OR value > 100)"
_BAD_BATTERY = "(battery_level < 0 OR battery_level > 100)"

# Each step reads ``src`` names given by the caller and defines one more CTE.
PARSED = """
parsed AS (
  SELECT *, coalesce(CASE WHEN regexp_matches("timestamp", '^\\d{4}-\\d{2}-\\d{2}') THEN try_cast("timestamp" AS TIMESTAMP) END,
                     try_strptime("timestamp", '%m/%d/%Y %I:%M %p')) AS p
  FROM {src}
),
timed AS (
  SELECT * EXCLUDE (p) REPLACE (strftime(p, '%Y-%m-%dT%H:%M:%S') AS "timestamp"), p AS ts,
         strftime(p + INTERVAL '5 hours 30 minutes', '%Y-%m-%dT%H:%M:%S') AS timestamp_ist
  FROM parsed WHERE p IS NOT NULL
)"""

# The same for all rows, those without a valid time included.
TIMED = PARSED.replace(" FROM parsed WHERE p IS NOT NULL", " FROM parsed").replace("{src}", "raw")

KEYED = """
keyed AS (SELECT * FROM raw WHERE sensor_id IS NOT NULL AND "timestamp" IS NOT NULL AND reading_type IS NOT NULL)"""

DEDUPED = KEYED + """,
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY file_name, sensor_id, "timestamp", reading_type ORDER BY row_index) AS rn
    FROM keyed) WHERE rn = 1
)"""

IMPUTED = """
imputed AS (
  SELECT * REPLACE (coalesce(value, avg(value) OVER (PARTITION BY file_name)) AS value,
                    coalesce(battery_level, avg(battery_level) OVER (PARTITION BY file_name)) AS battery_level)
  FROM {src}
)"""

CORRECTED = """
stats AS (
  SELECT *, count(*) OVER w AS n, avg(value) OVER w AS mean, stddev_pop(value) OVER w AS dev, median(value) OVER w AS med
  FROM {src} WINDOW w AS (PARTITION BY file_name, reading_type)
),
corrected AS (
  SELECT s.* EXCLUDE (n, mean, dev, med) REPLACE (
    CASE WHEN n < 5 THEN {small}
         WHEN dev > 0 AND abs(s.value - mean) / dev > 3 THEN med ELSE s.value END AS value)
  FROM stats s LEFT JOIN config c ON s.reading_type = c.reading_type
)"""

CLIPPED = "CASE WHEN s.value < c.lo THEN c.lo WHEN s.value > c.hi THEN c.hi ELSE s.value END"

CLEAN = f"""{DAY}, {CONFIG}, {DEDUPED}, {IMPUTED.format(src='deduped')}, {CORRECTED.format(src='imputed', small=CLIPPED)}"""

CALIBRATED = """
calibrated AS (
  SELECT s.* REPLACE (s.value * coalesce(c.m, 1.0) + coalesce(c.b, 0.0) AS value)
  FROM {src} s LEFT JOIN config c ON s.reading_type = c.reading_type
)"""

_ANOMALOUS = "NOT coalesce(s.value BETWEEN coalesce(c.lo, '-inf'::DOUBLE) AND coalesce(c.hi, 'inf'::DOUBLE), FALSE)"

_ROW = 'row_index, file_name, sensor_id, "timestamp", reading_type'
_ROLL = "PARTITION BY file_name, sensor_id, reading_type ORDER BY ts"

_ROLLING_7 = f"""
SELECT {_ROW}, CASE WHEN sensor_id IS NOT NULL THEN round(avg(value) OVER (
         PARTITION BY file_name, sensor_id, reading_type ORDER BY ts NULLS LAST, row_index
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) END AS rolling_7d_avg FROM timed"""

ISO_TS = """
iso AS (SELECT *, CASE WHEN regexp_matches("timestamp", '^\\d{4}-\\d{2}-\\d{2}') THEN try_cast("timestamp" AS TIMESTAMP) END AS ts FROM raw)"""

GAPS = """
bounds AS (SELECT file_name, sensor_id, min(ts) AS min_ts, max(ts) AS max_ts FROM iso GROUP BY ALL HAVING min(ts) < max(ts)),
expected AS (SELECT file_name, sensor_id, unnest(generate_series(min_ts, max_ts, INTERVAL 1 HOUR)) AS expected_ts FROM bounds),
missing AS (
  SELECT e.* FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM iso a WHERE a.file_name = e.file_name AND a.sensor_id = e.sensor_id AND a.ts = e.expected_ts)
)"""

_SUMMARY = """count(*) AS record_count,
       round(avg(value), 8) AS avg_value, min(value) AS min_value, max(value) AS max_value,
       round(avg(battery_level), 8) AS avg_battery, min(battery_level) AS min_battery, max(battery_level) AS max_battery"""
_RATIOS = """round(sum(CASE WHEN sensor_id IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 8) AS sensor_id_missing_ratio,
       round(sum(CASE WHEN "timestamp" IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 8) AS timestamp_missing_ratio,
       round(sum(CASE WHEN reading_type IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 8) AS reading_type_missing_ratio,
       round(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 8) AS value_missing_ratio,
       round(sum(CASE WHEN battery_level IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*), 8) AS battery_missing_ratio"""
_DISTINCT = """count(DISTINCT sensor_id) AS distinct_sensors, count(DISTINCT reading_type) AS distinct_reading_types"""
_VIOLATIONS = f"""sum({_BAD}::INT)::DOUBLE AS value_out_of_range, sum({_BAD_BATTERY}::INT)::DOUBLE AS battery_out_of_range"""
_NULLS = """count(*) FILTER (WHERE sensor_id IS NULL) AS missing_sensor,
       count(*) FILTER (WHERE "timestamp" IS NULL) AS missing_ts,
       count(*) FILTER (WHERE value IS NULL) AS missing_value"""



def _percent(part: str) -> str:
    """A share of ``total`` in percent with two digits, rounded half up in whole numbers."""
    return f"(({part} * 20000 + total) // (2 * total)) / 100.0::DOUBLE"


# Daily files with their damage by the last digit of the day: 3 lacks a column, 5 has text, 7 is cut off, 9 is empty.
_LEDGER = f"""WITH {DAY}, c AS (SELECT file_name, substr(file_name, 10, 1) AS d, count(*) AS n, {_NULLS} FROM raw GROUP BY file_name),
e AS (SELECT *, d NOT IN ('3', '5', '7', '9') AND missing_sensor + missing_ts + missing_value > 0 AS warned FROM c)
SELECT file_name AS filename, CASE WHEN d IN ('3', '5', '7', '9') THEN 0 ELSE n END AS rows,
       CASE d WHEN '3' THEN 'schema_mismatch' WHEN '5' THEN 'profiling_error' WHEN '7' THEN 'schema_error'
              ELSE CASE WHEN warned THEN 'dq_warning' ELSE 'success' END END AS status,
       CASE d WHEN '3' THEN 'missing:[''battery_level'']' WHEN '5' THEN 'not numeric: value'
              ELSE CASE WHEN warned THEN concat('missing sensor:', missing_sensor, ', ts:', missing_ts, ', value:', missing_value) END END AS error,
       CAST(32 AS BIGINT) AS digits
FROM e"""

# The rows of the transformed tables, without their values: complete, first copies, with a valid time.
_STORED = f"""{DEDUPED.replace("FROM raw", "FROM chosen")}, {PARSED.replace("{src}", "deduped")}"""

SQL: dict[str, str] = {
    "anomalies_by_type": f"""WITH {DAY}, {CONFIG}, {CALIBRATED.format(src='raw')}
SELECT s.reading_type, count(*) AS readings, count(*) FILTER (WHERE {_ANOMALOUS}) AS anomalies, round(avg(s.value), 8) AS avg_value
FROM calibrated s LEFT JOIN config c ON s.reading_type = c.reading_type GROUP BY s.reading_type""",
    "reading_summary": f"WITH {DAY} SELECT file_name, reading_type, {_SUMMARY} FROM raw GROUP BY file_name, reading_type",
    "missing_ratio": f"WITH {DAY} SELECT file_name, {_RATIOS} FROM raw GROUP BY file_name",
    "distinct_counts": f"WITH {DAY} SELECT file_name, {_DISTINCT} FROM raw GROUP BY file_name",
    "distinct_over_files": f"""WITH {DAY}, s AS (
  SELECT 'all' AS set, sensor_id FROM raw
  UNION ALL SELECT strftime(date_trunc('week', CAST(substr(file_name, 1, 10) AS DATE)), '%Y-%m-%d'), sensor_id FROM raw)
SELECT set, count(DISTINCT sensor_id) AS "distinct" FROM s GROUP BY set""",
    "range_counts": f"WITH {DAY} SELECT file_name, {_VIOLATIONS} FROM raw GROUP BY file_name",
    "profile_documents": f"""WITH {DAY},
types AS (SELECT file_name, reading_type, {_SUMMARY} FROM raw GROUP BY file_name, reading_type),
files AS (SELECT file_name, {_RATIOS}, {_DISTINCT}, {_VIOLATIONS} FROM raw GROUP BY file_name)
SELECT * FROM types JOIN files USING (file_name)""",
    "row_null_status": f"""WITH {DAY}, c AS (SELECT file_name, count(*) AS rows, {_NULLS} FROM raw GROUP BY file_name)
SELECT *, CASE WHEN missing_sensor + missing_ts + missing_value > 0 THEN 'dq_warning' ELSE 'success' END AS status,
       CASE WHEN missing_sensor + missing_ts + missing_value > 0
            THEN concat('missing sensor:', missing_sensor, ', ts:', missing_ts, ', value:', missing_value) END AS error
FROM c""",
    "dedupe_first": f"WITH {DAY}, {DEDUPED} SELECT * FROM deduped",
    "impute_mean": f"""WITH {DAY}, {IMPUTED.format(src='raw')}
SELECT * REPLACE (round(value, 8) AS value, round(battery_level, 8) AS battery_level) FROM imputed""",
    "clip_small_samples": f"""WITH {MINUTE}, {CONFIG}, s AS (SELECT *, count(*) OVER (PARTITION BY file_name, reading_type) AS n FROM raw)
SELECT s.* EXCLUDE (n) REPLACE (CASE WHEN n < 5 THEN {CLIPPED} ELSE s.value END AS value)
FROM s LEFT JOIN config c ON s.reading_type = c.reading_type""",
    "correct_outliers": f"""WITH {DAY}, {CONFIG}, {CORRECTED.format(src='raw', small='s.value')}
SELECT * REPLACE (round(value, 8) AS value) FROM corrected""",
    "clean_all": f"""WITH {CLEAN}
SELECT * REPLACE (round(value, 8) AS value, round(battery_level, 8) AS battery_level) FROM corrected""",
    "calibrate": f"""WITH {DAY}, {CONFIG}, {CALIBRATED.format(src='raw')}
SELECT * REPLACE (round(value, 8) AS value) FROM calibrated""",
    "normalize_timestamps": f"WITH {DAY}, {PARSED.replace('{src}', 'raw')} SELECT * EXCLUDE (ts) FROM timed",
    "daily_avg": f"""WITH {MONTH}, {TIMED}
SELECT {_ROW}, strftime(ts, '%Y-%m-%d') AS date, CASE WHEN sensor_id IS NOT NULL AND ts IS NOT NULL THEN
       round(avg(value) OVER (PARTITION BY file_name, sensor_id, reading_type, CAST(ts AS DATE)), 8) END AS daily_avg FROM timed""",
    "rolling_7": f"""WITH {MONTH}, {TIMED} {_ROLLING_7}""",
    "rolling_7_split": f"""WITH {MONTH}, {TIMED} {_ROLLING_7}""",
    "rolling_7_days": f"""WITH {MONTH}, {TIMED}
SELECT {_ROW}, CASE WHEN sensor_id IS NOT NULL AND ts IS NOT NULL THEN
       round(avg(value) OVER ({_ROLL} RANGE BETWEEN INTERVAL '6 days 23:59:59.999999' PRECEDING AND CURRENT ROW), 8) END
       AS rolling_7d_avg FROM timed""",
    "anomaly_flag": f"""WITH {DAY}, {CONFIG}
SELECT row_index, file_name, sensor_id, "timestamp", s.reading_type, value, {_ANOMALOUS} AS anomalous_reading
FROM raw s LEFT JOIN config c ON s.reading_type = c.reading_type""",
    "type_and_timestamp_checks": f"""WITH {DAY}, {ISO_TS}
SELECT file_name, count(*) AS total_records, count(*) FILTER (WHERE typeof(value) != 'DOUBLE') AS invalid_value_type,
       count(*) FILTER (WHERE ts IS NULL) AS invalid_timestamp FROM iso GROUP BY file_name""",
    "range_pct": f"""WITH {DAY}, {CONFIG}, g AS (
  SELECT file_name, s.reading_type, count(*) AS total, count(*) FILTER (WHERE value < c.lo OR value > c.hi) AS out_of_range
  FROM raw s LEFT JOIN config c ON s.reading_type = c.reading_type GROUP BY file_name, s.reading_type)
SELECT *, {_percent('out_of_range')} AS outlier_pct FROM g""",
    "missing_pct": f"""WITH {DAY}, g AS (
  SELECT file_name, reading_type, count(*) AS total, count(*) FILTER (WHERE value IS NULL) AS missing
  FROM raw GROUP BY file_name, reading_type)
SELECT *, {_percent('missing')} AS missing_pct FROM g""",
    "sensor_bounds": f"""WITH {DAY}, {ISO_TS}
SELECT file_name, sensor_id, min(ts) AS min_ts, max(ts) AS max_ts FROM iso GROUP BY file_name, sensor_id HAVING min(ts) < max(ts)""",
    "missing_hours": f"WITH {HOURLY}, {ISO_TS}, {GAPS} SELECT * FROM missing",
    "hourly_gaps": f"""WITH {HOURLY}, {ISO_TS}, {GAPS},
per_sensor AS (SELECT file_name, sensor_id, count(*) AS n FROM missing GROUP BY file_name, sensor_id)
SELECT b.file_name, b.sensor_id, coalesce(p.n, 0) AS missing_hours
FROM bounds b LEFT JOIN per_sensor p ON p.file_name = b.file_name AND p.sensor_id IS NOT DISTINCT FROM b.sensor_id""",
    "gap_totals": f"""WITH {HOURLY_MONTH}, {ISO_TS}, {GAPS},
per_sensor AS (SELECT file_name, sensor_id, count(*) AS n FROM missing GROUP BY file_name, sensor_id),
files AS (SELECT DISTINCT file_name FROM raw)
SELECT f.file_name, count(p.n) AS sensors_with_gaps, CAST(coalesce(sum(p.n), 0) AS BIGINT) AS total_missing_hours
FROM files f LEFT JOIN per_sensor p ON p.file_name = f.file_name GROUP BY f.file_name""",
    "quality_report": f"""WITH {HOURLY}, {ISO_TS}, {GAPS},
per_sensor AS (SELECT file_name, sensor_id, count(*) AS n FROM missing GROUP BY file_name, sensor_id),
gaps AS (SELECT file_name, count(*) AS sensors, sum(n) AS hours FROM per_sensor GROUP BY file_name),
files AS (SELECT file_name, count(*) AS total_records, count(*) FILTER (WHERE typeof(value) != 'DOUBLE') AS invalid_value_type,
                 count(*) FILTER (WHERE ts IS NULL) AS invalid_timestamp FROM iso GROUP BY file_name)
SELECT files.*, coalesce(sensors, 0) AS sensors_with_gaps, CAST(coalesce(hours, 0) AS BIGINT) AS total_missing_hours
FROM files LEFT JOIN gaps USING (file_name)""",
    "transform_all": f"""WITH {CLEAN}, {CALIBRATED.format(src='corrected')}, {PARSED.replace('{src}', 'calibrated')}
SELECT s.* EXCLUDE (ts) REPLACE (round(s.value, 10) AS value, round(battery_level, 10) AS battery_level),
       strftime(ts, '%Y-%m-%d') AS date,
       round(avg(s.value) OVER (PARTITION BY file_name, sensor_id, s.reading_type, CAST(ts AS DATE)), 10) AS daily_avg,
       round(avg(s.value) OVER (PARTITION BY file_name, sensor_id, s.reading_type ORDER BY ts, row_index
                                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 10) AS rolling_7d_avg,
       {_ANOMALOUS} AS anomalous_reading
FROM timed s LEFT JOIN config c ON s.reading_type = c.reading_type""",
    "partitioned_roundtrip": f"""WITH {GATEWAY}, {ISO_TS}
SELECT sensor_id, strftime(ts, '%Y-%m-%d') AS date, ts AS "timestamp", reading_type, value, battery_level FROM iso""",
    "new_file_footers": f"""WITH {DAY}
SELECT file_name, count(*) AS rows, CAST(0 AS BIGINT) AS missing_columns, CAST(1 AS BIGINT) AS extra_columns,
       CAST(0 AS BIGINT) AS unreadable FROM raw WHERE CAST(substr(file_name, 9, 2) AS INT) % 2 = 1 GROUP BY file_name""",
    "ingest_ledger": _LEDGER,
    "stream_ledger": _LEDGER,
    "quarantined_files": f"""WITH {DAY}
SELECT DISTINCT file_name AS filename, CASE substr(file_name, 10, 1) WHEN '3' THEN 'schema_mismatch' WHEN '5' THEN 'profiling_error'
       ELSE 'schema_error' END AS status, TRUE AS whole, TRUE AS all_blocks, TRUE AS same_bytes
FROM raw WHERE substr(file_name, 10, 1) IN ('3', '5', '7')""",
    "ingest_report": f"""WITH {DAY}, chosen AS (SELECT * FROM raw WHERE substr(file_name, 10, 1) NOT IN ('3', '5', '7', '9')), {_STORED},
iso AS (SELECT * FROM timed), {GAPS},
per_sensor AS (SELECT file_name, sensor_id, count(*) AS n FROM missing GROUP BY file_name, sensor_id),
gaps AS (SELECT file_name, count(*) AS sensors, sum(n) AS hours FROM per_sensor GROUP BY file_name),
files AS (SELECT DISTINCT file_name FROM raw WHERE substr(file_name, 10, 1) NOT IN ('3', '5', '7')),
totals AS (SELECT file_name, count(*) AS n FROM timed GROUP BY file_name)
SELECT replace(file_name, '.parquet', '_transformed.parquet') AS file_name, coalesce(n, 0) AS total_records,
       CASE WHEN substr(file_name, 10, 1) = '1' THEN coalesce(n, 0) ELSE 0 END AS invalid_value_type,
       CAST(0 AS BIGINT) AS invalid_timestamp, coalesce(sensors, 0) AS sensors_with_gaps,
       CAST(coalesce(hours, 0) AS BIGINT) AS total_missing_hours
FROM files LEFT JOIN totals USING (file_name) LEFT JOIN gaps USING (file_name)""",
    "reingest_current": f"""WITH {GATEWAY}, later AS (
  SELECT * REPLACE (CASE WHEN regexp_matches("timestamp", '^\\d{{4}}-') THEN
           strftime(CAST("timestamp" AS TIMESTAMP) + INTERVAL 40 DAY, '%Y-%m-%dT%H:%M:%S') ELSE 'moved' END AS "timestamp")
  FROM raw WHERE substr(file_name, 10, 1) = '3'
), chosen AS (
  SELECT * FROM raw WHERE substr(file_name, 10, 1) NOT IN ('3', '5', '7', '9') UNION ALL SELECT * FROM later
), {_STORED}
SELECT replace(file_name, '.parquet', '_transformed.parquet') AS file_name, sensor_id, strftime(ts, '%Y-%m-%d') AS date, "timestamp",
       reading_type, count(*) OVER (PARTITION BY file_name) AS in_report FROM timed""",
    "load_unknown_dates": f"""WITH {GATEWAY}, {ISO_TS}
SELECT file_name, CASE WHEN substr(file_name, 10, 1) = '4' THEN 'unknown' ELSE coalesce(strftime(ts, '%Y-%m-%d'), 'none') END AS day,
       count(*) AS rows, count(ts) FILTER (WHERE substr(file_name, 10, 1) <> '4') AS timed
FROM iso GROUP BY ALL""",
    "quality_report_shares": f"""WITH {DAY}, {CONFIG}, g AS (
  SELECT file_name, s.reading_type, count(*) AS total, count(*) FILTER (WHERE value < c.lo OR value > c.hi) AS bad,
         count(*) FILTER (WHERE value IS NULL) AS gone
  FROM raw s LEFT JOIN config c ON s.reading_type = c.reading_type GROUP BY file_name, s.reading_type)
SELECT file_name, 'outlier_pct' AS share, reading_type, {_percent('bad')} AS percent FROM g
UNION ALL SELECT file_name, 'missing_pct', reading_type, {_percent('gone')} FROM g""",
}
_MIXED = DAY.replace("raw AS (", "daily AS (", 1) + """, raw AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(file_name, 9, 2) AS INT) % 2 = 0 THEN 'even.parquet' ELSE file_name END AS file_name) FROM daily)"""
SQL["transform_mixed"] = SQL["transform_all"].replace(DAY, _MIXED)
for _name, _same in {"correct_outliers_large": "correct_outliers", "clean_large": "clean_all", "transform_large": "transform_all"}.items():
    SQL[_name] = SQL[_same]
