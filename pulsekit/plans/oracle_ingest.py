"""Oracle SQL for the ingestion, track and streaming queries."""

from __future__ import annotations

from pulsekit.plans.oracle import ORACLE, RECORDS, SAMPLES, with_
from pulsekit.plans.oracle_features import MATRIX
from pulsekit.plans.standins import DOC_SPAN, TCX_SPORTS


def _key(s: str) -> str:
    return (f"substr({s}, 1, 10) || '_' || substr({s}, 12, 2) || 'h' || substr({s}, 15, 2) || 'm' "
            f"|| substr({s}, 18, 2) || 's'")


def _digits(s: str) -> str:
    return f"CAST(regexp_replace(substr({s}, 1, 19), '[^0-9]', '', 'g') AS BIGINT)"


ORACLE["csv_roundtrip"] = with_(SAMPLES) + "SELECT * FROM samples"
ORACLE["csv_no_header"] = with_(SAMPLES) + "SELECT * FROM samples"
ORACLE["csv_inferred"] = MATRIX
ORACLE["landing_key"] = with_(RECORDS) + f"""
SELECT logId, lastModified, {_key('lastModified')} || '.json' AS file_key,
       {_key('originalStartTime')} AS start_key FROM records"""
ORACLE["stamp_digits"] = with_(RECORDS) + f"""
SELECT logId, {_digits('lastModified')} AS modified_digits, {_digits(_key('lastModified'))} AS key_digits
FROM records"""
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
ORACLE["new_files_anti"] = f"""
SELECT DISTINCT {_key(_ISO)} || '.tcx' AS file_name FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase'
                  AND {_key("strftime(p.ts, '%Y-%m-%dT%H:%M:%S')")} = {_key("strftime(e.ts, '%Y-%m-%dT%H:%M:%S')")})"""
ORACLE["incremental_hwm"] = with_(RECORDS) + f"""
SELECT r.user_id, r.logId, r.lastModified FROM records r
LEFT JOIN (SELECT user_id, max({_digits("strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'")}) AS hwm
           FROM events WHERE event_type = 'view' GROUP BY user_id) m ON r.user_id = m.user_id
WHERE m.hwm IS NULL OR {_digits('r.lastModified')} > m.hwm"""
ORACLE["incremental_hwm_global"] = with_(RECORDS) + f"""
SELECT user_id, logId, lastModified FROM records
WHERE {_digits('lastModified')} > (
  SELECT max({_digits(_key("strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')") + " || '.json'")}) FROM orders)"""
ORACLE["upsert_by_day"] = """
SELECT user_id, "date", ts, event_id, value FROM (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS "date", ts, event_id, CAST(floor(value) AS INTEGER) AS value,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
ORACLE["latest_n_before"] = with_(RECORDS) + """
SELECT logId, lastModified, activityName FROM records WHERE lastModified < '2024-01-20'
ORDER BY lastModified DESC, logId DESC LIMIT 100"""
ORACLE["days_in_range"] = with_(SAMPLES) + """
SELECT DISTINCT user_id, "date" FROM samples WHERE "date" BETWEEN '2024-01-10' AND '2024-01-20'"""

_SPORTS = "[" + ", ".join(f"'{s}'" for s in TCX_SPORTS) + "]"
TRACKPOINTS = f"""tp AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS "date", event_id // {DOC_SPAN} AS part,
         {_SPORTS}[(user_id % 3) + 1] AS sport,
         CAST(dense_rank() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d'), event_id // {DOC_SPAN}
                                 ORDER BY strftime(ts, '%H')) - 1 AS INTEGER) AS lap,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS "Time",
         CASE WHEN event_type IN ('view', 'click') THEN value / 10 END AS "LatitudeDegrees",
         CASE WHEN event_type IN ('view', 'click') THEN user_id / 100 END AS "LongitudeDegrees",
         CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INTEGER) END AS "HeartRateBPM"
  FROM events)"""
ORACLE["trackpoint_flatten"] = with_(TRACKPOINTS) + "SELECT * FROM tp"
ORACLE["files_per_sport"] = with_(TRACKPOINTS) + """
SELECT sport, count(DISTINCT (user_id, "date", part)) AS n_files FROM tp GROUP BY sport"""
ORACLE["partitioned_by_sport"] = with_(TRACKPOINTS) + """
SELECT "date" || '-' || CAST(user_id AS VARCHAR) || '-' || CAST(part AS VARCHAR) AS "Id", sport, lap, "Time",
       "LatitudeDegrees", "LongitudeDegrees", "HeartRateBPM" FROM tp WHERE sport = 'Running'"""
ORACLE["stream_ingest"] = with_(SAMPLES) + 'SELECT user_id, "time", value, "date", "HOUR" FROM samples'
