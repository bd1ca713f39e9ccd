"""Oracle SQL for deliveries, sleep records, replaced days and the bounded stream."""

from __future__ import annotations

from pulsekit.plans.oracle import ORACLE, RECORDS, SAMPLES, with_
from pulsekit.plans.oracle_ingest import _digits, _key

_ACTIVITIES = RECORDS + f""",
docs AS (SELECT *, {_key('lastModified')} || '_u' || CAST(user_id AS VARCHAR) AS file_key FROM records)"""
ORACLE["second_delivery"] = with_(_ACTIVITIES) + """
SELECT file_key, min(logId) AS logId, arg_min('[' || to_json({'logId': logId, 'activityName': activityName,
  'originalDuration': originalDuration, 'originalStartTime': originalStartTime, 'lastModified': lastModified}) || ']', logId) AS document
FROM docs WHERE substr(file_key, 1, 10) > '2024-01-20' GROUP BY file_key"""
ORACLE["latest_n_partitioned"] = ORACLE["latest_n_before"]

_SLEEP = f"""sleep AS (
  SELECT user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS "startTime", event_id, CAST(floor(value) AS BIGINT) AS v,
         {_key("strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')")} || '_u' || CAST(user_id AS VARCHAR) AS file_key
  FROM events WHERE event_type = 'error')"""
ORACLE["sleep_landing"] = with_(_SLEEP) + """
SELECT user_id, file_key, "startTime", '[{"sleep":[' || to_json({'logId': event_id, 'startTime': "startTime", 'minutesAsleep': v,
  'levels': {'data': [{'level': 'deep', 'seconds': v}]}}) || ']}]' AS document FROM sleep"""
ORACLE["sleep_incremental"] = with_(_SLEEP) + f"""
SELECT s.user_id, s."startTime" FROM sleep s
LEFT JOIN (SELECT user_id, max({_digits('file_key')}) AS hwm FROM sleep WHERE substr(file_key, 1, 10) <= '2024-01-20'
           GROUP BY user_id) m ON m.user_id = s.user_id
WHERE m.hwm IS NULL OR {_digits('s."startTime"')} > m.hwm"""
ORACLE["sleep_latest_n"] = with_(_SLEEP) + """
SELECT "startTime", file_key FROM sleep WHERE "startTime" < '2024-01-20' ORDER BY "startTime" DESC, file_key DESC LIMIT 100"""

ORACLE["redelivered_day"] = with_(SAMPLES) + """
SELECT user_id, event_id, "time", value + CASE WHEN "date" = (SELECT max("date") FROM samples) THEN 1000 ELSE 0 END AS value,
       "date" FROM samples"""
ORACLE["stream_bounded"] = with_(SAMPLES) + """
SELECT user_id, "time", value + CASE WHEN "date" >= '2024-01-20' THEN 1000 ELSE 0 END AS value, "date", "HOUR"
FROM samples WHERE user_id % 7 <> 3"""
