"""Oracle SQL for the queries over landed files."""

from __future__ import annotations

from pulsekit.plans.oracle import ACTS, ORACLE, RECORDS, SAMPLES, with_
from pulsekit.plans.oracle_ingest import TRACKPOINTS
from pulsekit.plans.standins import DOC_SPAN

POINTS = TRACKPOINTS.replace("SELECT user_id,", "SELECT event_id, user_id,", 1)


def _file(day: str, event: str, ext: str) -> str:
    return f"{day} || '_' || CAST({event} // {DOC_SPAN} AS VARCHAR) || '{ext}'"


def _number(day: str, event: str) -> str:
    return f"({event} // {DOC_SPAN} * 31 + CAST(substr({day}, 9, 2) AS INTEGER)) % 7"


_HEART = f"""SELECT {_file('"date"', 'event_id', '.json')} AS file_name, "time", value, "date", "HOUR",
  "date" AS file_day, {_number('"date"', 'event_id')} AS file_no FROM samples"""
ORACLE["heart_file_scan"] = with_(SAMPLES) + f"""
SELECT file_name, "time", value, "date", "HOUR", file_day FROM ({_HEART}) WHERE file_no > 2"""

_LOG = f"""SELECT {_file('"date"', 'activity_id', '.json')} AS file_name, activity_id, activity, "date", start, minutes,
  {_number('"date"', 'activity_id')} AS file_no FROM acts"""
ORACLE["activity_file_scan"] = with_(RECORDS, ACTS) + f"""
SELECT file_name, activity_id, activity, "date", start, minutes FROM ({_LOG}) WHERE file_no > 2"""

_TCX = f"""SELECT {_file('"date"', 'event_id', '.tcx')} AS file_name,
  "date" || '-' || CAST(user_id AS VARCHAR) || '-' || CAST(part AS VARCHAR) AS "Id", sport, lap, "Time",
  "LatitudeDegrees", "LongitudeDegrees", "HeartRateBPM", "date" AS file_day, {_number('"date"', 'event_id')} AS file_no FROM tp"""
ORACLE["tcx_file_scan"] = with_(POINTS) + f"SELECT * EXCLUDE (file_no) FROM ({_TCX}) WHERE file_no > 2"

_STATUS = """CASE WHEN file_no < 2 THEN 'rejected' WHEN file_no = 2 THEN 'no document' ELSE 'ok' END AS status"""
ORACLE["file_rejects"] = with_(SAMPLES, RECORDS, ACTS, POINTS) + f"""
SELECT DISTINCT 'heart' AS source, file_name, CASE WHEN file_no > 2 THEN 1 ELSE 0 END AS n_documents,
  CASE WHEN file_no < 2 THEN 1 ELSE 0 END AS n_rejected, {_STATUS} FROM ({_HEART})
UNION ALL
SELECT 'activity', file_name, CASE WHEN file_no > 2 THEN count(*) ELSE 0 END,
  CASE file_no WHEN 0 THEN 1 WHEN 1 THEN count(*) ELSE 0 END, {_STATUS}
FROM ({_LOG}) GROUP BY file_name, file_no
UNION ALL
SELECT 'track', file_name, CASE WHEN file_no > 2 THEN count(DISTINCT "Id") ELSE 0 END, CASE WHEN file_no < 2 THEN 1 ELSE 0 END, {_STATUS}
FROM ({_TCX}) GROUP BY file_name, file_no"""

ORACLE["whole_documents_by_sport"] = with_(POINTS) + f"""
SELECT tp.sport, "date" || '-' || CAST(tp.user_id AS VARCHAR) || '-' || CAST(part AS VARCHAR) AS "Id",
  'by ' || CAST(tp.user_id AS VARCHAR) AS "Notes", lap,
  CAST(count(*) OVER (PARTITION BY tp.user_id, "date", part, lap) AS INTEGER) AS "Calories", "Time",
  "LatitudeDegrees", "LongitudeDegrees", "HeartRateBPM", CAST(event_id % 90 AS INTEGER) AS "Cadence",
  floor(e.value) / 4 AS "Speed", true AS lifted
FROM tp JOIN events e USING (event_id) WHERE {_number('"date"', 'event_id')} > 2"""
