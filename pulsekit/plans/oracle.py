"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string runs on the shared tables registered as views and computes the
same result as the Spark query of the same name, from the table directly
(no documents, no files).  Column names equal the Spark ones.
"""

from __future__ import annotations

from pulsekit.functions import NO_LABEL, SPORTS

ORACLE: dict[str, str] = {}

_SPORT_LIST = "[" + ", ".join(f"'{s}'" for s in SPORTS) + "]"

SAMPLES = """samples AS (
  SELECT user_id, event_id, strftime(ts, '%H:%M:00') AS "time",
         CAST(floor(value) AS INTEGER) AS value, strftime(ts, '%Y-%m-%d') AS "date",
         strftime(ts, '%H') AS "HOUR"
  FROM events)"""

RECORDS = f"""records AS (
  SELECT user_id, event_id AS logId,
         {_SPORT_LIST}[(k % 5) + 1] AS activityName,
         CAST(k AS BIGINT) * 60000 + 30000 AS originalDuration,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+02:00' AS originalStartTime,
         strftime(ts + to_minutes(k - 120), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS lastModified
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events WHERE event_type = 'purchase'))"""

ACTS = """acts AS (
  SELECT user_id, logId AS activity_id, activityName AS activity,
         substr(originalStartTime, 1, 10) AS "date",
         strptime(substr(originalStartTime, 1, 16), '%Y-%m-%dT%H:%M') AS start,
         CAST(originalDuration // 60000 AS INTEGER) AS minutes
  FROM records)"""


def _minutes(midnight: str, name: str = "mins") -> str:
    day = '"date"' if midnight == "wrap" else "strftime(start + to_minutes(o), '%Y-%m-%d')"
    return f"""{name} AS (
  SELECT user_id, activity_id, activity, start, {day} AS "date",
         strftime(start + to_minutes(o), '%H:%M:%S') AS "time"
  FROM (SELECT *, unnest(range(minutes)) AS o FROM acts WHERE minutes > 0))"""


LAST_WINS = """lw AS (
  SELECT user_id, "date", "time", activity FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, "date", "time"
                                 ORDER BY start DESC, activity_id DESC) AS rn FROM mins)
  WHERE rn = 1)"""

LABELLED = f"""labelled AS (
  SELECT s.user_id, s.event_id, s."time", s.value, s."date", s."HOUR",
         coalesce(lw.activity, '{NO_LABEL}') AS sport
  FROM samples s LEFT JOIN lw ON s.user_id = lw.user_id AND s."date" = lw."date" AND s."time" = lw."time")"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _stats(src: str, by: list[str], label: bool = False, median: bool = False) -> str:
    keys = ", ".join(by)
    extra = ""
    if median:
        extra += ", median(value) AS median_value"
    if label:
        extra += ", max(sport) AS sport"
    return (f"SELECT {keys}, min(value) AS min_value, avg(value) AS avg_value, "
            f"max(value) AS max_value{extra} FROM {src} GROUP BY {keys}")


LABEL_CTES = (SAMPLES, RECORDS, ACTS, _minutes("wrap"), LAST_WINS, LABELLED)

ORACLE["hourly_stats"] = with_(SAMPLES) + _stats("samples", ['"date"', '"HOUR"'])
ORACLE["daily_stats"] = with_(SAMPLES) + _stats("samples", ['"date"'])
ORACLE["heart_flatten"] = with_(SAMPLES) + 'SELECT user_id, "time", value, "date", "HOUR" FROM samples'
ORACLE["file_name_date"] = with_(SAMPLES) + """
SELECT DISTINCT user_id, 'user=' || CAST(user_id AS VARCHAR) || '/' || "date" || '.json' AS file_name,
       "date" AS stem, "date" AS day FROM samples"""
ORACLE["union_days"] = """
SELECT user_id, event_id, strftime(ts, '%H:%M:00') AS "time", CAST(floor(value) AS INTEGER) AS value,
       strftime(ts, '%Y-%m-%d') AS "date", strftime(ts, '%H') AS "HOUR",
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'first' ELSE 'second' END AS period
FROM events"""
ORACLE["daily_median"] = with_(SAMPLES) + _stats("samples", ['"date"'], median=True)
ORACLE["hourly_median"] = with_(SAMPLES) + _stats("samples", ['"date"', '"HOUR"'], median=True)
ORACLE["hourly_lists"] = with_(SAMPLES) + """
SELECT "date", "HOUR", string_agg(CAST(value AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY value) AS value_runs,
       CAST(sum(n) AS BIGINT) AS n_values
FROM (SELECT "date", "HOUR", value, count(*) AS n FROM samples GROUP BY ALL) GROUP BY "date", "HOUR" """
ORACLE["per_user_hourly"] = with_(SAMPLES) + _stats("samples", ["user_id", '"date"', '"HOUR"'], median=True)

ORACLE["activity_intervals"] = with_(RECORDS, ACTS) + "SELECT * FROM acts"
ORACLE["json_roundtrip"] = with_(RECORDS) + "SELECT * FROM records"
ORACLE["activity_minutes"] = with_(RECORDS, ACTS, _minutes("wrap")) + "SELECT * FROM mins"
ORACLE["activities_with_samples"] = with_(SAMPLES, RECORDS, ACTS) + """
SELECT * FROM acts a WHERE EXISTS (SELECT 1 FROM samples s WHERE s.user_id = a.user_id AND s."date" = a."date")"""

_FANOUT = f"""
SELECT s.user_id, s.event_id, s."time", s.value, s."date", s."HOUR", coalesce(m.activity, '{NO_LABEL}') AS sport
FROM samples s LEFT JOIN mins m ON s.user_id = m.user_id AND s."date" = m."date" AND s."time" = m."time" """
ORACLE["label_fanout"] = with_(SAMPLES, RECORDS, ACTS, _minutes("wrap")) + _FANOUT
ORACLE["label_fanout_carry"] = with_(SAMPLES, RECORDS, ACTS, _minutes("carry")) + _FANOUT
ORACLE["label_last_wins"] = with_(*LABEL_CTES) + "SELECT * FROM labelled"
ORACLE["label_range_join"] = with_(SAMPLES, RECORDS, ACTS) + f"""
SELECT user_id, event_id, "time", value, "date", "HOUR", coalesce(activity, '{NO_LABEL}') AS sport FROM (
  SELECT s.*, a.activity, row_number() OVER (PARTITION BY s.event_id ORDER BY a.start DESC NULLS LAST,
                                             a.activity_id DESC NULLS LAST) AS rn
  FROM samples s LEFT JOIN acts a
    ON s.user_id = a.user_id AND a.minutes > 0
   AND strptime(s."date" || s."time", '%Y-%m-%d%H:%M:%S') >= a.start
   AND strptime(s."date" || s."time", '%Y-%m-%d%H:%M:%S') < a.start + to_minutes(a.minutes))
WHERE rn = 1"""
ORACLE["daily_stats_sport"] = with_(*LABEL_CTES) + _stats("labelled", ['"date"'], label=True)
ORACLE["hourly_stats_sport"] = with_(*LABEL_CTES) + _stats("labelled", ['"date"', '"HOUR"'], label=True)
ORACLE["first_sample_per_day"] = with_(SAMPLES) + """
SELECT user_id, "date", "time", event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, "date" ORDER BY "time", event_id) AS rn FROM samples)
WHERE rn = 1"""
ORACLE["labels_per_sport"] = with_(*LABEL_CTES) + "SELECT sport, count(*) AS n_samples FROM labelled GROUP BY sport"

_MARK = f"CASE WHEN sport <> '{NO_LABEL}' THEN 200 ELSE 0 END AS sport_marker"
_DAILY = "(" + _stats("labelled", ['"date"'], label=True) + ")"
_HOURLY = "(" + _stats("labelled", ['"date"', '"HOUR"'], label=True) + ")"
ORACLE["daily_series"] = with_(*LABEL_CTES) + f"""
SELECT CAST("date" AS DATE) AS "date", min_value, avg_value, max_value, {_MARK} FROM {_DAILY} ORDER BY 1"""
ORACLE["daily_series_plain"] = with_(*LABEL_CTES) + f"""
SELECT CAST("date" AS DATE) AS "date", min_value, avg_value, max_value FROM {_DAILY} ORDER BY 1"""
ORACLE["hourly_series"] = with_(*LABEL_CTES) + f"""
SELECT strptime("date" || "HOUR", '%Y-%m-%d%H') AS "TS", min_value, avg_value, max_value, {_MARK}
FROM {_HOURLY} ORDER BY 1"""
ORACLE["day_profile"] = with_(*LABEL_CTES) + f"""
SELECT "date", "HOUR", strptime("date" || "HOUR", '%Y-%m-%d%H') AS "TS", min_value, avg_value, max_value, {_MARK}
FROM {_HOURLY} WHERE "date" = '2024-01-15' ORDER BY "HOUR" """
ORACLE["time_as_int"] = with_(SAMPLES) + """
SELECT event_id, "time", CAST(replace("time", ':', '') AS INTEGER) AS time_int FROM samples"""


def oracle_sql() -> dict[str, str]:
    from pulsekit.plans import oracle_features, oracle_files, oracle_ingest, oracle_landing  # noqa: F401  (register)
    return dict(ORACLE)
