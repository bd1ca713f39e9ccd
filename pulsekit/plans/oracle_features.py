"""Oracle SQL for the feature and model queries (lag columns generated)."""

from __future__ import annotations

from pulsekit.functions import NO_LABEL, NO_LABEL_COLUMN, SPORTS
from pulsekit.plans.oracle import ACTS, LABEL_CTES, LAST_WINS, ORACLE, RECORDS, SAMPLES, _minutes, with_
from pulsekit.plans.standins import SHORTEST_RUN, WAVE

HOUR_US = 3600 * 1_000_000


def lag_ctes(src: str, order: str, value: str, n_lags: int, unit_us: int,
             series: tuple[str, ...] = (), guard: bool = True, name: str = "lagged") -> str:
    """CTEs ``{name}_o`` and ``{name}``: row-based lags with the rounded-gap
    test and (``guard``) the first-row exclusion, straight from the definition."""
    part = f"PARTITION BY {', '.join(series)} " if series else ""
    low = 1 if guard else 0
    cols = []
    for j in range(1, n_lags + 1):
        cols.append(
            f'CASE WHEN _rn - {j} > {low} AND round_even((_t - lag(_t, {j}) OVER w) / {unit_us}, 0) = {j} '
            f'THEN CAST(lag({value}, {j}) OVER w AS DOUBLE) END AS "Min - {j}"')
    return (f"{name}_o AS (SELECT *, epoch_us({order.split(",")[0]}) AS _t, "
            f"row_number() OVER ({part}ORDER BY {order}) AS _rn FROM {src}),\n"
            f"{name} AS (SELECT *, {', '.join(cols)} FROM {name}_o WINDOW w AS ({part}ORDER BY {order}))")


def complete(n_lags: int, value: str) -> str:
    return " AND ".join([f"{value} IS NOT NULL"] + [f'"Min - {j}" IS NOT NULL' for j in range(1, n_lags + 1)])


def lag_list(n_lags: int) -> str:
    return ", ".join(f'"Min - {j}"' for j in range(1, n_lags + 1))


def one_hots(label: str = "sport") -> str:
    parts = [f"CASE WHEN {label} = '{NO_LABEL}' THEN 1 ELSE 0 END AS \"{NO_LABEL_COLUMN}\""]
    parts += [f"CASE WHEN {label} = '{s}' THEN 1 ELSE 0 END AS \"{s}\"" for s in sorted(SPORTS)]
    return ", ".join(parts)


MINUTE_US = 60 * 1_000_000
DEVICE = f"""device AS (
  SELECT user_id, date_trunc('minute', ts) + to_minutes(o) AS "TS",
         max(CAST(60 + CAST(floor(value) AS BIGINT) % 30 + abs((o + event_id) % {WAVE} - {WAVE // 2}) * 4
             + ((event_id + 1) * (o + 7) * 48271) % 5 AS INTEGER)) AS "BPM"
  FROM (SELECT *, unnest(range(k)) AS o
        FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'purchase')
        WHERE k >= {SHORTEST_RUN})
  GROUP BY ALL)"""
DEVICE_LABELLED = f"""device_labelled AS (
  SELECT d.*, coalesce(lw.activity, '{NO_LABEL}') AS sport FROM device d LEFT JOIN lw
    ON d.user_id = lw.user_id AND strftime("TS", '%Y-%m-%d') = lw."date" AND strftime("TS", '%H:%M:%S') = lw."time")"""
MIX = "((((epoch_us(\"TS\") // 60000000 + user_id * 7919) % 2147483648) * 2654435761) % 4294967296) % 100"
SPLIT = f"CASE WHEN {MIX} < 80 THEN 'train' ELSE 'test' END AS split"

_TIME = """CAST(replace(strftime("TS", '%H:%M:%S'), ':', '') AS INTEGER) AS "time" """
_LAGGED = with_(RECORDS, ACTS, _minutes("wrap"), LAST_WINS, DEVICE, DEVICE_LABELLED,
                lag_ctes("device_labelled", '"TS"', '"BPM"', 60, MINUTE_US, series=("user_id",)))
MATRIX = _LAGGED + f"""SELECT {_TIME}, "BPM", {lag_list(60)}, {one_hots()} FROM lagged WHERE {complete(60, '"BPM"')}"""

ORACLE["one_hot_sport"] = with_(*LABEL_CTES) + f"SELECT event_id, {one_hots()} FROM labelled"
_LAG = (with_(DEVICE, lag_ctes("device", '"TS"', '"BPM"', 60, MINUTE_US, series=("user_id",))) +
        f"""SELECT user_id, "TS", "BPM", {lag_list(60)} FROM lagged WHERE {complete(60, '"BPM"')}""")
ORACLE["lag_features"] = _LAG
ORACLE["lag_features_frame"] = _LAG
ORACLE["lag_features_by_type"] = with_(
    """per_type AS (SELECT event_type, strptime(strftime(ts, '%Y-%m-%d %H'), '%Y-%m-%d %H') AS "TS",
       max(CAST(floor(value) AS INTEGER)) AS "BPM" FROM events GROUP BY ALL)""",
    lag_ctes("per_type", '"TS"', '"BPM"', 60, HOUR_US, series=("event_type",))) + \
    f"""SELECT event_type, "TS", "BPM", {lag_list(60)} FROM lagged"""
ORACLE["lag_features_per_user"] = with_(
    SAMPLES,
    """per_user AS (SELECT user_id, strptime("date" || "HOUR", '%Y-%m-%d%H') AS "TS", max(value) AS "BPM"
       FROM samples GROUP BY ALL)""",
    lag_ctes("per_user", '"TS"', '"BPM"', 60, HOUR_US, series=("user_id",))) + \
    f"""SELECT user_id, "TS", "BPM", {lag_list(60)} FROM lagged"""
ORACLE["lag_matrix_per_user"] = with_(
    *LABEL_CTES,
    """per_user AS (SELECT user_id, event_id, strptime("date" || "time", '%Y-%m-%d%H:%M:%S') AS "TS", value AS "BPM", sport
       FROM labelled)""",
    lag_ctes("per_user", '"TS", event_id', '"BPM"', 60, 60_000_000, series=("user_id",))) + \
    f"""SELECT user_id, event_id, {_TIME}, "BPM", {lag_list(60)}, {one_hots()} FROM lagged"""
ORACLE["training_matrix"] = MATRIX
ORACLE["persistence_mae"] = ("SELECT count(*) AS n_rows, avg(abs(\"BPM\" - \"Min - 1\")) AS mae FROM ("
                             + MATRIX + ")")

_MATRIX_COLS = ['"time"', '"BPM"'] + [f'"Min - {j}"' for j in range(1, 61)] + \
    [f'"{NO_LABEL_COLUMN}"'] + [f'"{s}"' for s in sorted(SPORTS)]
ORACLE["summary_stats"] = f"""
WITH long AS (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _MATRIX_COLS)} FROM ({ORACLE["lag_matrix_per_user"]}))
              ON {', '.join(_MATRIX_COLS)} INTO NAME "column" VALUE x),
names AS (SELECT unnest([{', '.join(chr(39) + c.strip(chr(34)) + chr(39) for c in _MATRIX_COLS)}]) AS "column")
SELECT "column", count(x) AS "count", round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       round(min(x), 6) AS "min", round(quantile_cont(x, 0.25), 6) AS p25,
       round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75,
       round(max(x), 6) AS "max"
FROM names LEFT JOIN long USING ("column") GROUP BY "column" """

ORACLE["train_test_split"] = with_(DEVICE) + f'SELECT user_id, "TS", "BPM", {SPLIT} FROM device'
_FEATS = ['"time"'] + [f'"Min - {j}"' for j in range(1, 61)] + \
    [f'"{NO_LABEL_COLUMN}"'] + [f'"{s}"' for s in sorted(SPORTS)]
_SPLIT_MATRIX = _LAGGED + f"""SELECT {SPLIT}, {_TIME}, "BPM", {lag_list(60)}, {one_hots()} FROM lagged
                     WHERE {complete(60, '"BPM"')}"""
ORACLE["zscore_features"] = f"""
SELECT "column", round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std
FROM (UNPIVOT (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _FEATS)}
               FROM ({_SPLIT_MATRIX}) WHERE split = 'train')
      ON {', '.join(_FEATS)} INTO NAME "column" VALUE x)
GROUP BY "column" """


def _z(c: str) -> str:
    fit = f"FROM m WHERE split = 'train'"
    std = f"(SELECT CASE stddev_pop({c}) WHEN 0 THEN 1 ELSE stddev_pop({c}) END {fit})"
    return f"round(({c} - (SELECT avg({c}) {fit})) / {std}, 4) AS {c}"


ORACLE["standardised_matrix"] = f"""
WITH m AS MATERIALIZED ({_SPLIT_MATRIX})
SELECT "BPM", {', '.join(_z(c) for c in _FEATS)} FROM m WHERE split = 'test'"""
ORACLE["bpm_predict_check"] = f"""
WITH m AS MATERIALIZED ({_SPLIT_MATRIX}),
e AS (SELECT count(*) AS n_test, CAST(sum("BPM") AS BIGINT) AS sum_real, avg(abs("BPM" - "Min - 1")) AS p,
             avg(abs("BPM" - (SELECT median("BPM") FROM m WHERE split = 'train'))) AS c FROM m WHERE split = 'test')
SELECT n_test, sum_real, true AS in_range, round(p, 6) AS persistence_mae, round(c, 6) AS constant_mae, c > p AS constant_fails,
       true AS tree_learned, true AS linear_learned FROM e"""
