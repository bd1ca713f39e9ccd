"""Day documents -> samples (edge cases of FIXTURES §4.1-4.2)."""

import json
import os

from pyspark.sql import functions as F

from pulsekit.operators.samples import flatten_day_documents, typed_samples
from pulsekit.sources.readers import day_from_file_name, read_day_documents


def _doc(day, points, second_day=None):
    heart = [{"dateTime": day, "value": {"restingHeartRate": 60}}]
    if second_day:
        heart.append({"dateTime": second_day, "value": {}})
    return [{"activities-heart": heart,
             "activities-heart-intraday": {"dataset": [{"time": t, "value": v} for t, v in points],
                                           "datasetInterval": 1, "datasetType": "minute"}}]


def _write(folder, name, doc):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps(doc, indent=2))


def test_flatten_files_with_empty_days_and_two_entries(spark, tmp_dir):
    _write(tmp_dir, "2023-02-11.json", _doc("2023-02-11", [("10:00:00", 60), ("10:01:00", 62), ("11:00:00", 70)]))
    _write(tmp_dir, "2023-02-12.json", _doc("2023-02-12", []))
    _write(tmp_dir, "2023-02-13.json", _doc("2023-02-13", [("00:00:00", 55)], second_day="2023-02-14"))
    docs = read_day_documents(spark, tmp_dir + "/*.json")
    out = flatten_day_documents(docs, keep=["file_name"]).withColumn("file_day", day_from_file_name("file_name"))
    rows = sorted(out.select("date", "time", "value", "HOUR", "file_day").collect())
    assert [tuple(r) for r in rows] == [
        ("2023-02-11", "10:00:00", 60, "10", "2023-02-11"),
        ("2023-02-11", "10:01:00", 62, "10", "2023-02-11"),
        ("2023-02-11", "11:00:00", 70, "11", "2023-02-11"),
        ("2023-02-13", "00:00:00", 55, "00", "2023-02-13"),  # only the first entry's day counts
    ]


def test_all_days_empty_still_resolves(spark, tmp_dir):
    _write(tmp_dir, "2023-02-12.json", _doc("2023-02-12", []))
    out = flatten_day_documents(read_day_documents(spark, tmp_dir))
    assert out.count() == 0
    assert out.columns == ["time", "value", "date", "HOUR"]


def test_non_numeric_value_becomes_null(spark):
    df = spark.createDataFrame([("10:00:00", "71", "2023-02-11", "10"), ("10:01:00", "x", "2023-02-11", "10")],
                               "time string, value string, date string, HOUR string")
    vals = sorted((r.time, r.value) for r in typed_samples(df).collect())
    assert vals == [("10:00:00", 71), ("10:01:00", None)]


def test_day_from_file_name(spark):
    df = spark.createDataFrame([("a/b/2023-02-11.json",), ("2023-04-19_14h08m26s.json",)], "p string")
    assert [r[0] for r in df.select(day_from_file_name("p")).collect()] == ["2023-02-11", "2023-04-19"]
    assert df.select(F.col("p")).count() == 2


def test_activity_log_files_with_optional_fields(spark, tmp_dir):
    from pulsekit.operators.label import activity_intervals
    from pulsekit.sources.readers import read_activity_log
    base = {"activityName": "Run", "logId": 7, "originalDuration": 5_292_000,
            "originalStartTime": "2023-02-11T10:20:31.000+02:00", "lastModified": "2023-02-11T12:05:17.000Z",
            "hasActiveZoneMinutes": True, "distance": 12.5,
            "heartRateZones": [{"caloriesOut": 1.5, "max": 100, "min": 50, "minutes": 3, "name": "Fat Burn"}]}
    with_source = dict(base, source={"id": "x", "name": "tracker", "trackerFeatures": ["HEARTRATE"], "type": "t"})
    without = dict(base, logId=8, activityName="Walk", originalDuration=60_000,
                   originalStartTime="2023-04-19T14:08:26.000+02:00")
    _write(tmp_dir, "2023-02-11_12h05m17s.json", [with_source])
    _write(tmp_dir, "2023-04-19_14h08m26s.json", [without])
    log = read_activity_log(spark, tmp_dir)
    rows = {r.logId: r for r in log.collect()}
    assert rows[7].source.trackerFeatures == ["HEARTRATE"] and rows[8].source is None
    iv = {r.activity_id: (r.date, str(r.start), r.minutes) for r in activity_intervals(log).collect()}
    assert iv == {7: ("2023-02-11", "2023-02-11 10:20:00", 88), 8: ("2023-04-19", "2023-04-19 14:08:00", 1)}


def test_stand_in_documents_are_bounded(spark):
    from pulsekit.plans.standins import DOC_SPAN, day_documents
    from pulsekit.sources.readers import parse_json_array
    from pulsekit.sources.schemas import DAY_DOCUMENT
    rows = [(1, i, f"{(i // 60) % 24:02d}:{i % 60:02d}:00", 60, "2023-02-11", "00") for i in range(5000)]
    smp = spark.createDataFrame(rows, "user_id long, event_id long, time string, value int, date string, HOUR string")
    docs = day_documents(smp).select(F.explode(parse_json_array("document", DAY_DOCUMENT)).alias("d"))
    sizes = [r[0] for r in docs.select(F.size("d.`activities-heart-intraday`.dataset")).collect()]
    assert sum(sizes) == 5000 and max(sizes) <= DOC_SPAN
    flat = flatten_day_documents(docs.select("d.*"))
    assert flat.count() == 5000
