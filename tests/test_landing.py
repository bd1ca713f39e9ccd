"""Keyed landing, days replaced in place, walking back over days, bounded stream batches with a restart."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsekit.functions import sleep_start
from pulsekit.sources import incremental as INC
from pulsekit.sources import writers as W
from pulsekit.sources.landing import key_bucket, land_keyed, land_new, landed_keys
from pulsekit.streaming import ingest as IN

DOC = "file_key string, logId long, document string"


def _docs(spark, rows):
    return spark.createDataFrame([(k, i, f"[{i}]") for k, i in rows], DOC)


def _landed(spark, path):
    return sorted((r.file_key, r.logId) for r in spark.read.parquet(path).collect())


def test_a_second_delivery_lands_only_new_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "keyed")
    first = _docs(spark, [("2024-01-15_10h00m00s_u1", 1), ("2024-01-15_10h00m00s_u1", 0), ("2024-01-16_09h00m00s_u1", 2), (None, 9)])
    assert sorted(r.logId for r in land_new(first, path, order=["logId"]).collect()) == [0, 2]
    again = _docs(spark, [("2024-01-16_09h00m00s_u1", 7), ("2024-01-17_09h00m00s_u1", 3)])
    assert [r.logId for r in land_new(again, path, order=["logId"]).collect()] == [3]
    before = _landed(spark, path)
    assert land_new(again, path).collect() == [] and _landed(spark, path) == before
    assert [i for _, i in before] == [0, 2, 3]
    assert land_new(again.limit(0), path).collect() == []


def test_landed_keys_read_touched_buckets_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "keyed")
    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    land_keyed(_docs(spark, [(f"{d}_00h00m00s_u{u}", u) for d in days for u in range(20)]), path)
    delivery = _docs(spark, [("2024-01-05_11h00m00s_u1", 1)])
    bucket = delivery.select(key_bucket("file_key").alias("b")).first().b
    known = landed_keys(spark, path, delivery)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"{bucket}" in plan.split("PartitionFilters", 1)[1].split("\n", 1)[0]
    read = {r[0] for r in known.select(F.input_file_name()).collect()}
    assert read and all(f"/bucket={bucket}/" in f for f in read)
    got = {r.file_key for r in known.collect()}
    assert {k for k in got if k.startswith("2024-01-05")} == {f"2024-01-05_00h00m00s_u{u}" for u in range(20)}


@pytest.mark.parametrize("text, want", [('[{"sleep":[{"startTime":"2024-01-15T23:10:00.000","x":1}]}]', "2024-01-15T23:10:00.000"),
                                        ('[{"sleep":[]}]', None), ("", None), ("{", None), (None, None)])
def test_start_of_a_sleep_document(spark, text, want):
    df = spark.createDataFrame([(text,)], "document string")
    assert df.select(sleep_start("document").alias("s")).first().s == want


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_delivering_a_day_again_touches_no_other_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "days")
    rows = [(u, f"2024-01-{d:02d}", 10 * d + u) for d in (15, 16, 17) for u in range(5)]
    df = spark.createDataFrame(rows, "user_id long, date string, value int")
    W.upsert_days(df, path)
    before = {f: t for f, t in _files(path).items() if "date=2024-01-17" not in f}
    again = df.filter("date = '2024-01-17' and user_id < 3").withColumn("value", F.col("value") + 1000)
    for _ in range(2):  # safe to repeat
        W.upsert_days(again, path)
    assert {f: t for f, t in _files(path).items() if "date=2024-01-17" not in f} == before
    got = sorted((r.user_id, r.date, r.value) for r in spark.read.schema(df.schema).parquet(path).collect())
    assert got == sorted([r for r in rows if r[1] != "2024-01-17"] + [(u, "2024-01-17", 1170 + u) for u in range(3)])


def test_walking_back_reads_no_older_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    rows = [(100 * d + i, f"2024-01-{d:02d}T{i % 24:02d}:00:00", f"2024-01-{d:02d}") for d in range(1, 29) for i in range(10)]
    df = spark.createDataFrame(rows, "logId long, stamp string, day string")
    W.write_partitioned(df, path, ["day"], fmt="parquet")
    days = INC.partition_values(spark, path, "day")
    assert days == sorted({r[2] for r in rows})
    taken = INC.days_walked_back(spark.read.schema(df.schema).parquet(path), days, "stamp", "2024-01-20", 25)
    assert taken == ["2024-01-14", "2024-01-15", "2024-01-16", "2024-01-17", "2024-01-18", "2024-01-19", "2024-01-20"]
    got = INC.latest_n_in_days(spark, path, df.schema, "stamp", "2024-01-20", 25, "logId")
    assert sorted(r.logId for r in got.collect()) == sorted(r.logId for r in INC.latest_n_before(df, "stamp", "2024-01-20", 25, "logId").collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-13" not in plan
    assert INC.latest_n_in_days(spark, path, df.schema, "stamp", "2023-01-01", 5, "logId").collect() == []
    assert INC.latest_n_in_days(spark, path, df.schema, "stamp", "2025-01-01", 10_000, "logId").count() == len(rows)


def _land(landing, number, user, day, values):
    points = ",".join(f'{{"time":"10:{i:02d}:00","value":{v}}}' for i, v in enumerate(values))
    text = (f'{{"user_id":{user},"document":[{{"activities-heart":[{{"dateTime":"{day}"}}],'
            f'"activities-heart-intraday":{{"dataset":[{points}]}}}}]}}')
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, f"f{number:03d}.json"), "w") as f:
        f.write(text if user != 9 else text[:-7])


def _table(spark, sink):
    return sorted((r.user_id, r.date, r.time, r.value) for r in IN.current_days(spark, sink).collect())


def test_a_backlog_with_a_failure_in_the_middle_gives_the_same_table(spark, tmp_dir):
    landing, plain, broken = (os.path.join(tmp_dir, x) for x in ("landing", "plain", "broken"))
    for n in range(10):
        _land(landing, n, n % 3 + 1 if n != 4 else 9, f"2024-01-{15 + n % 4}", [60 + n, 70 + n])

    def run(base, each=IN._replace_batch):
        IN.ingest_bounded(spark, landing, *(os.path.join(base, x) for x in ("sink", "ckpt", "bad")), 2, each)

    run(plain)
    batches = []

    def dies(df, i, sink, bad):
        IN._replace_batch(df, i, sink, bad)
        batches.append(i)
        if i == 2:
            raise RuntimeError("after the write, before the commit")

    with pytest.raises(Exception, match="before the commit"):
        run(broken, dies)
    run(broken)
    sink = os.path.join(broken, "sink")
    assert batches == [0, 1, 2] and _table(spark, sink) == _table(spark, os.path.join(plain, "sink"))
    assert Counter(r.batch for r in spark.read.parquet(sink).select("batch", "file_name").distinct().collect()) == {0: 2, 1: 2, 2: 1, 3: 2, 4: 2}
    bad = spark.read.parquet(os.path.join(broken, "bad")).collect()
    assert [r.file_name for r in bad] == ["f004.json"] and bad[0].record.startswith('{"user_id":9')
    before = _table(spark, sink)
    run(broken)  # nothing new
    assert _table(spark, sink) == before
    _land(landing, 50, 1, before[0][1], [1, 2, 3])  # a day again: replaced as a whole
    run(broken)
    after = [r for r in _table(spark, sink) if r[:2] == before[0][:2]]
    assert [r[3] for r in after] == [1, 2, 3]


def test_landed_files_are_listed_by_tasks_and_replaced(spark, tmp_dir):
    from pulsekit.sources.landing import land_files
    path = os.path.join(tmp_dir, "files [a]")
    land_files(spark.createDataFrame([("x y,=%.json", "1"), ("_b.json", "2"), ("c.json", None)], "n string, t string"), path, "n", "t")
    land_files(spark.createDataFrame([("_b.json", "new"), ("d.json", "4")], "n string, t string"), path, "n", "t")
    got = {f: open(os.path.join(path, f)).read().strip() for f in os.listdir(path) if not f.startswith(".")}
    assert got == {"x y,=%.json": "1", "_b.json": "new", "c.json": "", "d.json": "4"}
    land_files(spark.createDataFrame([], "n string, t string"), os.path.join(tmp_dir, "none"), "n", "t")
