"""Incremental selection and landing keys (FIXTURES §4.11)."""

import os

from pyspark.sql import functions as F

from pulsekit.functions import landing_key, stamp_digits
from pulsekit.sources import incremental as INC
from pulsekit.sources.writers import upsert_days, write_csv
from pulsekit.sources.readers import read_csv


def test_keys_and_digits(spark):
    df = spark.createDataFrame([("2023-02-11T12:05:17.000Z",)], "s string")
    r = df.select(landing_key("s").alias("k"), stamp_digits("s").alias("d"),
                  stamp_digits(landing_key("s")).alias("kd")).collect()[0]
    assert r.k == "2023-02-11_12h05m17s" and r.d == r.kd == 20230211120517


def test_high_water_mark_is_strict(spark):
    recs = spark.createDataFrame([(1, "2023-02-11T10:00:00.000Z"), (1, "2023-02-11T10:00:01.000Z"),
                                  (2, "2020-01-01T00:00:00.000Z")], "u long, stamp string")
    landed = spark.createDataFrame([(1, "2023-02-11_10h00m00s.json")], "u long, name string")
    per_user = INC.newer_than_high_water_mark(recs, "stamp", landed, "name", keys=["u"])
    assert sorted((r.u, r.stamp) for r in per_user.collect()) == [
        (1, "2023-02-11T10:00:01.000Z"), (2, "2020-01-01T00:00:00.000Z")]
    glob = INC.newer_than_high_water_mark(recs, "stamp", landed, "name")
    assert [r.stamp for r in glob.collect()] == ["2023-02-11T10:00:01.000Z"]


def test_new_files_and_newest_version(spark):
    cand = spark.createDataFrame([("a.tcx",), ("b.tcx",)], "file_name string")
    done = spark.createDataFrame([("a.json",)], "file_name string")
    assert [r.file_name for r in INC.new_files(cand, done).collect()] == ["b.tcx"]
    versions = spark.createDataFrame([("d1", 1, 1, "old"), ("d1", 2, 1, "new"), ("d1", 2, 0, "tie-low"),
                                      ("d2", 5, 0, "only")], "day string, v int, id int, body string")
    got = {r.day: r.body for r in INC.newest_per_key(versions, ["day"], ["v", "id"]).collect()}
    assert got == {"d1": "new", "d2": "only"}


def test_latest_n_ties_and_days(spark):
    df = spark.createDataFrame([(i, f"2023-02-1{1 + i // 3}") for i in range(9)], "id long, day string")
    top = INC.latest_n_before(df, "day", "2023-02-13", 4, "id").collect()
    assert [r.id for r in top] == [5, 4, 3, 2]  # ties on day broken by id, cut-off exclusive
    days = INC.days_in_range(df, "day", "2023-02-12", "2023-02-13").collect()
    assert sorted(r.day for r in days) == ["2023-02-12", "2023-02-13"]


def test_upsert_by_day_replaces_only_delivered_days(spark, tmp_dir):
    path = os.path.join(tmp_dir, "heart")
    first = spark.createDataFrame([("2023-02-11", 1), ("2023-02-12", 2)], "date string, v int")
    upsert_days(first, path)
    upsert_days(spark.createDataFrame([("2023-02-12", 20), ("2023-02-13", 3)], "date string, v int"), path)
    got = sorted((r.date, r.v) for r in spark.read.schema("v int, date string").parquet(path).collect())
    assert got == [("2023-02-11", 1), ("2023-02-12", 20), ("2023-02-13", 3)]


def test_csv_variants(spark, tmp_dir):
    df = spark.createDataFrame([("10:00:00", 60, "2023-02-11", "10")], "time string, value int, date string, HOUR string")
    p1, p2 = os.path.join(tmp_dir, "h"), os.path.join(tmp_dir, "s")
    write_csv(df, p1)
    write_csv(df, p2, header=True, sep=";")
    assert read_csv(spark, p1, infer=True).schema["value"].dataType.simpleString() == "int"
    assert read_csv(spark, p2, sep=";").collect()[0]["value"] == "60"
    nohead = os.path.join(tmp_dir, "n")
    write_csv(df, nohead, header=False)
    from pulsekit.sources.schemas import SAMPLES
    assert read_csv(spark, nohead, schema=SAMPLES, header=False).collect()[0]["value"] == 60
    assert df.select(F.lit(1)).count() == 1


def test_compact_by_month(spark, tmp_dir):
    from pulsekit.sources.writers import compact_by_month
    rows = [(f"2021-0{1 + i % 3}-{1 + i % 28:02d}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "date string, v int").repartition(30)
    path = os.path.join(tmp_dir, "monthly")
    compact_by_month(df, path)
    back = spark.read.schema("date string, v int, month string").parquet(path)
    assert back.count() == 300
    assert sorted(r.month for r in back.select("month").distinct().collect()) == ["2021-01", "2021-02", "2021-03"]
    assert back.filter(F.col("month") == "2021-02").count() == 100
    files = [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 30
