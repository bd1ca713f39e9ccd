"""Rollups, exact median, value runs, summary, series (FIXTURES §4.9, §4.12)."""

from pyspark.sql import functions as F

from pulsekit.operators import series as V
from pulsekit.operators import stats as ST


def _labelled(spark):
    rows = [("2023-02-11", "10", 1, "0"), ("2023-02-11", "10", 2, "Run"), ("2023-02-11", "10", 5, "Walk"),
            ("2023-02-11", "10", 8, "0"), ("2023-02-11", "11", 7, "0"), ("2023-02-12", "00", 3, "0")]
    return spark.createDataFrame(rows, "date string, HOUR string, value int, sport string")


def test_daily_and_hourly_with_median_and_label(spark):
    df = _labelled(spark)
    d = {r.date: r for r in ST.value_stats(df, ["date"], label="sport", median=True).collect()}
    assert (d["2023-02-11"].min_value, d["2023-02-11"].max_value) == (1, 8)
    assert d["2023-02-11"].avg_value == 23 / 5
    assert d["2023-02-11"].median_value == 5.0
    assert d["2023-02-11"].sport == "Walk"  # bytewise max: any name beats "0", last name wins
    assert d["2023-02-12"].median_value == 3.0 and d["2023-02-12"].sport == "0"
    h = {(r.date, r.HOUR): r.median_value for r in ST.hourly_median(df).collect()}
    assert h[("2023-02-11", "10")] == 3.5  # even count: mean of the middle two (approx would give 2)


def test_daily_min_equals_min_of_hourly_mins(spark):
    df = _labelled(spark)
    hourly = ST.hourly_stats(df).groupBy("date").agg(F.min("min_value").alias("m"))
    daily = ST.daily_stats(df)
    joined = daily.join(hourly, "date")
    assert joined.filter(F.col("m") != F.col("min_value")).count() == 0


def test_value_runs(spark):
    df = spark.createDataFrame([("d", 70), ("d", 62), ("d", 70), ("e", 1)], "date string, value int")
    got = {r.date: (r.value_runs, r.n_values) for r in ST.value_runs(df, ["date"]).collect()}
    assert got == {"d": ("62:1,70:2", 3), "e": ("1:1", 1)}


def test_summary_stats_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 5, 8)], "a double")
    r = ST.summary_stats(df, ["a"]).collect()[0]
    assert (r["count"], r["mean"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (4, 4.0, 1.0, 1.75, 3.5, 5.75, 8.0)


def test_series_and_profile(spark):
    df = _labelled(spark)
    daily = V.daily_series(ST.daily_stats(df, label="sport"))
    rows = daily.collect()
    assert [r.sport_marker for r in rows] == [200, 0]
    assert str(rows[0].date) == "2023-02-11"
    plain = V.daily_series(ST.daily_stats(df, label="sport"), with_marker=False)
    assert "sport_marker" not in plain.columns
    hourly = V.hourly_series(ST.hourly_stats(df, label="sport")).collect()
    assert str(hourly[0].TS) == "2023-02-11 10:00:00"
    prof = V.day_profile(ST.hourly_stats(df, label="sport"), "2023-02-11").collect()
    assert [r.HOUR for r in prof] == ["10", "11"]
    assert V.day_profile(ST.hourly_stats(df, label="sport"), "1999-01-01").count() == 0


def test_summary_stats_without_rows(spark):
    df = spark.createDataFrame([], "a int, `b c` double")
    got = {r["column"]: (r["count"], r["mean"], r["p50"]) for r in ST.summary_stats(df, df.columns).collect()}
    assert got == {"a": (0, None, None), "b c": (0, None, None)}


def test_day_range_reaches_the_scan(spark):
    from pulsekit.plans.context import Inputs
    from tests.conftest import SF001
    days = ("2024-01-10", "2024-01-12")
    plan = Inputs(spark, SF001, days).samples._jdf.queryExecution().executedPlan().toString()
    assert "ts" in plan and "2024-01-10 00:00:00" in plan.split("PushedFilters", 1)[0]
    cut = Inputs(spark, SF001, days).samples.select("event_id", "date").collect()
    whole = Inputs(spark, SF001).samples.filter(F.col("date").between(*days)).select("event_id", "date").collect()
    assert cut and sorted(cut) == sorted(whole)


def test_exact_quantiles_over_ranges(spark):
    """Many parts, heavy values, nulls, a column of one value and one of none, against sorted lists."""
    import random
    import statistics
    rng = random.Random(5)
    rows = [(rng.choice([7, 7, 7, rng.randrange(1000), None]), rng.gauss(1e6, 3.0), None, 4) for _ in range(3000)]
    rows += [(None, None, None, None)]
    df = spark.createDataFrame(rows, "a int, `b c` double, none double, same int").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = {r["column"]: r for r in ST.summary_stats(df, df.columns).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for i, name in enumerate(df.columns):
        x = sorted(r[i] for r in rows if r[i] is not None)
        r = got[name]
        assert r["count"] == len(x)
        if not x:
            assert [r[c] for c in ("mean", "std", "min", "p25", "p50", "p75", "max")] == [None] * 7
            continue
        assert (r["min"], r["max"]) == (x[0], x[-1])
        assert abs(r["mean"] - statistics.fmean(x)) < 1e-6 and abs(r["std"] - statistics.stdev(x)) < 1e-6
        q = [x[0]] * 3 if len(set(x)) == 1 else statistics.quantiles(x, n=4, method="inclusive")
        assert all(abs(r[c] - v) < 1e-9 * max(1, abs(v)) for c, v in zip(("p25", "p50", "p75"), q))
    one = ST.summary_stats(spark.createDataFrame([(3.0,)], "a double"), ["a"]).collect()[0]
    assert one["std"] is None and one["p25"] == one["p75"] == 3.0


def test_moments_of_columns(spark):
    df = spark.createDataFrame([(1, None), (3, None), (None, None)], "a int, b double")
    got = {r["column"]: tuple(r)[1:] for r in ST.column_moments(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 2.0, 1.0), "b": (0, None, None)}
