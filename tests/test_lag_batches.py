"""Complete lag rows from sorted Arrow batches: batches that end anywhere, the first row's mark, uneven steps, nulls."""

import random

import pytest
from pyspark.sql import functions as F

from pulsekit.operators import features as FT

N = 6


def _rows(spark):
    rng = random.Random(3)
    out = []
    for k in (None, 1, 2, 3, 4):
        t = 0
        for i in range(160):
            t += 60 if i < 2 else rng.choice([60] * 12 + [0, 30, 61, 89, 90, 91, 120, 300])  # one first row
            out.append((k, len(out), None if rng.random() < 0.03 else i, t))
    df = spark.createDataFrame(out, "k long, id long, BPM int, s long")
    return df.withColumn("ts", F.expr("timestampadd(SECOND, s, TIMESTAMP_NTZ'2024-01-01 22:00:00')")).drop("s")


def _got(df):
    return sorted((tuple(r) for r in df.select("k", "id", *[f"`Min - {j}`" for j in range(1, N + 1)]).collect()), key=str)


@pytest.mark.parametrize("size", [3, 50, 10_000])
@pytest.mark.parametrize("whole", [False, True])
def test_batches_give_the_rows_of_the_windows(spark, size, whole):
    df = _rows(spark)
    if whole:  # one row a unit, steps of whole units
        df = (df.withColumn("ts", F.expr("timestampadd(SECOND, -second(ts), ts)")).groupBy("k", "ts")
              .agg(F.min("id").alias("id"), F.max("BPM").alias("BPM")))
    lag = FT.lag_features_runs if whole else FT.lag_features
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        for bucket in (8, 60, None):
            for guard in (True, False):
                got = lag(df, "ts", "BPM", n_lags=N, series=["k"], bucket_units=bucket, first_row_guard=guard)
                # the window form breaks ties by a column; equal times end every complete run, so any order will do
                want = lag(df, "ts", "BPM", n_lags=N, series=["k"], tie="id", bucket_units=bucket, first_row_guard=guard)
                assert _got(got) == _got(want) and got.count() > 20
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_complete_rows_take_one_exchange_and_no_window(spark):
    df = _rows(spark)
    for lag in (FT.lag_features, FT.lag_features_runs):
        plan = lag(df, "ts", "BPM", n_lags=N, series=["k"], first_row_guard=False)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and plan.count("Exchange ") == 1
