"""Gap-checked lags, halo partitioning, frame form, one-hot (FIXTURES §4.7-4.8)."""

import datetime as dt

from pyspark.sql import functions as F

from pulsekit.operators import features as FT

BASE = dt.datetime(2021, 8, 1, 23, 0, 0)


def _series(spark, minutes, values=None, key=None):
    rows = []
    for i, m in enumerate(minutes):
        ts = BASE + dt.timedelta(minutes=m) if isinstance(m, (int, float)) else m
        rows.append((key or 1, i, ts, (values[i] if values else 60 + i)))
    return spark.createDataFrame(rows, "k long, id long, ts timestamp_ntz, BPM int")


def _brute(minutes, values, n, guard=True, unit=60.0):
    """The definition, row by row, on a series sorted by time."""
    order = sorted(range(len(minutes)), key=lambda i: (minutes[i], i))
    out = {}
    for pos, i in enumerate(order):
        lags = []
        for j in range(1, n + 1):
            src = pos - j
            if src < (1 if guard else 0):
                lags.append(None)
                continue
            gap = (minutes[i] - minutes[order[src]]) * 60.0 / unit
            lags.append(float(values[order[src]]) if round(gap) == j else None)
        out[i] = lags
    return out


def _rows(df, n):
    return {r.id: [r[f"Min - {j}"] for j in range(1, n + 1)] for r in df.collect()}


def test_matches_definition_with_gaps_duplicates_and_guard(spark):
    mins = list(range(0, 70)) + [71, 72, 73] + list(range(74, 140))
    vals = [60 + (i * 7) % 30 for i in range(len(mins))]
    n = 60
    df = _series(spark, mins, vals)
    got = _rows(FT.lag_features(df, "ts", "BPM", n_lags=n, tie="id", dropna=False), n)
    want = _brute(mins, vals, n)
    assert got == want
    complete = FT.lag_features(df, "ts", "BPM", n_lags=n, tie="id").count()
    assert complete == sum(1 for v in want.values() if all(x is not None for x in v))


def test_exactly_60_and_61_rows_first_row_guard(spark):
    for count, with_guard, without in ((61, 0, 1), (62, 1, 2)):
        df = _series(spark, list(range(count)))
        assert FT.lag_features(df, "ts", "BPM", n_lags=60).count() == with_guard
        assert FT.lag_features(df, "ts", "BPM", n_lags=60, first_row_guard=False).count() == without


def test_half_even_rounding_of_gaps(spark):
    # a gap of 2.5 minutes rounds to 2 (half to even), so it is a valid lag 2
    mins = [0, 0.5, 2.5]
    df = _series(spark, mins, [10, 20, 30])
    got = _rows(FT.lag_features(df, "ts", "BPM", n_lags=2, dropna=False, first_row_guard=False), 2)
    assert got[2] == [None, 10.0]
    assert got == _brute(mins, [10, 20, 30], 2, guard=False)


def test_halo_buckets_equal_one_bucket(spark):
    mins = [m for m in range(0, 400) if m % 97 != 5]
    df = _series(spark, mins)
    small = FT.lag_features(df, "ts", "BPM", n_lags=20, tie="id", bucket_units=21, dropna=False)
    big = FT.lag_features(df, "ts", "BPM", n_lags=20, tie="id", bucket_units=100000, dropna=False)
    assert _rows(small, 20) == _rows(big, 20)
    assert small.count() == len(mins)


def test_series_key_and_frame_form(spark):
    a = _series(spark, list(range(0, 90)), key=1)
    b = _series(spark, [m for m in range(0, 90) if m != 40], key=2)
    df = a.unionByName(b)
    w1 = FT.lag_features(df, "ts", "BPM", n_lags=30, series=["k"])
    w3 = FT.lag_features_frame(df, "ts", "BPM", n_lags=30, series=["k"])
    cols = ["k", "id"] + [f"`Min - {j}`" for j in range(1, 31)]
    assert sorted(map(tuple, w1.select(*cols).collect())) == sorted(map(tuple, w3.select(*cols).collect()))
    assert w1.filter("k = 1").count() == 90 - 31


def test_training_matrix_columns_and_one_hot(spark):
    mins = list(range(0, 65))
    df = _series(spark, mins).withColumn(
        "sport", F.when(F.col("id") % 3 == 0, "Run").when(F.col("id") % 3 == 1, "Sport").otherwise("0"))
    m = FT.training_matrix(df, order_col="ts", n_lags=60)
    assert m.columns[:3] == ["time", "BPM", "Min - 1"]
    assert m.columns[-6:] == ["Nothing", "Circuit Training", "Martial Arts", "Run", "Sport", "Walk"]
    r = m.orderBy("time").collect()[0]
    assert r.time == 100  # first complete row is 00:01:00 next day -> 100 (leading zeros lost)
    assert r["Nothing"] + r["Run"] + r["Sport"] == 1


def test_a_label_outside_the_domain(spark):
    unseen = spark.createDataFrame([("Swim",)], "sport string")
    from pulsekit.functions import SPORTS, one_hot_columns
    r = unseen.select(*one_hot_columns("sport", SPORTS)).collect()[0]
    assert sum(r) == 0  # a label outside the fixed domain gives all zeros


def test_runs_equal_the_definition(spark):
    """Gaps, repeated minutes, nulls, the first row, runs over several frames and of just enough rows."""
    n = 10
    a = list(range(0, 45)) + [46] + list(range(50, 62)) + [61] + list(range(62, 80)) + list(range(100, 111)) + list(range(200, 210))
    vals = [None if i == 70 else 60 + (i * 7) % 31 for i in range(len(a))]
    df = _series(spark, a, vals).unionByName(_series(spark, list(range(11)), key=2)).unionByName(_series(spark, list(range(12)), key=3))
    cols = ["k", "id"] + [f"`Min - {j}`" for j in range(1, n + 1)]
    want = sorted(map(tuple, FT.lag_features(df, "ts", "BPM", n_lags=n, series=["k"], tie="id", bucket_units=10_000).select(*cols).collect()))
    brute = {i: v for i, v in _brute(a, [x or 0 for x in vals], n).items() if None not in v and vals[i] is not None}
    assert {r[1] for r in want if r[0] == 1} == {i for i, v in brute.items() if not any(a[70] == a[i] - j for j in range(1, n + 1))}
    for bucket in (11, 16, None):
        got = FT.lag_features_runs(df, "ts", "BPM", n_lags=n, series=["k"], tie="id", bucket_units=bucket).select(*cols)
        assert sorted(map(tuple, got.collect())) == want
        got = FT.lag_features(df, "ts", "BPM", n_lags=n, series=["k"], tie="id", bucket_units=bucket).select(*cols)
        assert sorted(map(tuple, got.collect())) == want
    assert [r[0] for r in want].count(3) == 1 and not [r for r in want if r[0] == 2]
    assert FT.lag_features_runs(df.limit(0), "ts", "BPM", n_lags=n, series=["k"]).collect() == []
