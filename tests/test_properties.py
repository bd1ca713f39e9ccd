"""Property tests (randomised, few examples: each one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulsekit.operators import features as FT
from pulsekit.operators import label as L
from tests.test_features import _brute

BASE = dt.datetime(2021, 8, 1, 22, 0, 0)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(steps=st.lists(st.sampled_from([0.0, 0.5, 1.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0, 7.0]), min_size=2, max_size=60),
       n_lags=st.integers(1, 5), extra=st.integers(0, 6), guard=st.booleans())
def test_halo_lags_equal_the_definition(spark, steps, n_lags, extra, guard):
    """Any bucket size >= n_lags + 1 gives the row-by-row definition, with
    duplicates (step 0), half-unit gaps and holes."""
    minutes, t = [], 0.0
    for s in steps:
        t += s
        minutes.append(t)
    rows = [(i, BASE + dt.timedelta(minutes=m), 50 + (i * 7) % 23) for i, m in enumerate(minutes)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, BPM int")
    out = FT.lag_features(df, "ts", "BPM", n_lags=n_lags, tie="id", dropna=False,
                          first_row_guard=guard, bucket_units=n_lags + 1 + extra)
    got = {r.id: [r[f"Min - {j}"] for j in range(1, n_lags + 1)] for r in out.collect()}
    assert got == _brute(minutes, [r[2] for r in rows], n_lags, guard=guard)


@SETTINGS
@given(acts=st.lists(st.tuples(st.integers(0, 1500), st.integers(0, 200)), min_size=0, max_size=6),
       sample_minutes=st.lists(st.integers(0, 1800), min_size=1, max_size=40))
def test_fanout_and_last_wins_counts(spark, acts, sample_minutes):
    """fan-out rows = sum over samples of max(1, covering activities);
    last-wins keeps exactly the samples; wrap semantics by construction."""
    log = [(1, k, ["Run", "Walk", "Sport"][k % 3], dur * 60_000,
            (BASE.replace(hour=0) + dt.timedelta(minutes=start)).strftime("%Y-%m-%dT%H:%M:%S.000+02:00"))
           for k, (start, dur) in enumerate(acts)]
    log_df = spark.createDataFrame(log, "user_id long, logId long, activityName string, originalDuration long, "
                                        "originalStartTime string")
    samples = []
    for i, m in enumerate(sample_minutes):
        ts = BASE.replace(hour=0) + dt.timedelta(minutes=m)
        samples.append((1, i, ts.strftime("%H:%M:%S"), 60, ts.strftime("%Y-%m-%d"), ts.strftime("%H")))
    smp = spark.createDataFrame(samples, "user_id long, event_id long, time string, value int, date string, HOUR string")
    iv = L.activity_intervals(log_df, ["user_id"])

    def covering(day, clock):  # wrap: the start date, the clock modulo one day
        n = 0
        for start, dur in acts:
            s_day = (BASE.replace(hour=0) + dt.timedelta(minutes=start)).strftime("%Y-%m-%d")
            s_clock = start % 1440
            n += sum(1 for o in range(dur) if s_day == day and (s_clock + o) % 1440 == clock)
        return n

    expected = sum(max(1, covering(s[4], int(s[2][:2]) * 60 + int(s[2][3:5]))) for s in samples)
    assert L.label_fanout(smp, iv, ["user_id"]).count() == expected
    assert L.label_last_wins(smp, iv, ["user_id"]).count() == len(samples)


@SETTINGS
@given(acts=st.lists(st.tuples(st.integers(0, 2000), st.integers(0, 300)), min_size=1, max_size=6),
       sample_minutes=st.lists(st.integers(0, 2400), min_size=1, max_size=40),
       bucket=st.sampled_from([7, 60, 1440]))
def test_range_join_equals_last_wins_carry(spark, acts, sample_minutes, bucket):
    log = [(1, k, f"A{k % 4}", dur * 60_000,
            (BASE.replace(hour=0) + dt.timedelta(minutes=start)).strftime("%Y-%m-%dT%H:%M:%S.000Z"))
           for k, (start, dur) in enumerate(acts)]
    log_df = spark.createDataFrame(log, "user_id long, logId long, activityName string, originalDuration long, "
                                        "originalStartTime string")
    rows = []
    for i, m in enumerate(sample_minutes):
        ts = BASE.replace(hour=0) + dt.timedelta(minutes=m)
        rows.append((1, i, ts.strftime("%H:%M:%S"), 60, ts.strftime("%Y-%m-%d"), ts.strftime("%H")))
    smp = spark.createDataFrame(rows, "user_id long, event_id long, time string, value int, date string, HOUR string")
    iv = L.activity_intervals(log_df, ["user_id"])
    rng = sorted(map(tuple, L.label_range_join(smp, iv, ["user_id"], bucket_minutes=bucket)
                     .select("event_id", "sport").collect()))
    carry = sorted(map(tuple, L.label_last_wins(smp, iv, ["user_id"], midnight="carry")
                       .select("event_id", "sport").collect()))
    assert rng == carry
