"""Labelling semantics."""

import pytest

from pulsekit.operators import label as L
from pulsekit.plans.standins import activity_log_records


def _log(spark, rows):
    return spark.createDataFrame(rows, "user_id long, logId long, activityName string, "
                                       "originalDuration long, originalStartTime string")


def _samples(spark, rows):
    return spark.createDataFrame(
        [(u, i, t, v, d, t[:2]) for i, (u, d, t, v) in enumerate(rows)],
        "user_id long, event_id long, time string, value int, date string, HOUR string")


def test_minutes_floor_and_zero(spark):
    log = _log(spark, [(1, 1, "Run", 0, "2023-02-11T10:00:10.000+02:00"),
                       (1, 2, "Run", 59_999, "2023-02-11T11:00:10.000+02:00"),
                       (1, 3, "Walk", 60_000, "2023-02-11T12:00:59.000+02:00"),
                       (1, 4, "Walk", 150_000, "2023-02-11T13:05:30.000Z")])
    iv = L.activity_intervals(log, keep=["user_id"])
    assert {r.activity_id: r.minutes for r in iv.collect()} == {1: 0, 2: 0, 3: 1, 4: 2}
    mins = sorted((r.activity_id, r.date, r.time) for r in L.activity_minutes(iv, keep=["user_id"]).collect())
    # start cut to HH:MM:00 of the local wall clock, whatever the offset
    assert mins == [(3, "2023-02-11", "12:00:00"), (4, "2023-02-11", "13:05:00"), (4, "2023-02-11", "13:06:00")]


def test_midnight_wrap_and_carry(spark):
    log = _log(spark, [(1, 1, "Run", 3 * 60_000, "2023-02-11T23:59:00.000+01:00")])
    iv = L.activity_intervals(log, keep=["user_id"])
    wrap = sorted((r.date, r.time) for r in L.activity_minutes(iv, ["user_id"], "wrap").collect())
    carry = sorted((r.date, r.time) for r in L.activity_minutes(iv, ["user_id"], "carry").collect())
    assert wrap == [("2023-02-11", "00:00:00"), ("2023-02-11", "00:01:00"), ("2023-02-11", "23:59:00")]
    assert carry == [("2023-02-11", "23:59:00"), ("2023-02-12", "00:00:00"), ("2023-02-12", "00:01:00")]


def test_longer_than_a_day_wraps_twice(spark):
    log = _log(spark, [(1, 1, "Walk", (1440 + 2) * 60_000, "2023-02-11T10:00:00.000+02:00")])
    mins = L.activity_minutes(L.activity_intervals(log, ["user_id"]), ["user_id"], "wrap")
    assert mins.count() == 1442
    assert mins.filter("time = '10:00:00'").count() == 2


def test_overlap_fanout_vs_last_wins(spark):
    log = _log(spark, [(1, 10, "Walk", 5 * 60_000, "2023-02-11T10:00:00.000+02:00"),
                       (1, 11, "Run", 5 * 60_000, "2023-02-11T10:02:00.000+02:00"),
                       (1, 12, "Circuit Training", 60_000, "2023-02-11T10:02:00.000+02:00"),  # same start, higher id
                       (1, 13, "Sport", 60_000, "2023-02-12T10:00:00.000+02:00")])  # day without samples
    smp = _samples(spark, [(1, "2023-02-11", "10:01:00", 80), (1, "2023-02-11", "10:02:00", 90),
                           (1, "2023-02-11", "10:03:00", 95), (1, "2023-02-11", "10:30:00", 70),
                           (2, "2023-02-11", "10:02:00", 60)])
    iv = L.activity_intervals(log, ["user_id"])
    fan = L.label_fanout(smp, iv, keys=["user_id"])
    assert fan.count() == 5 + 2 + 1  # 10:02 matches three activities, 10:03 two
    last = {(r.user_id, r.time): r.sport for r in L.label_last_wins(smp, iv, keys=["user_id"]).collect()}
    assert last == {(1, "10:01:00"): "Walk", (1, "10:02:00"): "Circuit Training",
                    (1, "10:03:00"): "Run", (1, "10:30:00"): "0", (2, "10:02:00"): "0"}
    rng = {(r.user_id, r.time): r.sport
           for r in L.label_range_join(smp, iv, keys=["user_id"]).collect()}
    assert rng == last
    with_samples = {r.activity_id for r in L.activities_with_samples(iv, smp, ["user_id"]).collect()}
    assert with_samples == {10, 11, 12}


def test_seconds_not_zero_never_labelled_and_no_activity(spark):
    smp = _samples(spark, [(1, "2023-02-11", "10:00:30", 80)])
    log = _log(spark, [(1, 1, "Run", 5 * 60_000, "2023-02-11T10:00:00.000+02:00")])
    iv = L.activity_intervals(log, ["user_id"])
    assert [r.sport for r in L.label_last_wins(smp, iv, ["user_id"]).collect()] == ["0"]
    empty = iv.limit(0)
    out = L.label_last_wins(_samples(spark, [(1, "2023-02-11", "10:00:00", 80)]), empty, ["user_id"])
    assert "sport" in out.columns and [r.sport for r in out.collect()] == ["0"]


def test_session_zone_does_not_shift_local_clock(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        log = _log(spark, [(1, 1, "Run", 60_000, "2023-02-11T10:20:31.000+02:00")])
        r = L.activity_minutes(L.activity_intervals(log, ["user_id"]), ["user_id"]).collect()
        assert [(x.date, x.time) for x in r] == [("2023-02-11", "10:20:00")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_midnight_option(spark):
    with pytest.raises(ValueError):
        L.activity_minutes(spark.range(1), midnight="later")


def test_stand_in_activities(spark):
    from tests.conftest import SF01
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    rec = activity_log_records(ev)
    iv = L.activity_intervals(rec, ["user_id"])
    agg = iv.agg({"minutes": "sum"}).collect()[0][0]
    assert rec.count() == 1981 and agg == 98806
    assert iv.filter("minutes = 0").count() == 13


def test_malformed_texts_give_null_not_a_failed_job(spark):
    log = _log(spark, [(1, 1, "Run", 5 * 60_000, "garbage"),
                       (1, 2, "Walk", 2 * 60_000, "2021-13-45T10:00:00.000+02:00"),
                       (1, 3, "Sport", 60_000, "2023-02-11T10:00:00.000+02:00")])
    iv = L.activity_intervals(log, ["user_id"])
    starts = {r.activity_id: r.start for r in iv.collect()}
    assert starts[1] is None and starts[2] is None and starts[3] is not None
    smp = _samples(spark, [(1, "2023-02-11", "10:00:00", 80), (1, "not-a-day", "10:00:00", 81)])
    got = sorted((r.date, r.sport) for r in L.label_last_wins(smp, iv, ["user_id"]).collect())
    assert got == [("2023-02-11", "Sport"), ("not-a-day", "0")]


def test_range_join_across_buckets_and_midnight_equals_carry(spark):
    log = _log(spark, [(1, 1, "Walk", 90 * 60_000, "2023-02-11T23:30:00.000+02:00"),
                       (1, 2, "Run", 20 * 60_000, "2023-02-12T00:10:00.000+02:00")])
    smp = _samples(spark, [(1, "2023-02-11", "23:29:00", 70), (1, "2023-02-11", "23:59:00", 71),
                           (1, "2023-02-12", "00:15:00", 72), (1, "2023-02-12", "00:30:00", 73),
                           (1, "2023-02-12", "00:59:00", 74), (1, "2023-02-12", "01:00:00", 75),
                           (1, "2023-02-11", "00:15:00", 76)])
    iv = L.activity_intervals(log, ["user_id"])
    rng = {(r.date, r.time): r.sport for r in L.label_range_join(smp, iv, ["user_id"]).collect()}
    carry = {(r.date, r.time): r.sport for r in L.label_last_wins(smp, iv, ["user_id"], midnight="carry").collect()}
    wrap = {(r.date, r.time): r.sport for r in L.label_last_wins(smp, iv, ["user_id"], midnight="wrap").collect()}
    assert rng == carry
    assert carry == {("2023-02-11", "23:29:00"): "0", ("2023-02-11", "23:59:00"): "Walk",
                     ("2023-02-12", "00:15:00"): "Run", ("2023-02-12", "00:30:00"): "Walk",
                     ("2023-02-12", "00:59:00"): "Walk", ("2023-02-12", "01:00:00"): "0",
                     ("2023-02-11", "00:15:00"): "0"}
    # wrap keeps the start date: past midnight the walk labels 00:15 of the 1st
    assert wrap[("2023-02-11", "00:15:00")] == "Walk" and wrap[("2023-02-12", "00:59:00")] == "0"


def test_range_join_equals_last_wins_on_odd_rows(spark):
    """Seconds other than 00, repeated samples, overlaps, midnight, days long: as the minute form with carry."""
    import random
    rng = random.Random(8)
    acts = [(1, i, f"A{i}", rng.choice([0, 59_999, 600_000, 5_400_000, 93_000_000]),
             f"2023-02-1{rng.randrange(1, 4)}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}.000+02:00")
            for i in range(40)]
    rows = [(1, f"2023-02-1{rng.randrange(1, 6)}", f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.choice(['00', '00', '30'])}", 80)
            for _ in range(600)]
    rows += rows[:50] + [(1, "2023-02-12", "bad", 1), (1, None, "10:00:00", 1), (2, "2023-02-12", "10:00:00", 1)]
    smp, iv = _samples(spark, rows), L.activity_intervals(_log(spark, acts), ["user_id"])
    a = L.label_range_join(smp, iv, ["user_id"])
    b = L.label_last_wins(smp, iv, ["user_id"], midnight="carry")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == len(rows)


def _brute_labels(acts, rows, midnight):
    """Minute by minute: every covering activity of each sample, and the one that wins."""
    import datetime as dt
    cover = {}
    for user, i, name, ms, start in acts:
        at = dt.datetime.fromisoformat(start[:16])
        for o in range(ms // 60_000):
            t = at + dt.timedelta(minutes=o)
            day = at if midnight == "wrap" else t
            cover.setdefault((user, f"{day:%Y-%m-%d}", f"{t:%H:%M}:00"), []).append((at, i, name))
    fan, last = [], []
    for n, (user, day, time, _) in enumerate(rows):
        found = cover.get((user, day, time), [])
        fan += [(n, x[2]) for x in found] or [(n, "0")]
        last.append((n, max(found)[2] if found else "0"))
    return sorted(fan), sorted(last)


@pytest.mark.parametrize("midnight", ["wrap", "carry"])
@pytest.mark.parametrize("bucket", [7, 60, 1440])
def test_ranges_label_as_minutes_do(spark, midnight, bucket):
    """Overlaps, equal starts, midnight, several days long and equal ranges, at any bucket size."""
    import random
    rng = random.Random(bucket)
    acts = [(rng.choice([1, 2]), i, f"A{rng.randrange(9)}", rng.choice([0, 59_999, 60_000, 600_000, 5_400_000, 86_400_000, 205_000_000]),
             f"2023-02-1{rng.randrange(1, 4)}T{rng.choice([0, 9, 10, 23]):02d}:{rng.randrange(60):02d}:07.000+02:00") for i in range(60)]
    acts += [(1, 100 + i, f"B{i}", 1_800_000, "2023-02-11T10:00:00.000+02:00") for i in range(20)]
    rows = [(rng.choice([1, 2, 3]), f"2023-02-1{rng.randrange(0, 8)}", f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.choice(['00', '00', '30'])}", 80)
            for _ in range(500)]
    rows += rows[:50] + [(1, "2023-02-11", f"10:{m:02d}:00", 1) for m in range(60)] + [(1, None, "10:00:00", 1), (1, "2023-02-11", None, 1)]
    smp = spark.createDataFrame([(u, i, t, v, d, "x") for i, (u, d, t, v) in enumerate(rows)],
                                "user_id long, event_id long, time string, value int, date string, HOUR string")
    iv = L.activity_intervals(_log(spark, acts), ["user_id"])
    want_fan, want_last = _brute_labels(acts, rows, midnight)
    got = L.label_fanout(smp, iv, ["user_id"], midnight=midnight, bucket_minutes=bucket).select("event_id", "sport")
    assert sorted(map(tuple, got.collect())) == want_fan
    got = L.label_last_wins(smp, iv, ["user_id"], midnight=midnight, bucket_minutes=bucket).select("event_id", "sport")
    assert sorted(map(tuple, got.collect())) == want_last


def test_rows_per_activity_do_not_grow_with_its_length(spark):
    acts = [(1, i, "Run", minutes * 60_000, "2023-02-11T23:10:00.000+02:00") for i, minutes in enumerate((5, 500, 1440, 50_000, 5_000_000))]
    iv = L.activity_intervals(_log(spark, acts), ["user_id"])
    per = {r.activity_id: r["count"] for r in L.day_ranges(iv, ["user_id"]).groupBy("activity_id").count().collect()}
    assert per == {0: 1, 1: 2, 2: 1, 3: 3, 4: 3}
    assert L.winning_ranges(iv, ["user_id"]).count() <= 49


def test_a_stamp_gives_the_keys_of_its_texts(spark):
    stamps = ["2023-02-10 23:59:00", "2023-02-11 00:00:00", "2023-02-11 07:05:01", "1969-12-31 01:30:00", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, s string").selectExpr(
        "id", "cast(s as timestamp_ntz) TS", "substr(s, 1, 10) date", "substr(s, 12, 8) time")
    keys = ["id", "_day", "_mod", "_bucket"]
    by_stamp, by_text = (sorted(map(tuple, k.select(*keys).collect())) for k in (L.sample_keys(df, stamp="TS"), L.sample_keys(df)))
    assert by_stamp == by_text
