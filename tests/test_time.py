"""Text from TIMESTAMP_NTZ never depends on the session zone, even for a
wall-clock time inside a daylight-saving gap of that zone."""

import datetime as dt

from pulsekit.functions import clock_text, day_text, hour_text, iso_text
from pulsekit.plans.standins import activity_log_records, samples_from_events


def test_dst_gap_wall_clock_is_kept(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = dt.datetime(2024, 3, 10, 2, 30, 45, 123456)  # does not exist in New York
        ev = spark.createDataFrame([(1, ts, 7, "purchase", 61.9, '{"k": 3}')],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                   "value double, props string")
        r = ev.select(day_text("ts").alias("d"), hour_text("ts").alias("h"), clock_text("ts").alias("c"),
                      iso_text("ts").alias("i")).collect()[0]
        assert (r.d, r.h, r.c, r.i) == ("2024-03-10", "02", "02:30:45", "2024-03-10T02:30:45.123")
        s = samples_from_events(ev).collect()[0]
        assert (s.date, s.time, s.HOUR, s.value) == ("2024-03-10", "02:30:00", "02", 61)
        a = activity_log_records(ev).collect()[0]
        assert a.originalStartTime == "2024-03-10T02:30:45.123+02:00"
        assert a.lastModified == "2024-03-10T00:33:45.123Z"  # + 3 minutes - 2 hours, wall-clock arithmetic
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
