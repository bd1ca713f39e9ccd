"""Column expressions shared by the operators (all JVM-side built-ins)."""

from pulsekit.functions.timecols import (  # noqa: F401
    clock_text, day_number, day_of_iso, day_text, epoch_micros, hour_text, iso_text, hour_of, landing_key, local_wall_clock,
    start_minute, sleep_start, stamp_digits, strip_extension, time_as_int, ts_from_day_hour,
    ts_from_day_time, whole_minutes,
)
from pulsekit.functions.labels import (  # noqa: F401
    NO_LABEL, NO_LABEL_COLUMN, SPORTS, one_hot_columns, sport_marker,
)
