"""Time-text helpers.

Timestamps stay ``TIMESTAMP_NTZ`` (local wall clock) end to end, so nothing
depends on the session time zone.  ISO start texts carry an offset
(``...T10:20:31.000+02:00``); the wall clock wanted is the first 19
characters, not the UTC instant.

Text is parsed tolerantly: with ANSI mode on, ``to_timestamp`` / ``to_date``
fail the whole job on one malformed record; here fields are cut by position
and assembled with ``try_make_timestamp_ntz`` / ``try_to_date``, so a bad
text gives null (and never a zone shift).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_of(time_col) -> Column:
    """``HH`` of an ``HH:mm:ss`` text (split on ':' and take item 0)."""
    return F.split(_c(time_col), ":").getItem(0)


def day_of_iso(iso_col) -> Column:
    """Date part of an ISO text: everything before 'T'."""
    return F.split(_c(iso_col), "T").getItem(0)


def _field(text: Column, pos: int, length: int) -> Column:
    return F.substring(text, pos, length).try_cast("int")


def _ymd(text: Column, hour: Column, minute: Column, second: Column) -> Column:
    return F.try_make_timestamp_ntz(_field(text, 1, 4), _field(text, 6, 2), _field(text, 9, 2),
                                    hour, minute, second)


def local_wall_clock(iso_col) -> Column:
    """ISO text with zone offset -> local wall-clock TIMESTAMP_NTZ (seconds)."""
    s = _c(iso_col)
    return _ymd(s, _field(s, 12, 2), _field(s, 15, 2), _field(s, 18, 2))


def start_minute(iso_col) -> Column:
    """ISO text -> local wall clock cut to the minute (``HH:MM:00``)."""
    s = _c(iso_col)
    return _ymd(s, _field(s, 12, 2), _field(s, 15, 2), F.lit(0))


def day_number(date_col) -> Column:
    """``yyyy-MM-dd`` text -> days since 1970-01-01 (null when malformed)."""
    return F.unix_date(F.try_to_date(_c(date_col), "yyyy-MM-dd"))


def whole_minutes(ms_col) -> Column:
    """Duration in ms -> whole minutes, rounded down (integral division)."""
    return F.expr(f"CAST(CAST({_sql(ms_col)} AS BIGINT) DIV 60000 AS INT)")


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


# Text from TIMESTAMP_NTZ is built from its fields: ``date_format`` would
# first cast to a zoned TIMESTAMP, which moves wall-clock times that fall in a
# daylight-saving gap of the session zone (02:30 -> 03:30).

def day_text(ts_col) -> Column:
    """TIMESTAMP_NTZ -> ``yyyy-MM-dd``."""
    return F.to_date(_c(ts_col)).cast("string")


def hour_text(ts_col) -> Column:
    """TIMESTAMP_NTZ -> ``HH``."""
    return _two(F.hour(_c(ts_col)))


def clock_text(ts_col, seconds: bool = True) -> Column:
    """TIMESTAMP_NTZ -> ``HH:mm:ss`` (or ``HH:mm:00`` with ``seconds=False``)."""
    ts = _c(ts_col)
    sec = _two(F.second(ts)) if seconds else F.lit("00")
    return F.concat(_two(F.hour(ts)), F.lit(":"), _two(F.minute(ts)), F.lit(":"), sec)


def iso_text(ts_col, millis: bool = True) -> Column:
    """TIMESTAMP_NTZ -> ``yyyy-MM-ddTHH:mm:ss[.SSS]`` (milliseconds truncated)."""
    ts = _c(ts_col)
    parts = [day_text(ts), F.lit("T"), clock_text(ts)]
    if millis:
        ms = F.floor(F.pmod(epoch_micros(ts), F.lit(1_000_000)) / 1000)
        parts += [F.lit("."), F.lpad(ms.cast("string"), 3, "0")]
    return F.concat(*parts)


def time_as_int(time_col) -> Column:
    """``HH:MM:SS`` -> integer ``HHMMSS`` (leading zeros are lost)."""
    return F.regexp_replace(_c(time_col), ":", "").try_cast("int")


def epoch_micros(ntz_col) -> Column:
    """TIMESTAMP_NTZ -> microseconds since 1970-01-01 00:00, zone independent."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ntz_col))


def ts_from_day_hour(date_col, hour_col) -> Column:
    """Day text + ``HH`` text -> TIMESTAMP_NTZ at the full hour."""
    return _ymd(_c(date_col), _c(hour_col).try_cast("int"), F.lit(0), F.lit(0))


def ts_from_day_time(date_col, time_col) -> Column:
    """Day text + ``HH:mm:ss`` text -> TIMESTAMP_NTZ."""
    t = _c(time_col)
    return _ymd(_c(date_col), _field(t, 1, 2), _field(t, 4, 2), _field(t, 7, 2))


def landing_key(stamp_col) -> Column:
    """ISO stamp -> file key ``YYYY-MM-DD_HHhMMmSSs``."""
    s = _c(stamp_col)
    return F.concat(F.substring(s, 1, 10), F.lit("_"), F.substring(s, 12, 2), F.lit("h"),
                    F.substring(s, 15, 2), F.lit("m"), F.substring(s, 18, 2), F.lit("s"))


def sleep_start(document_col) -> Column:
    """Start time of the first record of a landed sleep document, the only field ever read from one."""
    return F.get_json_object(_c(document_col), "$[0].sleep[0].startTime")


def stamp_digits(stamp_col) -> Column:
    """ISO stamp or landing key -> its 14 digits ``YYYYMMDDHHMMSS`` as BIGINT."""
    return F.regexp_replace(F.substring(_c(stamp_col), 1, 19), "[^0-9]", "").try_cast("bigint")


def strip_extension(name_col) -> Column:
    return F.regexp_replace(_c(name_col), r"\.[^.]*$", "")


def _sql(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("pass a column name")
