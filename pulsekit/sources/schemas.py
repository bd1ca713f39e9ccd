"""Explicit StructTypes for every source.

Inference is avoided on purpose: a scan of day documents whose minute
series are all empty infers ``array<string>`` and the field access to
``time`` no longer resolves; a single XML ``Lap`` infers as a struct instead
of an array.  With these schemas both shapes read the same way.
"""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _D, _B = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


ZONE = T.StructType([_f("caloriesOut", _D), _f("max", _L), _f("min", _L),
                     _f("minutes", _L), _f("name", _S)])

# One element of the top-level array of a heart day document.
DAY_DOCUMENT = T.StructType([
    _f("activities-heart", T.ArrayType(T.StructType([
        _f("dateTime", _S),
        _f("value", T.StructType([
            _f("customHeartRateZones", T.ArrayType(ZONE)),
            _f("heartRateZones", T.ArrayType(ZONE)),
            _f("restingHeartRate", _L)])),
    ]))),
    _f("activities-heart-intraday", T.StructType([
        _f("dataset", T.ArrayType(T.StructType([_f("time", _S), _f("value", _L)]))),
        _f("datasetInterval", _L),
        _f("datasetType", _S)])),
])

# One element of an activity-log document.
ACTIVITY_LOG = T.StructType([
    _f("activeDuration", _L), _f("activityName", _S), _f("activityTypeId", _L),
    _f("averageHeartRate", _L), _f("calories", _L), _f("caloriesLink", _S),
    _f("distance", _D), _f("distanceUnit", _S), _f("duration", _L),
    _f("elevationGain", _D), _f("hasActiveZoneMinutes", _B),
    _f("heartRateLink", _S), _f("lastModified", _S), _f("logId", _L),
    _f("logType", _S), _f("originalDuration", _L), _f("originalStartTime", _S),
    _f("pace", _D), _f("speed", _D), _f("startTime", _S), _f("steps", _L),
    _f("tcxLink", _S),
    _f("activeZoneMinutes", T.StructType([
        _f("minutesInHeartRateZones", T.ArrayType(T.StructType([
            _f("minuteMultiplier", _L), _f("minutes", _L), _f("order", _L),
            _f("type", _S), _f("zoneName", _S)]))),
        _f("totalMinutes", _L)])),
    _f("activityLevel", T.ArrayType(T.StructType([_f("minutes", _L), _f("name", _S)]))),
    _f("heartRateZones", T.ArrayType(ZONE)),
    _f("manualValuesSpecified", T.StructType([
        _f("calories", _B), _f("distance", _B), _f("steps", _B)])),
    _f("source", T.StructType([
        _f("id", _S), _f("name", _S), _f("trackerFeatures", T.ArrayType(_S)),
        _f("type", _S), _f("url", _S)])),
])

# TCX track document, rowTag = Activity; the Sport attribute reads as _Sport.
# Every repeating element is an array, so one lap / one trackpoint read as
# one-element arrays.
TRACKPOINT = T.StructType([
    _f("Time", _S),
    _f("Position", T.StructType([_f("LatitudeDegrees", _D), _f("LongitudeDegrees", _D)])),
    _f("AltitudeMeters", _D),
    _f("DistanceMeters", _D),
    _f("HeartRateBpm", T.StructType([_f("Value", _L)])),
])
TCX_ACTIVITY = T.StructType([
    _f("_Sport", _S),
    _f("Id", _S),
    _f("Lap", T.ArrayType(T.StructType([
        _f("_StartTime", _S),
        _f("Track", T.ArrayType(T.StructType([
            _f("Trackpoint", T.ArrayType(TRACKPOINT))]))),
    ]))),
])

# Hand-over tables (typed; CSV only at the edges).
SAMPLES = T.StructType([_f("time", _S), _f("value", T.IntegerType()),
                        _f("date", _S), _f("HOUR", _S)])
SAMPLES_TEXT = T.StructType([_f("time", _S), _f("value", _S), _f("date", _S), _f("HOUR", _S)])
# First-generation heart CSV without header: all text.
HEART_CSV_V1 = T.StructType([_f("TS", _S), _f("BPM", _S), _f("Date", _S)])
