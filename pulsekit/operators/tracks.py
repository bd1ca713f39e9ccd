"""TCX track documents: lift position and heart rate onto the trackpoint.

Every sport, lap, track and trackpoint is treated the same; an explicit
schema with arrays removes the one-child-versus-list ambiguity of XML, so no
length heuristic is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lift(tp):
    return F.struct(tp["Time"].alias("Time"),
                    tp["Position"]["LatitudeDegrees"].alias("LatitudeDegrees"),
                    tp["Position"]["LongitudeDegrees"].alias("LongitudeDegrees"),
                    tp["AltitudeMeters"].alias("AltitudeMeters"),
                    tp["DistanceMeters"].alias("DistanceMeters"),
                    tp["HeartRateBpm"]["Value"].cast("int").alias("HeartRateBPM"))


def reshape_trackpoints(acts: DataFrame) -> DataFrame:
    """Same nesting (Lap -> Track -> Trackpoint), wrappers replaced by fields;
    a per-row ``transform``, no explode and no regrouping."""
    lap = F.transform("Lap", lambda l: F.struct(
        l["_StartTime"].alias("_StartTime"),
        F.transform(l["Track"], lambda t: F.struct(
            F.transform(t["Trackpoint"], _lift).alias("Trackpoint"))).alias("Track")))
    return acts.withColumn("Lap", lap)


def flatten_trackpoints(acts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per trackpoint: keep..., sport, lap (0-based), Time, latitude,
    longitude, HeartRateBPM."""
    laps = acts.select(*keep, F.col("_Sport").alias("sport"), F.posexplode("Lap").alias("lap", "l"))
    tracks = laps.select(*keep, "sport", "lap", F.explode("l.Track").alias("tr"))
    points = tracks.select(*keep, "sport", "lap", F.explode("tr.Trackpoint").alias("tp"))
    return points.select(*keep, "sport", "lap",
                         F.col("tp.Time").alias("Time"),
                         F.col("tp.Position.LatitudeDegrees").alias("LatitudeDegrees"),
                         F.col("tp.Position.LongitudeDegrees").alias("LongitudeDegrees"),
                         F.col("tp.HeartRateBpm.Value").cast("int").alias("HeartRateBPM"))


# --- whole documents: values of any schema

LIFTED = {"Position": ("LatitudeDegrees", "LongitudeDegrees"), "HeartRateBpm": ("HeartRateBPM",)}


def _list(v):
    return F.try_variant_get(v, "$", "array<variant>")


def _fields(v):
    return F.try_variant_get(v, "$", "map<string,variant>")


def _each(v, body):
    """``body`` of every element of a list, or of the one element: a single child stays a single child."""
    many = _list(v)
    return F.when(many.isNotNull(), F.to_variant_object(F.transform(many, body))).otherwise(body(v))


def _replaced(v, name: str, body):
    """The object with ``body`` applied to one field, where it has it; every other field stays."""
    def value(key, x):
        return F.when(key == name, _each(x, body)).otherwise(x)

    return F.when(_fields(v).isNotNull(), F.to_variant_object(F.transform_values(_fields(v), value))).otherwise(v)


def _lifted(tp):
    found = F.map_filter(
        F.create_map(F.lit("LatitudeDegrees"), F.try_variant_get(tp, "$.Position.LatitudeDegrees", "variant"),
                     F.lit("LongitudeDegrees"), F.try_variant_get(tp, "$.Position.LongitudeDegrees", "variant"),
                     F.lit("HeartRateBPM"), F.try_variant_get(tp, "$.HeartRateBpm.Value", "variant")),
        lambda _, v: v.isNotNull())
    kept = F.map_filter(_fields(tp), lambda k, _: ~k.isin(*LIFTED) & ~F.array_contains(F.map_keys(found), k))
    return F.when(_fields(tp).isNotNull(), F.to_variant_object(F.map_concat(kept, found))).otherwise(tp)


def reshape_whole_documents(acts: DataFrame, document: str = "document") -> DataFrame:
    """Position and heart rate lifted to every trackpoint of schema-free activities; all other fields stay.

    One or several laps, tracks and points are each accepted and keep their form.  A document that is no
    object, or has no laps, is unchanged; null stays null.  Per row, no explode and no regrouping.
    """
    def track(t):
        return _replaced(t, "Trackpoint", _lifted)

    def lap(x):
        return _replaced(x, "Track", track)

    return acts.withColumn(document, _replaced(F.col(document), "Lap", lap))


def _as_list(v):
    return F.coalesce(_list(v), F.when(v.isNotNull(), F.array(v)))


def flatten_whole_documents(acts: DataFrame, keep: Sequence[str] = (), document: str = "document") -> DataFrame:
    """keep..., lap (0-based), lap_document, point: a row per trackpoint, each as schema-free values."""
    def child(v, path):
        return _as_list(F.try_variant_get(v, path, "variant"))

    laps = acts.select(*keep, F.posexplode(child(F.col(document), "$.Lap")).alias("lap", "lap_document"))
    tracks = laps.select(*keep, "lap", "lap_document", F.explode(child(F.col("lap_document"), "$.Track")).alias("t"))
    return tracks.select(*keep, "lap", "lap_document", F.explode(child(F.col("t"), "$.Trackpoint")).alias("point"))
