"""Registered queries: hand-over files, landing keys, incremental selection,
track documents and streaming ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions import day_text, iso_text, landing_key, stamp_digits
from pulsekit.operators import samples as SM
from pulsekit.operators import tracks as TR
from pulsekit.plans import standins as SI
from pulsekit.plans.context import USER, Inputs
from pulsekit.plans.queries import query
from pulsekit.plans.queries_features import training_matrix
from pulsekit.session import scratch_path
from pulsekit.sources import incremental as INC
from pulsekit.sources import writers as W
from pulsekit.sources.readers import parse_tcx, read_csv
from pulsekit.streaming.ingest import SINK_SCHEMA, ingest_day_documents, landed_lines

CUTOFF = "2024-01-20"
RANGE = ("2024-01-10", "2024-01-20")
TOP_N = 100
KEEP_SPORT = "Running"

_SAMPLE_TEXT = T.StructType([T.StructField(n, t) for n, t in (
    ("user_id", T.LongType()), ("event_id", T.LongType()), ("time", T.StringType()),
    ("value", T.StringType()), ("date", T.StringType()), ("HOUR", T.StringType()))])


@query
def csv_roundtrip(spark, sf_dir):
    """Samples -> ';' CSV with header -> read back with an explicit all-text
    schema -> typed (``try_cast``: bad numbers become null, not errors)."""
    path = scratch_path(spark, "samples-csv")
    W.write_csv(Inputs(spark, sf_dir).samples, path, header=True, sep=";")
    return SM.typed_samples(read_csv(spark, path, schema=_SAMPLE_TEXT, header=True, sep=";"))


@query
def csv_no_header(spark, sf_dir):
    """Samples -> CSV without header -> read back by position with an explicit
    schema (the first-generation hand-over format)."""
    path = scratch_path(spark, "samples-csv-nohead")
    W.write_csv(Inputs(spark, sf_dir).samples, path, header=False)
    return SM.typed_samples(read_csv(spark, path, schema=_SAMPLE_TEXT, header=False))


@query
def csv_inferred(spark, sf_dir):
    """The training matrix -> ';' CSV with header -> read back with type
    inference (an extra pass over the text): ints stay int, lags double.
    Inference is only safe on such all-numeric files: on the sample CSV it
    turns ``HH:mm:ss`` into a timestamp of the current day."""
    path = scratch_path(spark, "matrix-csv")
    W.write_csv(training_matrix(spark, sf_dir), path, header=True, sep=";")
    return read_csv(spark, path, header=True, sep=";", infer=True)


@query(name="landing_key")
def landing_key_query(spark, sf_dir):
    r = SI.activity_log_records(Inputs(spark, sf_dir).events)
    return r.select("logId", "lastModified",
                    F.concat(landing_key("lastModified"), F.lit(".json")).alias("file_key"),
                    landing_key("originalStartTime").alias("start_key"))


@query(name="stamp_digits")
def stamp_digits_query(spark, sf_dir):
    r = SI.activity_log_records(Inputs(spark, sf_dir).events)
    return r.select("logId", stamp_digits("lastModified").alias("modified_digits"),
                    stamp_digits(landing_key("lastModified")).alias("key_digits"))


def _event_keys(events, ext):
    iso = iso_text("ts", millis=False)
    return events.select(F.concat(landing_key(iso), F.lit(ext)).alias("file_name"))


@query
def new_files_anti(spark, sf_dir):
    """Track files (one per event stamp) not yet converted (purchases are)."""
    ev = Inputs(spark, sf_dir).events
    candidates = _event_keys(ev, ".tcx").distinct()
    converted = _event_keys(ev.filter(F.col("event_type") == "purchase"), ".json")
    return INC.new_files(candidates, converted)


@query
def incremental_hwm(spark, sf_dir):
    """Activity records newer than each user's newest landed file (views)."""
    i = Inputs(spark, sf_dir)
    landed = i.events.filter(F.col("event_type") == "view").select(
        "user_id", F.concat(iso_text("ts"), F.lit("Z")).alias("stamp"))
    recs = SI.activity_log_records(i.events)
    return INC.newer_than_high_water_mark(recs, "lastModified", landed, "stamp", keys=USER) \
        .select("user_id", "logId", "lastModified")


@query
def incremental_hwm_global(spark, sf_dir):
    """Activity records newer than the newest file of an older landed folder
    (its names come from ``orders.o_orderdate``).  The mark is a scalar
    subquery - one value - so there is no join at all."""
    i = Inputs(spark, sf_dir)
    landed = SI.table(spark, sf_dir, "orders").select(
        F.concat(landing_key(iso_text("o_orderdate", millis=False)), F.lit(".json")).alias("file_name"))
    recs = SI.activity_log_records(i.events)
    return INC.newer_than_high_water_mark(recs, "lastModified", landed, "file_name") \
        .select("user_id", "logId", "lastModified")


@query
def upsert_by_day(spark, sf_dir):
    """Newest delivery per (user, day) wins."""
    ev = Inputs(spark, sf_dir).events.select(
        "user_id", day_text("ts").alias("date"), "ts", "event_id",
        F.floor("value").cast("int").alias("value"))
    return INC.newest_per_key(ev, ["user_id", "date"], ["ts", "event_id"])


@query
def latest_n_before(spark, sf_dir):
    r = SI.activity_log_records(Inputs(spark, sf_dir).events)
    return INC.latest_n_before(r, "lastModified", CUTOFF, TOP_N, "logId") \
        .select("logId", "lastModified", "activityName")


@query
def days_in_range(spark, sf_dir):
    return INC.days_in_range(Inputs(spark, sf_dir, RANGE).samples, "date", *RANGE, keys=USER)


def _tcx(spark, sf_dir):
    docs = SI.tcx_documents(Inputs(spark, sf_dir).events)
    return docs.select("user_id", "date", "part", parse_tcx("document").alias("a")).select(
        "user_id", "date", "part", "a.*")


@query
def trackpoint_flatten(spark, sf_dir):
    return TR.flatten_trackpoints(_tcx(spark, sf_dir), keep=["user_id", "date", "part"])


@query
def files_per_sport(spark, sf_dir):
    return _tcx(spark, sf_dir).groupBy(F.col("_Sport").alias("sport")) \
        .agg(F.count(F.lit(1)).alias("n_files"))


@query
def partitioned_by_sport(spark, sf_dir):
    """TCX -> reshaped JSON documents in one folder per sport; read one sport
    back (only its folder is listed)."""
    acts = TR.reshape_trackpoints(_tcx(spark, sf_dir)).select(
        "Id", F.col("_Sport").alias("sport"), "Lap")
    path = scratch_path(spark, "tcx-json")
    W.write_partitioned(acts, path, ["sport"], fmt="json")
    body = T.StructType([f for f in acts.schema.fields if f.name != "sport"] +
                        [T.StructField("sport", T.StringType())])
    back = spark.read.schema(body).json(path).filter(F.col("sport") == KEEP_SPORT)
    laps = back.select("Id", "sport", F.posexplode("Lap").alias("lap", "l"))
    pts = laps.select("Id", "sport", "lap", F.explode("l.Track").alias("t")) \
        .select("Id", "sport", "lap", F.explode("t.Trackpoint").alias("p"))
    return pts.select("Id", "sport", "lap", "p.Time", "p.LatitudeDegrees", "p.LongitudeDegrees",
                      "p.HeartRateBPM")


@query
def stream_ingest(spark, sf_dir):
    """Day documents landed as JSON lines (one folder per day, the user key in
    each record), ingested by a file-source stream (availableNow) into
    Parquet; the sink is returned."""
    samples = Inputs(spark, sf_dir).samples
    docs = SI.day_documents(samples.withColumn("day", F.col("date")), extra_keys=["day"])
    landing = scratch_path(spark, "landing-heart")
    W.land_documents(docs.select("day", landed_lines("user_id", "document").alias("value")),
                     landing, by=["day"])
    sink, ckpt = scratch_path(spark, "heart-sink"), scratch_path(spark, "heart-ckpt")
    ingest_day_documents(spark, landing, sink, ckpt)
    return spark.read.schema(SINK_SCHEMA).parquet(sink).select("user_id", "time", "value", "date", "HOUR")

