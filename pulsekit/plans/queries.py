"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads the shared tables (through the stand-ins of ``standins``) in
full and returns a lazy DataFrame whose column names equal those of the
oracle SQL in ``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions import strip_extension, time_as_int
from pulsekit.operators import label as L
from pulsekit.operators import samples as SM
from pulsekit.operators import series as V
from pulsekit.operators import stats as ST
from pulsekit.plans import standins as SI
from pulsekit.plans.context import USER, Inputs
from pulsekit.sources import schemas as S
from pulsekit.sources.readers import day_from_file_name, parse_json_array

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

PROFILE_DAY = "2024-01-15"
UNION_CUT = "2024-01-16 00:00:00"


def query(fn: Query | None = None, *, name: str | None = None):
    """Register ``fn`` under its own name or ``name``."""
    def register(f: Query) -> Query:
        REGISTRY[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


# --- samples and rollups -------------------------------------------------

@query
def hourly_stats(spark, sf_dir):
    return ST.hourly_stats(Inputs(spark, sf_dir).samples)


@query
def daily_stats(spark, sf_dir):
    return ST.daily_stats(Inputs(spark, sf_dir).samples)


@query
def heart_flatten(spark, sf_dir):
    """Day documents (JSON text) -> parsed with the explicit schema -> samples."""
    docs = SI.day_documents(Inputs(spark, sf_dir).samples)
    parsed = docs.select("user_id", F.explode(parse_json_array("document", S.DAY_DOCUMENT)).alias("d")) \
                 .select("user_id", "d.*")
    return SM.flatten_day_documents(parsed, keep=USER)


@query
def file_name_date(spark, sf_dir):
    """Day taken from the file name of each user's day file."""
    s = Inputs(spark, sf_dir).samples
    files = s.select("user_id", F.concat(F.lit("user="), F.col("user_id").cast("string"),
                                         F.lit("/"), F.col("date"), F.lit(".json")).alias("file_name")).distinct()
    base = F.element_at(F.split("file_name", "/"), -1)
    return files.select("user_id", "file_name", strip_extension(base).alias("stem"),
                        day_from_file_name("file_name").alias("day"))


@query
def union_days(spark, sf_dir):
    """Union (by name) of per-period frames, each tagged with a literal.

    Each branch filters the raw ``ts`` column, so the predicate reaches the
    Parquet scan: on time-ordered or day-partitioned input each branch reads
    only its own row groups / folders, and the union costs one pass of I/O."""
    ev = Inputs(spark, sf_dir).events
    cut = F.lit(UNION_CUT).cast("timestamp_ntz")
    first = SI.samples_from_events(ev.filter(F.col("ts") < cut)).withColumn("period", F.lit("first"))
    second = SI.samples_from_events(ev.filter(F.col("ts") >= cut)).withColumn("period", F.lit("second"))
    return first.unionByName(second)


@query
def daily_median(spark, sf_dir):
    return ST.daily_median(Inputs(spark, sf_dir).samples)


@query
def hourly_median(spark, sf_dir):
    return ST.hourly_median(Inputs(spark, sf_dir).samples)


@query
def hourly_lists(spark, sf_dir):
    return ST.value_runs(Inputs(spark, sf_dir).samples, ["date", "HOUR"])


@query
def per_user_hourly(spark, sf_dir):
    return ST.hourly_median(Inputs(spark, sf_dir).samples, keys=USER)


# --- labelling -----------------------------------------------------------

@query
def activity_intervals(spark, sf_dir):
    """Activity-log JSON documents, parsed with the explicit schema -> intervals."""
    return L.activity_intervals(Inputs(spark, sf_dir).activity_log, keep=USER)


@query
def json_roundtrip(spark, sf_dir):
    """Activity records -> JSON documents -> parsed back (explicit schema)."""
    return Inputs(spark, sf_dir).activity_log.select(
        "user_id", "logId", "activityName", "originalDuration", "originalStartTime", "lastModified")


@query
def activity_minutes(spark, sf_dir):
    return Inputs(spark, sf_dir).minutes("wrap")


@query
def activities_with_samples(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return L.activities_with_samples(i.intervals, i.samples, keys=USER)


@query
def label_fanout(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return L.label_fanout(i.samples, i.intervals, keys=USER)


@query
def label_fanout_carry(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return L.label_fanout(i.samples, i.intervals, keys=USER, midnight="carry")


@query
def label_last_wins(spark, sf_dir):
    return Inputs(spark, sf_dir).labelled


@query
def label_range_join(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return L.label_range_join(i.samples, i.intervals, keys=USER)


@query
def daily_stats_sport(spark, sf_dir):
    return Inputs(spark, sf_dir).daily_sport


@query
def hourly_stats_sport(spark, sf_dir):
    return Inputs(spark, sf_dir).hourly_sport


@query
def first_sample_per_day(spark, sf_dir):
    """The first record of each user's day in a defined order (time, then id)."""
    s = Inputs(spark, sf_dir).samples
    return (s.groupBy("user_id", "date")
            .agg(F.min_by(F.struct("time", "event_id", "value"), F.struct("time", "event_id")).alias("r"))
            .select("user_id", "date", "r.time", "r.event_id", "r.value"))


@query
def labels_per_sport(spark, sf_dir):
    """How many samples each label got (last wins)."""
    return ST.count_by(Inputs(spark, sf_dir).labelled, ["sport"], "n_samples")


# --- series --------------------------------------------------------------

@query
def daily_series(spark, sf_dir):
    return V.daily_series(Inputs(spark, sf_dir).daily_sport)


@query
def daily_series_plain(spark, sf_dir):
    return V.daily_series(Inputs(spark, sf_dir).daily_sport, with_marker=False)


@query
def hourly_series(spark, sf_dir):
    return V.hourly_series(Inputs(spark, sf_dir).hourly_sport)


@query
def day_profile(spark, sf_dir):
    return V.day_profile(Inputs(spark, sf_dir, (PROFILE_DAY, PROFILE_DAY)).hourly_sport, PROFILE_DAY)


@query(name="time_as_int")
def time_as_int_query(spark, sf_dir):
    s = Inputs(spark, sf_dir).samples
    return s.select("event_id", "time", time_as_int("time").alias("time_int"))



def queries() -> dict[str, Query]:
    from pulsekit.plans import queries_features, queries_files, queries_ingest, queries_landing  # noqa: F401  (register)
    return dict(REGISTRY)
