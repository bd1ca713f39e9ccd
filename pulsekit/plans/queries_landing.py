"""Registered queries: deliveries under keys, sleep records, days replaced in place, bounded stream batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.functions import day_text, landing_key, sleep_start
from pulsekit.plans import standins as SI
from pulsekit.plans.context import USER, Inputs
from pulsekit.plans.queries import query
from pulsekit.plans.queries_ingest import CUTOFF, TOP_N
from pulsekit.session import scratch_path
from pulsekit.sources import incremental as INC
from pulsekit.sources import writers as W
from pulsekit.sources.landing import land_keyed, land_new
from pulsekit.streaming.ingest import current_days, ingest_bounded, landed_lines

#: Days (inclusive) up to which the first delivery goes, and from which the second one does.
FIRST_UNTIL, SECOND_FROM = "2024-01-20", "2024-01-17"
REDELIVERED = 1000  # what a value is raised by when its day is delivered again
MAX_FILES = 12


def _user_key(stamp):
    return F.concat(landing_key(stamp), F.lit("_u"), F.col("user_id").cast("string"))


# --- activity documents under their key

def _activity_documents(spark, sf_dir):
    """file_key, logId, document: an activity record under the key of its last change and person."""
    r = SI.activity_log_records(Inputs(spark, sf_dir).events)
    body = F.struct(*[c for c in r.columns if c != "user_id"])
    return r.select(_user_key("lastModified").alias("file_key"), "logId", F.to_json(F.array(body)).alias("document"))


@query
def second_delivery(spark, sf_dir):
    """Activity documents of the first days are landed, then a delivery that overlaps them: what it lands.  The
    anti join reads the landed keys of the touched buckets only."""
    docs = _activity_documents(spark, sf_dir)
    path = scratch_path(spark, "landed-activities")
    land_new(docs.filter(F.substring("file_key", 1, 10) <= FIRST_UNTIL), path, order=["logId"])
    return land_new(docs.filter(F.substring("file_key", 1, 10) >= SECOND_FROM), path, order=["logId"])


@query
def latest_n_partitioned(spark, sf_dir):
    """The most recent activities before a cut-off, from a log landed by day: days are walked back until they
    hold enough rows, older folders are not read."""
    r = SI.activity_log_records(Inputs(spark, sf_dir).events).select("logId", "lastModified", "activityName")
    landed = r.withColumn("day", F.substring("lastModified", 1, 10))
    path = scratch_path(spark, "activities-by-day")
    W.write_partitioned(landed.hint("rebalance", "day"), path, ["day"], fmt="parquet")
    return INC.latest_n_in_days(spark, path, landed.schema, "lastModified", CUTOFF, TOP_N, "logId") \
        .select("logId", "lastModified", "activityName")


# --- sleep

def _sleep_table(spark, sf_dir, until=None):
    """Sleep documents as they are, landed under the key of their start time; only that was read from them."""
    docs = SI.sleep_documents(Inputs(spark, sf_dir).events)
    keyed = docs.select(_user_key(sleep_start("document")).alias("file_key"), "user_id", "document")
    if until:
        keyed = keyed.filter(F.substring("file_key", 1, 10) <= until)
    path = scratch_path(spark, "landed-sleep")
    land_keyed(keyed, path)
    return spark.read.schema("file_key string, user_id long, document string, bucket int").parquet(path)


@query
def sleep_landing(spark, sf_dir):
    """Every landed sleep document with its key, and its start time."""
    return _sleep_table(spark, sf_dir).select("user_id", "file_key", sleep_start("document").alias("startTime"), "document")


@query
def sleep_incremental(spark, sf_dir):
    """Start times newer than each person's newest landed sleep (a list is compared with the landed keys)."""
    landed = _sleep_table(spark, sf_dir, FIRST_UNTIL).select("user_id", "file_key")
    listed = SI.sleep_documents(Inputs(spark, sf_dir).events).select("user_id", sleep_start("document").alias("startTime"))
    return INC.newer_than_high_water_mark(listed, "startTime", landed, "file_key", keys=USER)


@query
def sleep_latest_n(spark, sf_dir):
    """The most recent sleep start times before a cut-off."""
    table = _sleep_table(spark, sf_dir).select(sleep_start("document").alias("startTime"), "file_key")
    return INC.latest_n_before(table, "startTime", CUTOFF, TOP_N, "file_key").select("startTime", "file_key")


# --- days delivered again

@query
def redelivered_day(spark, sf_dir):
    """All days are landed, then everything from the last landed day on is delivered again with new values, twice:
    that day is replaced, the others stay."""
    days = Inputs(spark, sf_dir).samples.select("user_id", "event_id", "time", "value", "date")
    path = scratch_path(spark, "heart-days")
    W.upsert_days(days, path)
    landed = spark.read.schema(days.schema).parquet(path)
    last = landed.agg(F.max("date").alias("d")).first()["d"]
    again = days.filter(F.col("date") >= last).withColumn("value", F.col("value") + REDELIVERED)
    for _ in range(2):
        W.upsert_days(again, path)
    return spark.read.schema(days.schema).parquet(path)


@query
def stream_bounded(spark, sf_dir):
    """Landed day documents streamed in batches of a bounded number of files; after a restart some days come again
    with new values and replace the old ones.  Cut-off records (those of every seventh person) go to the quarantine."""
    samples = Inputs(spark, sf_dir).samples
    landing, sink, ckpt, bad = (scratch_path(spark, f"bounded-{x}") for x in ("landing", "sink", "ckpt", "quarantine"))

    def deliver(rows):
        docs = SI.day_documents(rows.withColumn("day", F.col("date")), extra_keys=["day"])
        line = landed_lines("user_id", "document")
        cut = F.when(F.col("user_id") % 7 == 3, F.substring(line, F.lit(1), F.length(line) - 9)).otherwise(line)
        W.land_documents(docs.select("day", cut.alias("value")), landing, by=["day"])
        ingest_bounded(spark, landing, sink, ckpt, bad, MAX_FILES)

    deliver(samples)
    deliver(samples.filter(F.col("date") >= FIRST_UNTIL).withColumn("value", F.col("value") + REDELIVERED))
    return current_days(spark, sink).select("user_id", "time", "value", "date", "HOUR")
