"""Stand-ins: the source application's inputs, derived from the shared tables.

The shared test data has no heart documents, activity logs or TCX files, so
they are derived from ``events`` (every definition is deterministic and
covers the whole table):

* samples    one per event: day, ``HH:mm:00``, ``HH``, whole value, user, id
* activities one per ``purchase`` event: ``k`` from ``props``; duration
             ``k`` minutes + 30 s (so the floor matters and k = 0 labels
             nothing); start = local ISO text with ``+02:00``; name by ``k mod 5``
* day documents / activity-log documents / TCX documents: JSON or XML
  text built from those rows, to be parsed back by the readers.
* document files: one file per (day, ``event_id div 1440``), some of them broken by a rule on the file number
* sleep documents: one per ``error`` event, landed opaque under the key of their start time
* device minutes: unbroken runs of minutes, one run per purchase of 30 minutes or more
* landed file names: landing keys of event stamps, and of ``orders.o_orderdate``
  for an older landed folder (a high-water mark from another table).

Documents are grouped by (user, day, ``event_id div 1440``): since ids are
unique, no document holds more than 1440 samples however hot a user or a
day is, like a real one-day minute series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions import SPORTS, clock_text, day_text, hour_of, hour_text, iso_text

# Sport names of TCX activities (public TCX schema values).
TCX_SPORTS = ["Running", "Biking", "Other"]
DOC_SPAN = 1440  # ids per document group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def samples_from_events(events: DataFrame) -> DataFrame:
    return (events.select(
        "user_id", "event_id",
        clock_text("ts", seconds=False).alias("time"),
        F.floor("value").cast("int").alias("value"),
        day_text("ts").alias("date"))
        .withColumn("HOUR", hour_of("time")))


def activity_log_records(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    names = F.array(*[F.lit(s) for s in SPORTS])
    return (events.filter(F.col("event_type") == "purchase")
            .withColumn("_k", k)
            .select(
                "user_id",
                F.col("event_id").alias("logId"),
                F.element_at(names, (F.pmod("_k", F.lit(len(SPORTS))) + 1).cast("int")).alias("activityName"),
                (F.col("_k").cast("bigint") * 60000 + 30000).alias("originalDuration"),
                F.concat(iso_text("ts"), F.lit("+02:00")).alias("originalStartTime"),
                F.concat(iso_text(F.expr("timestampadd(MINUTE, _k - 120, ts)")), F.lit("Z"))
                .alias("lastModified"),
            ))


def activity_log_documents(events: DataFrame) -> DataFrame:
    """``user_id, document``: one JSON array text per activity record."""
    rec = activity_log_records(events)
    body = F.struct(*[c for c in rec.columns if c != "user_id"])
    return rec.select("user_id", F.concat(F.lit("["), F.to_json(body), F.lit("]")).alias("document"))


def day_documents(samples: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """``user_id, part[, extra keys], document``: day-document JSON text per
    (user, day, part)."""
    extra = list(extra_keys or [])
    part = F.floor(F.col("event_id") / F.lit(DOC_SPAN)).alias("part")
    grouped = samples.groupBy("user_id", "date", part, *extra).agg(
        F.sort_array(F.collect_list(F.struct("time", F.col("value").cast("bigint").alias("value"))))
        .alias("dataset"))
    doc = F.struct(
        F.array(F.struct(F.col("date").alias("dateTime"),
                         F.struct(F.lit(None).cast("bigint").alias("restingHeartRate")).alias("value")))
        .alias("activities-heart"),
        F.struct(F.col("dataset"), F.lit(1).alias("datasetInterval"),
                 F.lit("minute").alias("datasetType")).alias("activities-heart-intraday"))
    return grouped.select("user_id", "part", *extra,
                          F.concat(F.lit("["), F.to_json(doc), F.lit("]")).alias("document"))


def tcx_documents(events: DataFrame, whole: bool = False) -> DataFrame:
    """``user_id, date, part, document``: one ``<Activity>`` XML text per
    (user, day, part); a lap per hour, one track per lap, a trackpoint per
    event.  Position only for views and clicks, heart rate for all but errors.
    ``whole`` adds fields that no schema here lists: notes, calories of a lap,
    cadence and a speed extension of a point."""
    sports = F.array(*[F.lit(s) for s in TCX_SPORTS])
    extras = [F.pmod("event_id", F.lit(90)).alias("Cadence"),
              F.struct(F.struct((F.floor("value") / 4).alias("Speed")).alias("TPX")).alias("Extensions")] if whole else []
    point = F.struct(
        F.concat(iso_text("ts"), F.lit("Z")).alias("Time"),
        F.when(F.col("event_type").isin("view", "click"),
               F.struct((F.col("value") / 10).alias("LatitudeDegrees"),
                        (F.col("user_id") / 100).alias("LongitudeDegrees"))).alias("Position"),
        F.when(F.col("event_type") != "error",
               F.struct(F.floor("value").cast("bigint").alias("Value"))).alias("HeartRateBpm"), *extras)
    keyed = events.select(
        "user_id", day_text("ts").alias("date"),
        F.floor(F.col("event_id") / F.lit(DOC_SPAN)).alias("part"),
        hour_text("ts").alias("hour"), "event_id", point.alias("tp"))
    laps = (keyed.groupBy("user_id", "date", "part", "hour")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("tp.Time").alias("k"),
                                                      F.col("event_id").alias("id"), "tp")))
                 .alias("pts")))
    laps = laps.select("user_id", "date", "part", F.struct(
        F.concat(F.col("date"), F.lit("T"), F.col("hour"), F.lit(":00:00.000Z")).alias("_StartTime"),
        *[F.size("pts").alias("Calories")] * whole,
        F.array(F.struct(F.transform("pts", lambda p: p["tp"]).alias("Trackpoint"))).alias("Track"))
        .alias("lap"))
    acts = laps.groupBy("user_id", "date", "part").agg(
        F.sort_array(F.collect_list("lap")).alias("Lap"))
    body = F.struct(
        F.element_at(sports, (F.pmod("user_id", F.lit(len(TCX_SPORTS))) + 1).cast("int")).alias("_Sport"),
        F.concat(F.col("date"), F.lit("-"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("part").cast("string")).alias("Id"),
        F.col("Lap"), *[F.concat(F.lit("by "), F.col("user_id").cast("string")).alias("Notes")] * whole)
    return acts.select("user_id", "date", "part",
                       F.to_xml(body, {"rowTag": "Activity", "attributePrefix": "_"}).alias("document"))


# --- document files: one per (day, part), named ``yyyy-MM-dd_part.ext``

def file_stem(date: str = "date", part: str = "part") -> Column:
    return F.concat(F.col(date), F.lit("_"), F.col(part).cast("string"))


def file_number(date: str = "date", part: str = "part") -> Column:
    """0 to 6: what a file is broken by (0 cut off, 1 a value of another type, 2 no document, others whole)."""
    return F.pmod(F.col(part) * 31 + F.dayofmonth(F.col(date).cast("date")), F.lit(7))


def _broken(document: Column, wrong_type: Column, keep_chars: Column, nothing: str) -> Column:
    number = file_number()
    return (F.when(number == 0, F.substring(document, F.lit(1), keep_chars))
            .when(number == 1, wrong_type).when(number == 2, F.lit(nothing)).otherwise(document))


def _parts(df: DataFrame) -> DataFrame:
    return df.withColumn("part", F.floor(F.col("event_id") / F.lit(DOC_SPAN)))


def heart_files(samples: DataFrame) -> DataFrame:
    """``file_name, document``: a day document of at most 1440 samples; the wrong type is a value as text."""
    grouped = _parts(samples).groupBy("date", "part").agg(
        F.sort_array(F.collect_list(F.struct("time", "event_id", F.col("value").cast("bigint").alias("value")))).alias("points"))
    doc = F.struct(
        F.array(F.struct(F.col("date").alias("dateTime"))).alias("activities-heart"),
        F.struct(F.transform("points", lambda p: F.struct(p["time"].alias("time"), p["value"].alias("value"))).alias("dataset"),
                 F.lit(1).alias("datasetInterval"), F.lit("minute").alias("datasetType")).alias("activities-heart-intraday"))
    text = F.concat(F.lit("[\n"), F.to_json(doc), F.lit("\n]"))
    wrong = F.regexp_replace(text, r'"value":([0-9]+)\}\]', '"value":"n/a"}]')
    return grouped.select(F.concat(file_stem(), F.lit(".json")).alias("file_name"),
                          _broken(text, wrong, F.length(text) - 20, "[]").alias("document"))


def activity_files(events: DataFrame) -> DataFrame:
    """``file_name, document``: the activity records of a (day, part); the wrong type is a duration as text."""
    rec = activity_log_records(events).withColumn("event_id", F.col("logId")).withColumn("date", F.substring("originalStartTime", 1, 10))
    body = F.struct("logId", "activityName", "originalDuration", "originalStartTime", "lastModified")
    grouped = _parts(rec).groupBy("date", "part").agg(F.sort_array(F.collect_list(body)).alias("records"))
    text = F.to_json("records")
    wrong = F.regexp_replace(text, r'"originalDuration":([0-9]+)', '"originalDuration":"long"')
    return grouped.select(F.concat(file_stem(), F.lit(".json")).alias("file_name"),
                          _broken(text, wrong, F.length(text) - 20, "[]").alias("document"))


def tcx_files(events: DataFrame, whole: bool = False) -> DataFrame:
    """``file_name, document``: the activities of a (day, part) as one XML file; cut-off ones end in their first
    activity, the wrong type is a tag that closes another."""
    acts = tcx_documents(events, whole).groupBy("date", "part").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("user_id", "document"))), lambda a: a["document"]), "\n")
        .alias("activities"))
    head, tail = '<?xml version="1.0"?>\n<TrainingCenterDatabase><Activities>\n', "\n</Activities></TrainingCenterDatabase>\n"
    text = F.concat(F.lit(head), F.col("activities"), F.lit(tail))
    wrong = F.concat(F.lit(head + "<Activity><Id>x</Lap></Activity>"), F.lit(tail))
    return acts.select(F.concat(file_stem(), F.lit(".tcx")).alias("file_name"),
                       _broken(text, wrong, F.lit(len(head) + 90), head + tail).alias("document"))


def sleep_documents(events: DataFrame) -> DataFrame:
    """``user_id, document``: a sleep record per ``error`` event, of which only ``startTime`` is ever read."""
    night = F.struct(F.col("event_id").alias("logId"), iso_text("ts").alias("startTime"),
                     F.floor("value").cast("bigint").alias("minutesAsleep"),
                     F.struct(F.array(F.struct(F.lit("deep").alias("level"), F.floor("value").cast("bigint").alias("seconds")))
                              .alias("data")).alias("levels"))
    return (events.filter(F.col("event_type") == "error")
            .select("user_id", F.concat(F.lit("["), F.to_json(F.struct(F.array(night).alias("sleep"))), F.lit("]")).alias("document")))


#: Device minutes: runs from this number of minutes on, and the period of their wave.
SHORTEST_RUN, WAVE = 30, 20


def device_minutes(events: DataFrame) -> DataFrame:
    """``user_id, TS, BPM``: unbroken minute runs, one per purchase of ``SHORTEST_RUN`` <= ``k`` minutes or more.

    A run has ``k`` minutes from the cut stamp; its BPM is a level, a triangular wave of ``WAVE`` minutes and a
    small number from a product of the ids.  Runs of one person that overlap give the largest value of a minute.
    """
    k = F.get_json_object("props", "$.k").try_cast("int")
    start = F.expr("make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0)")
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    # minutes are whole numbers until they are one per person: a stamp is made once, of the rows that are left
    runs = (events.filter(F.col("event_type") == "purchase").withColumn("_k", k).filter(F.col("_k") >= SHORTEST_RUN)
            .select("user_id", "event_id", (60 + F.pmod(F.floor("value"), F.lit(30))).alias("_level"),
                    F.timestamp_diff("MINUTE", epoch, start).alias("_m0"), F.sequence(F.lit(0), F.col("_k") - 1).alias("_os"))
            .select("user_id", "event_id", "_level", "_m0", F.explode("_os").alias("_o")))
    wave = F.abs(F.pmod(F.col("_o") + F.col("event_id"), F.lit(WAVE)) - WAVE // 2) * 4
    noise = F.pmod((F.col("event_id") + 1) * (F.col("_o") + 7) * 48271, F.lit(5))
    return (runs.select("user_id", (F.col("_m0") + F.col("_o")).alias("_m"), (F.col("_level") + wave + noise).cast("int").alias("BPM"))
            .groupBy("user_id", "_m").agg(F.max("BPM").alias("BPM"))
            .select("user_id", F.timestamp_add("MINUTE", F.col("_m"), epoch).alias("TS"), "BPM"))
