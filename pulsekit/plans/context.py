"""Shared derivations for the registered queries (one place, lazily built)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions import ts_from_day_hour
from pulsekit.operators import label as L
from pulsekit.operators import stats as ST
from pulsekit.plans import standins as SI
from pulsekit.sources import schemas as S
from pulsekit.sources.readers import parse_json_array

USER = ("user_id",)


class Inputs:
    """Stand-in inputs of one scale-factor folder.  Every property is a lazy
    DataFrame; nothing is computed until an action runs.

    ``days`` (first, last; both inclusive, ``yyyy-MM-dd``) reads only these
    days: the range is on the stored stamp, so it prunes the scan.  Samples and
    wrapped activity minutes carry the day of their own event's stamp, hence
    both sides of a labelling join are cut exactly."""

    def __init__(self, spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None):
        self.spark, self.sf_dir, self.days = spark, sf_dir, days

    @cached_property
    def events(self) -> DataFrame:
        events = SI.table(self.spark, self.sf_dir, "events")
        if self.days is None:
            return events
        first, last = (F.lit(d).cast("date") for d in self.days)
        return events.filter((F.col("ts") >= first.cast("timestamp_ntz"))
                             & (F.col("ts") < F.date_add(last, 1).cast("timestamp_ntz")))

    @cached_property
    def samples(self) -> DataFrame:
        return SI.samples_from_events(self.events)

    @cached_property
    def activity_log(self) -> DataFrame:
        """Activity-log records parsed back from their JSON documents."""
        docs = SI.activity_log_documents(self.events)
        return (docs.select("user_id", F.explode(parse_json_array("document", S.ACTIVITY_LOG)).alias("r"))
                .select("user_id", "r.*"))

    @cached_property
    def activity_records(self) -> DataFrame:
        """The activity log as landed typed rows (Parquet between steps): the
        labelling chain reads these, not the JSON text again."""
        return SI.activity_log_records(self.events)

    @cached_property
    def intervals(self) -> DataFrame:
        return L.activity_intervals(self.activity_records, keep=USER)

    def minutes(self, midnight: str = "wrap") -> DataFrame:
        return L.activity_minutes(self.intervals, keep=USER, midnight=midnight)

    @cached_property
    def labelled(self) -> DataFrame:
        return L.label_last_wins(self.samples, self.intervals, keys=USER)

    @cached_property
    def hourly_sport(self) -> DataFrame:
        return ST.hourly_stats(self.labelled, label="sport")

    @cached_property
    def daily_sport(self) -> DataFrame:
        return ST.daily_stats(self.labelled, label="sport")

    @cached_property
    def device_minutes(self) -> DataFrame:
        """The device's own grain: ``user_id, TS, BPM``, runs of unbroken minutes per person."""
        return SI.device_minutes(self.events)

    @cached_property
    def device_labelled(self) -> DataFrame:
        """Device minutes with the activity under way: ``user_id, TS, BPM, sport``."""
        return L.label_last_wins(self.device_minutes, self.intervals, keys=USER, stamp="TS")

    def hourly_series(self, labelled: bool = False) -> DataFrame:
        """One row per hour of the whole data: TS, BPM (= hourly max)[, sport]."""
        hourly = self.hourly_sport if labelled else ST.hourly_stats(self.samples)
        cols = [ts_from_day_hour("date", "HOUR").alias("TS"), F.col("max_value").alias("BPM")]
        if labelled:
            cols.append("sport")
        return hourly.select(*cols)
