"""Chart-ready series: the data part of the daily / hourly / one-day plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions import sport_marker, ts_from_day_hour


def _typed(stats: DataFrame) -> DataFrame:
    return (stats.withColumn("min_value", F.col("min_value").cast("int"))
            .withColumn("max_value", F.col("max_value").cast("int"))
            .withColumn("avg_value", F.col("avg_value").cast("double")))


def daily_series(daily: DataFrame, with_marker: bool = True) -> DataFrame:
    """date (DATE), min, avg, max[, marker 200/0], ordered by date."""
    cols = [F.try_to_date("date", "yyyy-MM-dd").alias("date"), "min_value", "avg_value", "max_value"]
    if with_marker:
        cols.append(sport_marker("sport").alias("sport_marker"))
    return _typed(daily).select(*cols).orderBy("date")


def hourly_series(hourly: DataFrame, with_marker: bool = True) -> DataFrame:
    """TS = day + hour as TIMESTAMP_NTZ, min, avg, max[, marker], ordered by TS."""
    cols = [ts_from_day_hour("date", "HOUR").alias("TS"), "min_value", "avg_value", "max_value"]
    if with_marker:
        cols.append(sport_marker("sport").alias("sport_marker"))
    return _typed(hourly).select(*cols).orderBy("TS")


def day_profile(hourly: DataFrame, day: str) -> DataFrame:
    """The hourly rows of one day, ordered by hour; an empty frame when the
    day has no data (the caller decides whether to ask again)."""
    return (_typed(hourly).filter(F.col("date") == F.lit(day))
            .select("date", "HOUR", ts_from_day_hour("date", "HOUR").alias("TS"),
                    "min_value", "avg_value", "max_value", sport_marker("sport").alias("sport_marker"))
            .orderBy("HOUR"))
