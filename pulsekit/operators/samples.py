"""Day documents -> minute samples (``time, value, date, HOUR``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions import hour_of


def flatten_day_documents(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per minute sample of each day document.

    The day is the ``dateTime`` of the first ``activities-heart`` entry; the
    samples come from ``activities-heart-intraday.dataset``.  ``explode``
    drops documents whose series is empty or null, so empty days vanish
    without a special case.  ``keep`` columns (e.g. a user key or the file
    name) are carried through.
    """
    heart = F.col("`activities-heart`")
    intraday = F.col("`activities-heart-intraday`")
    return (docs
            .select(*keep,
                    heart.getField("dateTime").getItem(0).alias("date"),
                    F.explode(intraday.getField("dataset")).alias("vals"))
            .select(*keep,
                    F.col("vals.time").alias("time"),
                    F.col("vals.value").cast("int").alias("value"),
                    "date")
            .withColumn("HOUR", hour_of("time")))


def typed_samples(text_samples: DataFrame) -> DataFrame:
    """Text samples (as read from a hand-over CSV) -> typed; bad numbers -> null."""
    return text_samples.withColumn("value", F.col("value").try_cast("int"))
