"""Activity intervals and the labelling of samples with the activity under way.

Exact semantics kept from the source application:

1. minutes = floor(duration_ms / 60000); an activity of 0 minutes labels nothing.
2. the start is cut to ``HH:MM:00`` of the local wall clock; the labelled
   minutes are start, start+1, ..., start+minutes-1.
3. past midnight the clock wraps but the date stays the start date
   (``midnight="wrap"``, the default); ``midnight="carry"`` uses true minutes.
4. samples match by equal ``HH:MM:SS`` text, so a sample with seconds != 00
   never gets a label.
5. "later" activity = greater (start, activity_id).

No activity is exploded to minutes for a label.  It is cut into ranges of minutes of a day: the whole turns
of the clock, and the two ends that are left when it goes past midnight (``wrap``), or one range per day
(``carry``).  Ranges are dealt to hour buckets of (keys, day), at most 25 a turn however long the activity is,
and samples meet them in an equi-join with the range test as residual predicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions import NO_LABEL, day_number, day_of_iso, start_minute, whole_minutes

DAY_MINUTES = 1440
#: Minutes of a day's buckets in which samples meet ranges.
BUCKET_MINUTES = 60


def activity_intervals(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Activity-log records -> ``activity_id, activity, date, start, minutes``."""
    return log.select(
        *keep,
        F.col("logId").alias("activity_id"),
        F.col("activityName").alias("activity"),
        day_of_iso("originalStartTime").alias("date"),
        start_minute("originalStartTime").alias("start"),
        whole_minutes("originalDuration").alias("minutes"),
    )


def day_ranges(intervals: DataFrame, keep: Sequence[str] = (), midnight: str = "wrap") -> DataFrame:
    """Activities as minute ranges of days: ``keep..., activity_id, activity, start, date, _day, _from, _to, _times``.

    ``_day`` counts days since 1970, minutes run from 0 to 1440 and ``_to`` is exclusive.  ``wrap`` folds all
    onto the start day: whole turns of the clock as one range that counts ``_times``, then the rest up to
    midnight and the rest after it, so at most three rows an activity.  ``carry`` gives a row per day.
    Activities of 0 minutes and those without a start give none.
    """
    if midnight not in ("wrap", "carry"):
        raise ValueError("midnight must be 'wrap' or 'carry'")
    acts = intervals.filter((F.col("minutes") > 0) & F.col("start").isNotNull()).select(
        *keep, "activity_id", "activity", "start", "date", day_number("date").alias("_day0"),
        (F.hour("start") * 60 + F.minute("start")).alias("_m0"), F.col("minutes").cast("long").alias("_n"))
    if midnight == "carry":
        parts = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_m0") + F.col("_n") - 1) / DAY_MINUTES)),
                            lambda d: F.struct((F.col("_day0") + d).cast("int").alias("_day"),
                                               F.when(d == 0, F.col("_m0")).otherwise(0).cast("int").alias("_from"),
                                               F.least(F.lit(DAY_MINUTES), F.col("_m0") + F.col("_n") - d * DAY_MINUTES)
                                               .cast("int").alias("_to"), F.lit(1).alias("_times")))
    else:
        end = F.col("_m0") + F.col("_n") % DAY_MINUTES
        ranges = ((F.lit(0), F.lit(DAY_MINUTES), F.floor(F.col("_n") / DAY_MINUTES)),
                  (F.col("_m0"), F.least(F.lit(DAY_MINUTES), end), F.lit(1)), (F.lit(0), end - DAY_MINUTES, F.lit(1)))
        parts = F.filter(F.array(*[F.struct(F.col("_day0").alias("_day"), a.cast("int").alias("_from"),
                                            b.cast("int").alias("_to"), t.cast("int").alias("_times")) for a, b, t in ranges]),
                         lambda r: (r["_from"] < r["_to"]) & (r["_times"] > 0))
    return acts.select(*keep, "activity_id", "activity", "start", "date", F.inline(parts))


def _bucketed(ranges: DataFrame, size: int) -> DataFrame:
    """Ranges cut at the edges of the day's buckets, with ``_bucket``."""
    dealt = ranges.select("*", F.explode(F.sequence(F.expr(f"_from div {size}"), F.expr(f"(_to - 1) div {size}"))).alias("_b"))
    return (dealt.withColumn("_bucket", F.col("_b").cast("int"))
            .withColumn("_from", F.greatest(F.col("_from"), F.col("_bucket") * size))
            .withColumn("_to", F.least(F.col("_to"), (F.col("_bucket") + 1) * size)).drop("_b"))


def _clock_text(mod):
    return F.concat(F.lpad((mod / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((mod % 60).cast("string"), 2, "0"), F.lit(":00"))


def sample_keys(samples: DataFrame, bucket_minutes: int = BUCKET_MINUTES, stamp: str | None = None) -> DataFrame:
    """``_day`` / ``_mod`` / ``_bucket`` of each sample from its text; a time whose seconds
    are not ``00`` gets a null minute and so never matches (equal-text rule).  ``stamp`` names a
    TIMESTAMP_NTZ column in place of the texts ``date`` and ``time``."""
    if stamp:
        t = F.col(stamp)
        day, mod = F.unix_date(F.to_date(t)), F.when(F.second(t) == 0, F.hour(t) * 60 + F.minute(t))
    else:
        t = F.col("time")
        day = day_number("date")
        mod = F.when((F.length(t) == 8) & (F.substring(t, 7, 2) == "00"),
                     F.substring(t, 1, 2).try_cast("int") * 60 + F.substring(t, 4, 2).try_cast("int"))
    return (samples.withColumn("_day", day).withColumn("_mod", mod)
            .withColumn("_bucket", F.expr(f"cast(_mod div {bucket_minutes} as int)")))


def activity_minutes(intervals: DataFrame, keep: Sequence[str] = (), midnight: str = "wrap") -> DataFrame:
    """One row per labelled minute: ``keep..., activity_id, activity, start, date, time``.

    The rows are the result, so they are generated, from ranges of a day at most.  The ranges are
    rebalanced first: the tasks follow their bytes, not a fixed number.
    """
    ranges = day_ranges(intervals, keep, midnight).hint("rebalance")
    turns = ranges.select("*", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_turn"))
    mins = turns.select("*", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)).alias("_mod"))
    day = F.col("date") if midnight == "wrap" else F.date_from_unix_date("_day").cast("string")
    return mins.select(*keep, "activity_id", "activity", "start", day.alias("date"),
                       _clock_text(F.col("_mod")).alias("time"))


def _meeting(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    on = [*keys, "_day", "_bucket"]
    cond = [left[c] == right[c] for c in on] + [left["_mod"] >= right["_from"], left["_mod"] < right["_to"]]
    return left.join(right, cond, "left")


def label_fanout(samples: DataFrame, intervals: DataFrame, keys: Sequence[str] = (),
                 label: str = "sport", midnight: str = "wrap", bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Every sample, once per activity minute that covers its own (unmatched -> "0").

    Overlapping activities duplicate the sample, as a right merge of minutes with samples does; so does an
    activity that wraps over the same minute again.  Left outer equi-join on (keys, day, bucket) with the
    range as residual; AQE broadcasts the ranges only when their measured size is small, otherwise
    sort-merge, and splits skewed sample partitions.
    """
    left = sample_keys(samples, bucket_minutes)
    right = _bucketed(day_ranges(intervals, keys, midnight), bucket_minutes).select(
        *keys, "_day", "_bucket", "_from", "_to", "_times", F.col("activity").alias("_label"))
    met = _meeting(left, right, keys).select(*[left[c] for c in samples.columns], "_label", "_times")
    return (met.select("*", F.explode(F.sequence(F.lit(1), F.coalesce("_times", F.lit(1)))).alias("_turn"))
            .select(*samples.columns, F.coalesce("_label", F.lit(NO_LABEL)).alias(label)))


def winning_ranges(intervals: DataFrame, keys: Sequence[str] = (), midnight: str = "wrap",
                   bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Disjoint ranges ``keys..., _day, _bucket, _from, _to, _label`` of the activity that wins there.

    Of the activities with the same range in a bucket only the one with the greatest (start, id) is moved
    (combined map-side), which leaves at most size^2 / 2 ranges in a bucket of that size, however hot it is.
    These are cut at the starts and ends of the others, and each piece goes to the greatest that covers it.
    """
    on = [*keys, "_day", "_bucket"]
    best = F.max(F.struct("start", "activity_id", "activity")).alias("_best")
    ranges = _bucketed(day_ranges(intervals, keys, midnight), bucket_minutes).groupBy(*on, "_from", "_to").agg(best)
    whole = Window.partitionBy(*on)
    edges = F.array_sort(F.array_union(F.collect_set("_from").over(whole), F.collect_set("_to").over(whole)))
    pieces = F.expr("""filter(transform(sequence(1, size(_edges) - 1), i -> struct(_edges[i - 1] as a, _edges[i] as b)),
                              p -> p.a >= _from and p.b <= _to)""")
    cut = (ranges.withColumn("_edges", edges).select(*on, "_best", F.explode(pieces).alias("_p"))
           .select(*on, F.col("_p.a").alias("_from"), F.col("_p.b").alias("_to"), "_best"))
    return cut.groupBy(*on, "_from", "_to").agg(F.max("_best").alias("_best")).select(
        *on, "_from", "_to", F.col("_best.activity").alias("_label"))


def label_last_wins(samples: DataFrame, intervals: DataFrame, keys: Sequence[str] = (),
                    label: str = "sport", midnight: str = "wrap", bucket_minutes: int = BUCKET_MINUTES,
                    stamp: str | None = None) -> DataFrame:
    """Every sample exactly once; the later activity wins where several cover it.

    Samples meet the disjoint winning ranges of their own (keys, day, bucket), of which one matches at most;
    the ranges are already dealt by these keys, so only the samples move, and AQE may split a hot bucket.
    """
    left = sample_keys(samples, bucket_minutes, stamp)
    met = _meeting(left, winning_ranges(intervals, keys, midnight, bucket_minutes), keys)
    return met.select(*[left[c] for c in samples.columns], F.coalesce("_label", F.lit(NO_LABEL)).alias(label))


def label_range_join(samples: DataFrame, intervals: DataFrame, keys: Sequence[str],
                     label: str = "sport", bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Last-wins labelling as a range join on true minutes: an activity goes on into the next days."""
    return label_last_wins(samples, intervals, keys, label, "carry", bucket_minutes)


def activities_with_samples(intervals: DataFrame, samples: DataFrame,
                            keys: Sequence[str] = ()) -> DataFrame:
    """Activities whose day has at least one sample (left semi join)."""
    days = samples.select(*keys, "date").distinct()  # reduced map-side before it moves
    return intervals.join(days, on=[*keys, "date"], how="left_semi")
