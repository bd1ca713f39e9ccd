"""Rollups: min / mean / max (+ label, + exact median) by day and by hour.

All are hash aggregates with a map-side partial step.  The exact median
(``median`` = ``percentile(x, 0.5)``) keeps a value -> count map per group, so
its state is bounded by the number of distinct values (whole BPM), not by the
size of the group, and it merges across partitions.  ``percentile_approx`` is
not equal to it (2 instead of 3.5 on {1, 2, 5, 8}).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.session import scratch_path


def value_stats(df: DataFrame, by: Sequence[str], value: str = "value",
                label: str | None = None, median: bool = False) -> DataFrame:
    aggs = [F.min(value).alias("min_value"),
            F.avg(value).alias("avg_value"),
            F.max(value).alias("max_value")]
    if median:
        aggs.append(F.median(value).alias("median_value"))
    if label:
        # string max is bytewise: "0" sorts before any name, so a labelled
        # minute wins and the last name in byte order wins among labels
        aggs.append(F.max(label).alias(label))
    return df.groupBy(*by).agg(*aggs)


def daily_stats(samples: DataFrame, keys: Sequence[str] = (), label: str | None = None) -> DataFrame:
    return value_stats(samples, [*keys, "date"], label=label)


def hourly_stats(samples: DataFrame, keys: Sequence[str] = (), label: str | None = None) -> DataFrame:
    return value_stats(samples, [*keys, "date", "HOUR"], label=label)


def daily_median(samples: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return value_stats(samples, [*keys, "date"], median=True)


def hourly_median(samples: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return value_stats(samples, [*keys, "date", "HOUR"], median=True)


def value_runs(samples: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """The sorted multiset of values per group, as ``v:n`` runs (``62:2,70:1``).

    The list is built from (group, value) counts, so its length is bounded by
    the number of distinct values, however many samples a group holds.
    """
    counts = samples.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    runs = F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").alias("n"))))
    return (counts.groupBy(*by)
            .agg(runs.alias("_runs"), F.sum("_n").cast("bigint").alias("n_values"))
            .select(*by, F.array_join(
                F.transform("_runs", lambda r: F.concat(r["v"].cast("string"), F.lit(":"),
                                                        r["n"].cast("string"))),
                ",").alias("value_runs"), "n_values"))


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``c, v``: the values of ``columns`` as doubles, one row each, with the column's position; nulls are left out."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    return df.select(F.posexplode(values).alias("c", "v")).filter(F.col("v").isNotNull())


def _named(by_position: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per column, also for those without values."""
    names = by_position.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column string")
    return names.join(by_position, "c", "left").drop("c")


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, count, mean, std (population) of every column, aggregated by column with a map-side step."""
    moments = long_values(df, columns).groupBy("c").agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                                        F.stddev_pop("v").alias("std"))
    return _named(moments, columns).withColumn("count", F.coalesce("count", F.lit(0)))


def ranged_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``c, v, n, part``: how often each value occurs in each column, in parts that are ranges of (c, v).

    Written once, so that part numbers hold for all that is read from it."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = (long_values(df, columns).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
              .repartitionByRange(parts, "c", "v").withColumn("part", F.spark_partition_id()))
    path = scratch_path(spark, "value-counts")
    counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def _ranked(counts: DataFrame, blocks: DataFrame) -> DataFrame:
    """``c, r, v``: the value at each wanted rank (from 0) of a column, from the parts that hold one.

    ``blocks`` has c, part, the rows of the column before the part, and the ranks that fall into it; they
    are at most as many as wanted ranks, hence broadcast.  A running sum goes over one part of one column."""
    inside = Window.partitionBy("c", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    met = (counts.join(F.broadcast(blocks), ["c", "part"])
           .withColumn("_end", F.col("before") + F.sum("n").over(inside)))
    return (met.select("c", "v", "n", "_end", F.explode("ranks").alias("r"))
            .filter((F.col("r") < F.col("_end")) & (F.col("r") >= F.col("_end") - F.col("n"))).select("c", "r", "v"))


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, exact 25/50/75 % and max per column, nulls left out.

    Exact quantiles without a task that holds a column: (column, value) counts are dealt to ranges, the sizes
    of the ranges give the rows before each of them, and only the ranges that hold a wanted rank are summed
    up value by value.  Quartiles interpolate linearly as the usual ``describe`` does; the spread is taken
    around the mean in a second pass.  No values give a count of 0 and nulls, one value a null std.
    """
    counts = ranged_counts(df, columns)
    sizes = counts.groupBy("c", "part").agg(F.sum("n").alias("k"), F.sum(F.col("v") * F.col("n")).alias("s"),
                                            F.min("v").alias("lo"), F.max("v").alias("hi"))
    column = Window.partitionBy("c")  # at most one row a part
    placed = (sizes.withColumn("before", F.coalesce(F.sum("k").over(column.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("k").over(column)))
    at = {name: q * (F.col("total") - 1) for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    ranks = F.array_distinct(F.array(*[f(h).cast("long") for h in at.values() for f in (F.floor, F.ceil)]))
    blocks = (placed.withColumn("ranks", F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("k"))))
              .filter(F.size("ranks") > 0).select("c", "part", "before", "ranks"))
    ranked = _ranked(counts, blocks).groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("r", "v"))).alias("at"))
    totals = sizes.groupBy("c").agg(F.sum("k").alias("total"), F.sum("s").alias("s"), F.min("lo").alias("min"), F.max("hi").alias("max"))
    totals = totals.withColumn("mean", F.col("s") / F.col("total"))
    spread = (counts.join(F.broadcast(totals.select("c", "mean")), "c")  # one row a column
              .groupBy("c").agg(F.sum(F.col("n") * F.pow(F.col("v") - F.col("mean"), 2)).alias("ss")))

    def interpolated(h: Column) -> Column:
        low, high = (F.col("at")[f(h).cast("long")] for f in (F.floor, F.ceil))
        return low + (high - low) * (h - F.floor(h))

    described = totals.join(spread, "c").join(ranked, "c").select(
        "c", F.col("total").alias("count"), "mean",
        F.when(F.col("total") > 1, F.sqrt(F.col("ss") / (F.col("total") - 1))).alias("std"), "min",
        *[interpolated(h).alias(name) for name, h in at.items()], "max")
    return _named(described, columns).withColumn("count", F.coalesce("count", F.lit(0)))


def mean_absolute_error(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.avg(F.abs(F.col(truth) - F.col(predicted))).alias("mae"))


def count_by(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
