"""Incremental selection: what is new since the last landing, newest version
per key, the n most recent, day ranges.  All set-based, no listing loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions import stamp_digits, strip_extension


def newer_than_high_water_mark(records: DataFrame, stamp_col: str, landed: DataFrame,
                               landed_stamp_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Records whose stamp is strictly greater than the newest landed stamp
    (equal is not new).  Stamps compare as their 14 digits, so ISO stamps and
    landing keys mix.  Per ``keys`` (e.g. a user) the high-water marks are a
    small aggregate joined back; without keys the mark is a scalar subquery
    (a single value, no join).  Keys without any landed record: all new."""
    digits = stamp_digits(stamp_col)
    if not keys:
        # one reference to the subquery; no landed file -> -1 -> all new
        hwm = landed.agg(F.max(stamp_digits(landed_stamp_col))).scalar()
        return records.filter(digits > F.coalesce(hwm, F.lit(-1).cast("bigint")))
    marks = landed.groupBy(*keys).agg(F.max(stamp_digits(landed_stamp_col)).alias("_hwm"))
    return (records.join(marks, on=list(keys), how="left")
            .filter(F.col("_hwm").isNull() | (digits > F.col("_hwm")))
            .drop("_hwm"))


def new_files(candidates: DataFrame, converted: DataFrame, name_col: str = "file_name",
              converted_col: str = "file_name") -> DataFrame:
    """Candidate files whose stem has no converted counterpart (left anti join)."""
    done = converted.select(strip_extension(converted_col).alias("_stem"))
    return (candidates.withColumn("_stem", strip_extension(name_col))
            .join(done, on="_stem", how="left_anti").drop("_stem"))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key by ``order`` (which must make rows unique).

    ``max_by`` is combined map-side: a hot key costs one running maximum per
    partition, never a sort of all its versions in one task."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_n_before(df: DataFrame, ts_col: str, cutoff: str | Column, n: int,
                    tie_col: str) -> DataFrame:
    """The ``n`` most recent rows strictly before ``cutoff``; ties broken by
    ``tie_col`` so the cut at ``n`` is deterministic (a top-k: each partition
    keeps n rows, then one merge)."""
    bound = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    return (df.filter(F.col(ts_col) < bound)
            .orderBy(F.col(ts_col).desc(), F.col(tie_col).desc()).limit(n))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's outermost partition folders, ascending: folder names, no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def days_walked_back(table: DataFrame, days: Sequence[str], ts_col: str, cutoff: str, n: int, day_col: str = "day") -> list[str]:
    """The last of ``days`` that hold ``n`` rows before ``cutoff`` together, or all of them.

    Walks back over 1, 2, 4, ... days at a time and counts their rows only, so the jobs grow with the
    logarithm of the days needed and no older day is read.
    """
    left = [d for d in sorted(days) if d <= cutoff[:10]]
    taken: list[str] = []
    found, step = 0, 1
    while left and found < n:
        part, left = left[-step:], left[:-step]
        found += table.filter(F.col(day_col).isin(part) & (F.col(ts_col) < cutoff)).count()
        taken, step = part + taken, 2 * step
    return taken


def latest_n_in_days(spark: SparkSession, path: str, schema, ts_col: str, cutoff: str, n: int, tie_col: str,
                     day_col: str = "day") -> DataFrame:
    """``latest_n_before`` over a table partitioned by the day of ``ts_col``: only the days walked back to are read."""
    table = spark.read.schema(schema).parquet(path)
    days = days_walked_back(table, partition_values(spark, path, day_col), ts_col, cutoff, n, day_col)
    return latest_n_before(table.filter(F.col(day_col).isin(days)), ts_col, cutoff, n, tie_col)


def days_in_range(df: DataFrame, day_col: str, start: str, end: str,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Distinct days (per key) between ``start`` and ``end``, both inclusive."""
    return (df.filter(F.col(day_col).between(start, end))
            .select(*keys, day_col).distinct())
