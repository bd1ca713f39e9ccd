"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.session import scratch_path

#: White space of the contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: later stages, and tasks of lost executors, restart from
    the files instead of from the first scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 1 << 20) -> Iterator[None]:
    """Jobs started inside move rows to and from Python in Arrow batches of about ``size`` bytes.

    By default a batch holds 10,000 rows, all texts of a task: the executor has them as Arrow buffers, the
    worker as buffers, strings and arrays, and neither gives the memory back.  Rows and results are the same.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def per_process(key: tuple, make):
    """``make()`` once per Python worker process and key: what a task learnt serves the next one.

    The store hangs on ``sys`` because functions that travel with their closures have no module state.
    """
    store = sys.__dict__.setdefault("_pulsekit_llm", {})
    if key not in store:
        store[key] = make()
    return store[key]


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value`` once.

    A column used inside a lambda is evaluated again for every element; a
    lambda's own variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def count_chars(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are in the character class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
