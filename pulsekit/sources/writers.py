"""Writers.  The save mode is always explicit, and no writer targets the path
it reads (rewrites go to a new path)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
              mode: str = "errorifexists") -> None:
    """Hand-over CSV at the edges (header on/off, separator ',' or ';')."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "json",
                      mode: str = "overwrite") -> None:
    """One folder per value of ``by`` (e.g. one per sport); readers filtering
    on ``by`` only list the matching folders (partition pruning)."""
    df.write.mode(mode).partitionBy(*by).format(fmt).save(path)


def upsert_days(df: DataFrame, path: str, day_col: str = "date", fmt: str = "parquet") -> None:
    """Replace exactly the days present in ``df`` and keep all others
    (dynamic partition overwrite): re-delivering the last landed day is safe."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col).format(fmt).save(path))


def land_documents(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "append") -> None:
    """Land raw text records (one JSON value per line), one folder per value
    of ``by``; ``df`` holds ``by`` plus exactly one text column.  Small folders
    get one file, a large one several of the advisory size."""
    writer = (df.hint("rebalance", *by) if by else df).write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    writer.text(path)


def compact_by_month(df: DataFrame, path: str, day_col: str = "date", mode: str = "overwrite",
                     max_records_per_file: int = 5_000_000) -> None:
    """Rewrite many small landed files as Parquet, one folder per month.

    The ``rebalance`` hint lets AQE size the write tasks: small partitions
    are coalesced to the advisory size and a hot month is split over several
    tasks (not funnelled through one, as ``repartition("month")`` would)."""
    from pyspark.sql import functions as F
    monthly = df.withColumn("month", F.substring(F.col(day_col), 1, 7))
    (monthly.hint("rebalance", "month").write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("month").parquet(path))
