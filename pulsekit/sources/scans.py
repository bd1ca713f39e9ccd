"""Scans of landed files that lose nothing: documents that parse, and a quarantine of those that do not.

Readers run in permissive mode with a corrupt-record column.  What a scan returns is written once, split by
a ``rejected`` folder, so neither side parses the files again; a report counts both per file.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.session import scratch_path
from pulsekit.sources import schemas as S

CORRUPT = "_corrupt_record"


class Scan(NamedTuple):
    """``rows``: the schema's columns and file_name.  ``rejects``: file_name, document (the text as read)."""

    rows: DataFrame
    rejects: DataFrame


def _split(parsed: DataFrame) -> Scan:
    spark, path = parsed.sparkSession, scratch_path(parsed.sparkSession, "scan")
    marked = parsed.withColumn("rejected", F.col(CORRUPT).isNotNull())
    marked.write.partitionBy("rejected").parquet(path)
    back = spark.read.schema(marked.schema).parquet(path)
    rows = back.filter("not rejected").drop(CORRUPT, "rejected")
    rejects = back.filter("rejected").select("file_name", F.col(CORRUPT).alias("document"))
    return Scan(rows, rejects)


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def scan_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> Scan:
    """Multi-line JSON files, each a top-level array of documents.

    A document that is no JSON, or holds a value of another type than the schema's, is a reject as a whole,
    never half a row.  Fields outside the schema are no fault.
    """
    parsed = (spark.read.schema(_with_corrupt(schema)).option("multiLine", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return _split(parsed.withColumn("file_name", F.col("_metadata.file_name")))


def scan_tcx(spark: SparkSession, path: str) -> Scan:
    """TCX files, a row per ``Activity`` element; an element that is cut off or malformed is a reject."""
    parsed = (spark.read.format("xml").option("rowTag", "Activity").option("attributePrefix", "_")
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .schema(_with_corrupt(S.TCX_ACTIVITY)).load(path))
    return _split(parsed.withColumn("file_name", F.col("_metadata.file_name")))


def scan_tcx_whole(spark: SparkSession, path: str) -> Scan:
    """TCX files with every ``Activity`` as one schema-free value ``document``; nothing is left out.

    An element that is cut off or malformed has no value and is a reject without text.
    """
    parsed = (spark.read.format("xml").option("rowTag", "Activity").option("attributePrefix", "_")
              .option("singleVariantColumn", "document").load(path)
              .select("document", F.col("_metadata.file_name").alias("file_name")))
    return Scan(parsed.filter("document is not null"),
                parsed.filter("document is null").select("file_name", F.lit(None).cast("string").alias("document")))


def file_report(spark: SparkSession, path: str, scan: Scan) -> DataFrame:
    """file_name, n_documents, n_rejected, status for every file below ``path`` (not those of no bytes, which
    Spark's readers skip): ``ok``, ``rejected`` (with any reject) or ``no document``.

    The listing reads file names alone, not contents.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file_name"))
    good = scan.rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_documents"))
    bad = scan.rejects.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rejected"))
    n, r = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_documents", "n_rejected"))
    status = F.when(r > 0, "rejected").when(n > 0, "ok").otherwise("no document")
    return (files.join(good, "file_name", "left").join(bad, "file_name", "left")
            .select("file_name", n.alias("n_documents"), r.alias("n_rejected"), status.alias("status")))
