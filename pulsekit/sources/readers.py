"""Readers: files with explicit schemas, and the same parsers over text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.sources import schemas as S


def read_day_documents(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    """Multi-line JSON day documents (top-level one-element arrays; a glob or
    folder).  ``file_name`` from the hidden ``_metadata`` column."""
    df = spark.read.schema(S.DAY_DOCUMENT).option("multiLine", True).json(path)
    return df.withColumn("file_name", F.col("_metadata.file_name")) if with_file else df


def read_activity_log(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    df = spark.read.schema(S.ACTIVITY_LOG).option("multiLine", True).json(path)
    return df.withColumn("file_name", F.col("_metadata.file_name")) if with_file else df


def read_tcx(spark: SparkSession, path: str, with_file: bool = True) -> DataFrame:
    """TCX files: one row per ``Activity`` element, ``Sport`` attribute as ``_Sport``."""
    df = (spark.read.format("xml").option("rowTag", "Activity")
          .option("attributePrefix", "_").schema(S.TCX_ACTIVITY).load(path))
    return df.withColumn("file_name", F.col("_metadata.file_name")) if with_file else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, sep: str = ",", infer: bool = False) -> DataFrame:
    """Hand-over CSV.  Prefer ``schema``; ``infer`` costs an extra pass."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def parse_json_array(text: Column | str, element: T.StructType) -> Column:
    """Text of a top-level JSON array -> array<element>; explode it afterwards."""
    return F.from_json(text, T.ArrayType(element))


def parse_tcx(text: Column | str) -> Column:
    """Text of one ``<Activity>`` element -> struct (same schema as ``read_tcx``)."""
    return F.from_xml(text, S.TCX_ACTIVITY, {"attributePrefix": "_"})


def day_from_file_name(name: Column | str) -> Column:
    """``2021-08-01.json`` (or any path ending so) -> ``2021-08-01``."""
    col = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(col, r"(\d{4}-\d{2}-\d{2})[^/]*$", 1)
