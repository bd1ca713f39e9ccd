"""Registered queries over landed files: day documents, activity logs and tracks, with what was rejected."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.operators import label as L
from pulsekit.operators import samples as SM
from pulsekit.operators import tracks as TR
from pulsekit.plans import standins as SI
from pulsekit.plans.context import Inputs
from pulsekit.plans.queries import query
from pulsekit.session import scratch_path
from pulsekit.sources import schemas as S
from pulsekit.sources.landing import land_files
from pulsekit.sources.readers import day_from_file_name
from pulsekit.sources.scans import file_report, scan_json_documents, scan_tcx, scan_tcx_whole


def _landed(spark, documents, name):
    path = scratch_path(spark, name)
    land_files(documents, path, "file_name", "document")
    return path


def _heart(spark, sf_dir):
    path = _landed(spark, SI.heart_files(Inputs(spark, sf_dir).samples), "heart-files")
    return path, scan_json_documents(spark, path, S.DAY_DOCUMENT)


def _activities(spark, sf_dir):
    path = _landed(spark, SI.activity_files(Inputs(spark, sf_dir).events), "activity-files")
    return path, scan_json_documents(spark, path, S.ACTIVITY_LOG)


def _tracks(spark, sf_dir):
    path = _landed(spark, SI.tcx_files(Inputs(spark, sf_dir).events), "tcx-files")
    return path, scan_tcx(spark, path)


@query
def heart_file_scan(spark, sf_dir):
    """Day documents landed as files, scanned with the explicit schema; the day of the file's name beside the
    document's own.  Broken documents are in the quarantine, see ``file_rejects``."""
    flat = SM.flatten_day_documents(_heart(spark, sf_dir)[1].rows, keep=["file_name"])
    return flat.withColumn("file_day", day_from_file_name("file_name"))


@query
def activity_file_scan(spark, sf_dir):
    """Activity logs landed as files -> intervals, with the file they come from."""
    return L.activity_intervals(_activities(spark, sf_dir)[1].rows, keep=["file_name"])


@query
def tcx_file_scan(spark, sf_dir):
    """XML track files (``rowTag`` Activity) -> trackpoints; the day from the file's name."""
    flat = TR.flatten_trackpoints(_tracks(spark, sf_dir)[1].rows, keep=["file_name", "Id"])
    return flat.withColumn("file_day", day_from_file_name("file_name"))


@query
def file_rejects(spark, sf_dir):
    """Per landed file: documents kept, documents in quarantine, status."""
    reports = [file_report(spark, *scan).withColumn("source", F.lit(source))
               for source, scan in (("heart", _heart(spark, sf_dir)), ("activity", _activities(spark, sf_dir)),
                                    ("track", _tracks(spark, sf_dir)))]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def whole_documents_by_sport(spark, sf_dir):
    """Track files as schema-free values: position and heart rate are lifted, every other field stays, also
    those that no schema lists.  Written as JSON documents in a folder per sport and read back."""
    path = _landed(spark, SI.tcx_files(Inputs(spark, sf_dir).events, whole=True), "tcx-whole")
    acts = TR.reshape_whole_documents(scan_tcx_whole(spark, path).rows)
    out = scratch_path(spark, "whole-json")
    (acts.select(F.try_variant_get("document", "$._Sport", "string").alias("sport"), F.to_json("document").alias("value"))
     .write.partitionBy("sport").text(out))
    back = (spark.read.schema("value string, sport string").text(out)
            .select("sport", F.try_parse_json("value").alias("document")))

    def field(v, path, kind):
        return F.try_variant_get(v, path, kind).alias(path.rpartition(".")[2])

    points = TR.flatten_whole_documents(
        back.select("sport", field("document", "$.Id", "string"), field("document", "$.Notes", "string"), "document"),
        keep=["sport", "Id", "Notes"])
    return points.select("sport", "Id", "Notes", "lap", field("lap_document", "$.Calories", "int"),
                         field("point", "$.Time", "string"), field("point", "$.LatitudeDegrees", "double"),
                         field("point", "$.LongitudeDegrees", "double"), field("point", "$.HeartRateBPM", "int"),
                         field("point", "$.Cadence", "int"), field("point", "$.Extensions.TPX.Speed", "double"),
                         F.try_variant_get("point", "$.Position", "variant").isNull().alias("lifted"))
