"""Files that do not parse are kept apart and counted; whole documents keep every field."""

import json
import os

from pyspark.sql import functions as F

from pulsekit.operators import tracks as TR
from pulsekit.sources import schemas as S
from pulsekit.sources.landing import land_files
from pulsekit.sources.scans import file_report, scan_json_documents, scan_tcx, scan_tcx_whole

GOOD = '[{"activities-heart":[{"dateTime":"2024-01-15"}],"activities-heart-intraday":{"dataset":[{"time":"00:00:00","value":5}],"more":1}}]'


def _write(folder, files):
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)


def test_json_rejects_are_whole_documents(spark, tmp_dir):
    _write(tmp_dir, {"a.json": GOOD, "b.json": GOOD[:-30], "c.json": GOOD.replace(":5}", ':"n/a"}'), "d.json": "[]",
                     "e.json": "", "f.json": GOOD[:-1] + "," + GOOD[1:]})
    scan = scan_json_documents(spark, tmp_dir, S.DAY_DOCUMENT)
    assert scan.rows.columns == [*S.DAY_DOCUMENT.names, "file_name"]
    assert sorted(r.file_name for r in scan.rows.collect()) == ["a.json", "f.json", "f.json"]
    assert {r.file_name: r.document for r in scan.rejects.collect()} == {
        "b.json": GOOD[:-30], "c.json": GOOD.replace(":5}", ':"n/a"}')}
    report = {r.file_name: tuple(r)[1:] for r in file_report(spark, tmp_dir, scan).collect()}
    assert report == {"a.json": (1, 0, "ok"), "b.json": (0, 1, "rejected"), "c.json": (0, 1, "rejected"),
                      "d.json": (0, 0, "no document"), "f.json": (2, 0, "ok")}


def test_xml_rejects(spark, tmp_dir):
    act = '<Activity Sport="Running"><Id>{}</Id></Activity>'
    _write(tmp_dir, {"a.tcx": f"<T><A>{act.format(1)}{act.format(2)}</A></T>", "b.tcx": "<T><A>" + act.format(3)[:-9],
                     "c.tcx": "<T><A></A></T>"})
    scan = scan_tcx(spark, tmp_dir)
    assert sorted(r.Id for r in scan.rows.collect()) == ["1", "2"]
    assert [r.file_name for r in scan.rejects.collect()] == ["b.tcx"]
    assert {r.file_name: r.status for r in file_report(spark, tmp_dir, scan).collect()} == {
        "a.tcx": "ok", "b.tcx": "rejected", "c.tcx": "no document"}


def test_landed_files_have_their_names_and_are_replaced(spark, tmp_dir):
    path = os.path.join(tmp_dir, "landed")
    df = spark.createDataFrame([("2024-01-15_1.json", "a\nb"), ("x y%2.json", None)], "n string, t string")
    land_files(df, path, "n", "t")
    land_files(df.filter("n like '2024%'").withColumn("t", F.lit("new")), path, "n", "t")
    found = sorted(f for f in os.listdir(path) if not f.startswith((".", "_")))
    assert found == ["2024-01-15_1.json", "x y%2.json"]
    assert open(os.path.join(path, found[0])).read() == "new\n" and open(os.path.join(path, found[1])).read() == "\n"


POINT = {"Time": "t0", "Position": {"LatitudeDegrees": 1.5, "LongitudeDegrees": 2}, "HeartRateBpm": {"Value": 99, "q": 1},
         "Cadence": 7, "Extensions": {"TPX": {"Speed": [1, 2]}}}
LIFTED = {"Time": "t0", "LatitudeDegrees": 1.5, "LongitudeDegrees": 2, "HeartRateBPM": 99, "Cadence": 7,
          "Extensions": {"TPX": {"Speed": [1, 2]}}}


def _whole(spark, documents):
    df = spark.createDataFrame([(json.dumps(d),) for d in documents], "t string")
    out = TR.reshape_whole_documents(df.select(F.parse_json("t").alias("document")))
    return [json.loads(r.j) if r.j else None for r in out.select(F.to_json("document").alias("j")).collect()]


def test_whole_documents_keep_all_but_the_wrappers(spark):
    bare = {"Time": "t1", "Cadence": None}
    cases = [({"_Sport": "x", "Lap": {"Calories": 3, "Track": {"Trackpoint": POINT}}, "Creator": {"Name": ["n"]}},
              {"_Sport": "x", "Lap": {"Calories": 3, "Track": {"Trackpoint": LIFTED}}, "Creator": {"Name": ["n"]}}),
             ({"Lap": [{"Track": [{"Trackpoint": [POINT, bare]}, {"Trackpoint": bare}]}, {"Calories": 1}] * 7},
              {"Lap": [{"Track": [{"Trackpoint": [LIFTED, bare]}, {"Trackpoint": bare}]}, {"Calories": 1}] * 7}),
             ({"Id": "no laps"}, {"Id": "no laps"}), ({"Lap": "text"}, {"Lap": "text"}), ([1], [1]), ("s", "s"),
             ({"Lap": {"Track": {"Trackpoint": {**POINT, "LatitudeDegrees": 0}}}}, {"Lap": {"Track": {"Trackpoint": LIFTED}}})]
    assert _whole(spark, [c for c, _ in cases]) == [w for _, w in cases]


def test_whole_scan_keeps_unlisted_fields(spark, tmp_dir):
    _write(tmp_dir, {"a.tcx": '<T><Activity Sport="R"><Id>1</Id><Any><Thing k="v">2</Thing></Any></Activity></T>',
                     "b.tcx": "<T><Activity><Id>1</"})
    scan = scan_tcx_whole(spark, tmp_dir)
    got = [json.loads(r.j) for r in scan.rows.select(F.to_json("document").alias("j")).collect()]
    assert got == [{"Id": 1, "_Sport": "R", "Any": {"Thing": {"_VALUE": 2, "_k": "v"}}}]
    assert [r.file_name for r in scan.rejects.collect()] == ["b.tcx"]
