"""File-source stream: a rerun after new files land reads only those."""

import json
import os

from pulsekit.streaming.ingest import SINK_SCHEMA, ingest_day_documents


def _line(user, day, points):
    doc = [{"activities-heart": [{"dateTime": day}],
            "activities-heart-intraday": {"dataset": [{"time": t, "value": v} for t, v in points]}}]
    return json.dumps({"user_id": user, "document": doc})


def test_available_now_picks_up_only_new_files(spark, tmp_dir):
    landing, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "sink", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as f:
        f.write(_line(1, "2023-02-11", [("10:00:00", 60), ("10:01:00", 61)]) + "\n")
        f.write(_line(2, "2023-02-11", [("11:00:00", 70)]) + "\n")
    ingest_day_documents(spark, landing, sink, ckpt)
    assert spark.read.schema(SINK_SCHEMA).parquet(sink).count() == 3
    with open(os.path.join(landing, "b.json"), "w") as f:
        f.write(_line(1, "2023-02-12", [("00:00:00", 50)]) + "\n")
    ingest_day_documents(spark, landing, sink, ckpt)
    out = spark.read.schema(SINK_SCHEMA).parquet(sink)
    assert out.count() == 4
    assert sorted(r.file_name for r in out.select("file_name").distinct().collect()) == ["a.json", "b.json"]
