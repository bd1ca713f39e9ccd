"""TCX documents (FIXTURES §4.10)."""

import os

from pulsekit.operators import tracks as TR
from pulsekit.sources.readers import read_tcx

TP = "<Trackpoint><Time>{t}</Time>{pos}{hr}</Trackpoint>"
POS = "<Position><LatitudeDegrees>{a}</LatitudeDegrees><LongitudeDegrees>{b}</LongitudeDegrees></Position>"
HR = "<HeartRateBpm><Value>{v}</Value></HeartRateBpm>"


def _doc(sport, laps):
    body = "".join(f'<Lap StartTime="L{i}">' + "".join(
        "<Track>" + "".join(tracks) + "</Track>" for tracks in lap) + "</Lap>" for i, lap in enumerate(laps))
    return ('<?xml version="1.0"?><TrainingCenterDatabase><Activities>'
            f'<Activity Sport="{sport}"><Id>x</Id>{body}</Activity></Activities></TrainingCenterDatabase>')


def test_read_and_flatten_laps_tracks_points(spark, tmp_dir):
    one_point = [[TP.format(t="t0", pos=POS.format(a=1.5, b=2.5), hr=HR.format(v=99))]]
    seven = [[[TP.format(t=f"s{i}", pos="", hr=HR.format(v=100 + i))]] for i in range(7)]
    multi_track = [[TP.format(t="m0", pos="", hr=""), TP.format(t="m1", pos="", hr=HR.format(v=1))],
                   [TP.format(t="m2", pos=POS.format(a=3.0, b=4.0), hr="")]]
    files = {"a.tcx": _doc("Running", [one_point]), "b.tcx": _doc("Biking", [l[0] for l in seven]),
             "c.tcx": _doc("Other", [multi_track])}
    # b: seven laps of one track each
    files["b.tcx"] = _doc("Biking", [[[TP.format(t=f"s{i}", pos="", hr=HR.format(v=100 + i))]] for i in range(7)])
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    acts = read_tcx(spark, tmp_dir)
    flat = TR.flatten_trackpoints(acts, keep=["file_name"])
    rows = {r.Time: r for r in flat.collect()}
    assert len(rows) == 1 + 7 + 3
    assert (rows["t0"].LatitudeDegrees, rows["t0"].LongitudeDegrees, rows["t0"].HeartRateBPM) == (1.5, 2.5, 99)
    assert rows["s6"].lap == 6 and rows["s6"].sport == "Biking"
    assert rows["m0"].HeartRateBPM is None and rows["m2"].LatitudeDegrees == 3.0
    reshaped = TR.reshape_trackpoints(acts).select("Lap").collect()
    point = reshaped[0].Lap[0].Track[0].Trackpoint[0]
    assert "HeartRateBPM" in point.asDict() and "Position" not in point.asDict()
