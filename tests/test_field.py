import random
from datetime import datetime

import pytest

from sonoledger.operators import field as X


def test_places_and_times(spark):
    cases = {
        "/raw/FortSmith2022/ARU_data/SM/SRL-308/A/Data/S4A1_20220501_053000.wav":
            ("FortSmith2022", "SRL-308", datetime(2022, 5, 1, 5, 30)),
        "/raw/Gameti/ST-1/ST-1_0+1_20220501_053000.flac": ("Gameti", "ST-1", datetime(2022, 5, 1, 5, 30)),
        "/raw/Gameti/ST-1/notes.wav": ("Gameti", "ST-1", None),
        "/raw/Gameti/ST-1/x_20221399_000000.wav": ("Gameti", "ST-1", None),
        "/raw/Gameti/ST-1/x_120220501_0530001.wav": ("Gameti", "ST-1", None),
        "/else/a.wav": (None, "else", None),
        "a.wav": (None, None, None),
        None: (None, None, None),
    }
    rows = spark.createDataFrame([(p,) for p in cases], "source_path string")
    got = {r.source_path: (r.study_area, r.location, r.recording_date_time)
           for r in X.with_recording_facts(rows, "/raw/").collect()}
    assert got == cases


def detections(spark, rows):
    return spark.createDataFrame(
        rows, "recording_id string, chunk_id string, label string, absolute_time_ms long, absolute_end_ms long, confidence double")


def test_overlaps_are_merged(spark):
    rows = [
        ("r", "c1", "A", 0, 1000, 0.5), ("r", "c2", "A", 900, 1500, 0.9), ("r", "c2", "A", 1500, 1600, 0.1),
        ("r", "c3", "A", 1601, 1700, 0.3), ("r", "c1", "B", 0, 1000, 0.5), ("s", "c1", "A", 0, None, None),
        ("r", "c4", "A", 100, 5000, None), ("r", "c9", "A", None, None, 0.2), ("r", "c9", "A", None, None, 0.2),
        ("r", "c5", "A", 9000, 9100, 0.7), ("r", "c5", "A", 9000, 9100, 0.7),
    ]
    got = sorted((r.recording_id, r.label, r.absolute_time_ms or -1, r.absolute_end_ms or -1, r.confidence or 0, r.merged)
                 for r in X.merge_overlaps(detections(spark, rows)).collect())
    assert got == sorted([
        ("r", "A", 0 or -1, 5000, 0.9, 5), ("r", "B", 0 or -1, 1000, 0.5, 1), ("s", "A", 0 or -1, 0 or -1, 0, 1),
        ("r", "A", -1, -1, 0.2, 1), ("r", "A", -1, -1, 0.2, 1), ("r", "A", 9000, 9100, 0.7, 2),
    ])
    apart = X.merge_overlaps(detections(spark, rows[:1] + [("r", "c2", "A", 1400, 1500, 0.9)]), gap_ms=400)
    assert apart.count() == 1


@pytest.mark.parametrize("block_ms", [1, 50, 1000, 10**9])
def test_overlaps_do_not_depend_on_blocks(spark, block_ms):
    """One label of one recording holds a third of all rows, with runs over many blocks; against a plain loop."""

    rng = random.Random(7)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        start = rng.randrange(0, 20_000) if rng.random() > 0.05 else None
        end = None if start is None or rng.random() < 0.1 else start + rng.choice([0, 5, 40, 40, 900])
        rows.append(("hot" if hot else rng.choice(["r", None]), f"c{i}", "A" if hot else rng.choice(["A", "B", None]), start, end,
                     rng.choice([None, round(rng.random(), 3)])))
    want = []
    for key in {(r[0], r[2]) for r in rows}:
        mine = [r for r in rows if (r[0], r[2]) == key]
        want += [(*key, None, None, r[5], 1) for r in mine if r[3] is None]
        run = None
        for r in sorted((r for r in mine if r[3] is not None), key=lambda r: (r[3], max(r[3], r[4] or r[3]))):
            end = max(r[3], r[4] if r[4] is not None else r[3])
            if run is None or r[3] > run[3] + 10:
                run = [*key, r[3], end, r[5], 1]
                want.append(run)
            else:
                run[3], run[5] = max(run[3], end), run[5] + 1
                run[4] = r[5] if run[4] is None else run[4] if r[5] is None else max(run[4], r[5])
    got = X.merge_overlaps(detections(spark, rows), gap_ms=10, block_ms=block_ms)
    got = [(r.recording_id, r.label, r.absolute_time_ms, r.absolute_end_ms, r.confidence, r.merged) for r in got.collect()]
    assert sorted(got, key=str) == sorted(map(tuple, want), key=str)


def test_areas_and_sites(spark):
    one = spark.createDataFrame([("RUGR", "a")], "label_code string, location string")
    two = spark.createDataFrame([("XXXX",), ("WIPT",)], "label_code string")
    merged = X.merge_study_areas({"n": one, "s": two})
    assert sorted(tuple(r) for r in merged.select("study_area", "label_code").collect()) == [("n", "RUGR"), ("s", "WIPT")]
    assert X.merge_study_areas({"n": one, "s": two}, None).count() == 3
    sites = spark.createDataFrame([("a", 1.0)], "location string, latitude double")
    assert {r.label_code: r.latitude for r in X.attach_sites(merged, sites).collect()} == {"RUGR": 1.0, "WIPT": None}


def test_quality_and_run_time(spark):
    results = spark.createDataFrame([("r", "success"), ("r", "failure"), (None, "success")], "recording_id string, status string")
    heard = detections(spark, [("r", "c", "A", 0, 1, 0.4), ("r", "c", "A", 0, 1, None), ("q", "d", "A", 0, 1, 0.9)])
    got = {r.recording_id: tuple(r)[1:] for r in X.quality_counts(results, heard).collect()}
    assert got == {"r": (2, 1, 1, 1), None: (1, 0, 0, 0), "q": (0, 0, 1, 0)}
    events = spark.createDataFrame([("c", "SUCCESS", 2.0, 1), ("c", "failure", 9.0, 1), ("e", "start", None, None)],
                                   "chunk_id string, status string, runtime_s double, gpu_index long")
    ran = {r.chunk_id: (r.successes, r.runtime_s, r.detections, r.avg_confidence)
           for r in X.runtime_and_confidence(events, heard).collect()}
    assert ran == {"c": (1, 2.0, 1, pytest.approx(0.4)), "e": (0, None, 0, None)}


def test_changed_windows(spark):
    import hashlib

    good = hashlib.sha256(b"x").hexdigest()
    manifest = spark.createDataFrame([("r", "1", good), ("r", "2", "bad"), ("r", "3", None), ("r", "4", good), ("r", "5", None)],
                                     "recording_id string, chunk_id string, sha256 string")
    blobs = spark.createDataFrame([("r", "1", b"x"), ("r", "2", b"x"), ("r", "3", b"x"), ("r", "4", None)],
                                  "recording_id string, chunk_id string, content binary")
    got = {r.chunk_id: r.problem for r in X.changed_windows(manifest, blobs).collect()}
    assert got == {"2": "changed", "4": "missing", "5": "missing"}
