import pytest

from sonoledger.operators import reports as R
from sonoledger.operators.bundle import (
    BundleOptions,
    build_report_database,
    load_views,
    verify_report_database,
    write_bundle,
)
from sonoledger.schemas import DETECTIONS
from sonoledger.sources.detections import exclude_placeholders, read_detection_folder, write_detections


def make(spark, rows):
    """Rows of (recording, chunk, start, label, name, confidence)."""

    full = [
        (rec, chunk, start, None, None if label == "none" else 0, None, None, None, label, None, name,
         conf, "ok", "custom", None, None, "/s", None)
        for rec, chunk, start, label, name, conf in rows
    ]
    return spark.createDataFrame(full, DETECTIONS)


BASIC = [
    ("rec1", "chunk_a", 0, "WTSP", "White-throated", 0.9),
    ("rec1", "chunk_b", 60000, "BAWW", None, 0.7),
    ("rec1", "chunk_b", 60000, "WTSP", "White-throated", 0.5),
]


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_summarize(spark):
    df = make(spark, [("r", "c", 0, "grouse", None, 0.9), ("r", "c", 0, "grouse", None, 0.7)])
    label, n, mean = tuples(R.summarize(df))[0]
    assert (label, n, mean) == ("grouse", 2, pytest.approx(0.8))
    with pytest.raises(ValueError, match="unknown"):
        R.summarize(df, ["unknown"])


@pytest.mark.parametrize("rolled", [False, True])
def test_quicklook(spark, rolled):
    df = make(spark, BASIC)
    report = R.quicklook(R.rollup(df) if rolled else df)
    top = report.top_labels.first()
    assert (top.label, top.detections, top.avg_confidence) == ("WTSP", 2, pytest.approx(0.7))
    assert report.top_recordings.first().recording_id == "rec1"
    assert [r.chunk_id for r in report.chunk_timeline.collect()] == ["chunk_a", "chunk_b"]
    assert R.quicklook(df, 0).top_labels.count() == 1  # limits never go below one


@pytest.mark.parametrize("rolled", [False, True])
def test_mean_of_window_means(spark, rolled):
    df = make(spark, [
        ("r", "a", 0, "x", None, 1.0), ("r", "a", 0, "x", None, 0.0), ("r", "a", 0, "x", None, 0.2),
        ("r", "b", 60000, "x", None, 0.8), ("r", "n", None, "x", None, None), ("r", "n", 0, "x", None, 0.1),
    ])
    row = R.bucket_timeline(R.rollup(df) if rolled else df, 60).collect()
    assert len(row) == 1
    # Windows: a -> 0.4, b -> 0.8, n at 0 -> 0.1, n without a start -> no mean at all.
    assert (row[0].bucket_start_ms, row[0].detections) == (0, 6)
    assert row[0].avg_confidence == pytest.approx((0.4 + 0.8 + 0.1) / 3)


def test_null_and_blank_names_stay_two_groups(spark):
    df = make(spark, [("r", "c", 0, "x", None, 1.0), ("r", "c", 0, "x", "", 1.0), ("", "c", 0, "x", "", 1.0)])
    assert [(r.label, r.label_name, r.detections) for r in R.label_leaderboard(df).collect()] == [
        ("x", None, 2), ("x", None, 1)]
    assert [r.label_name for r in R.label_leaderboard(df, names="blank").collect()] == ["", ""]
    assert [r.label_name for r in R.label_leaderboard(df, names="raw").collect()] == ["", None]
    assert {r.recording_id for r in R.recording_leaderboard(df).collect()} == {"r", "unknown"}


def test_placeholders_count_unless_excluded(spark):
    df = make(spark, [("r", "c", 0, "none", None, None), ("r", "c", 0, "x", None, 1.0)])
    assert R.global_summary(df).first().detections == 2
    assert R.global_summary(exclude_placeholders(df)).first().detections == 1


@pytest.mark.parametrize("approximate", [False, True])
def test_summary(spark, approximate):
    df = make(spark, BASIC + [(None, "z", None, None, None, None)])
    row = R.global_summary(df, 0, approximate=approximate).first()
    assert tuple(row) == (4, 2, 1, 0, 60000, 1)
    empty = R.global_summary(make(spark, []), 5, approximate=approximate).first()
    assert tuple(empty) == (0, 0, 0, None, None, 5)


def test_chunk_timeline_nulls_first(spark):
    df = make(spark, [("r", "b", 5, "x", None, 1.0), ("r", "a", None, "x", None, 1.0)])
    assert [r.chunk_id for r in R.chunk_timeline(df).collect()] == ["a", "b"]


def test_named_buckets_and_sparkline(spark):
    df = make(spark, BASIC + [("r", "late", 7_200_000, "x", None, 0.1)])
    timeline = R.bucket_timeline(df, 60)
    assert [r.bucket for r in R.named_buckets(timeline).collect()] == ["bucket_0", "bucket_2"]
    assert R.timeline_sparkline(timeline).first().sparkline == "@ "


def test_report_database(spark, tmp_path):
    rows = [("recA", "chunk_a", 0, "WTSP", "W", 0.9), ("recA", "chunk_b", 60000, "WTSP", "W", 0.8),
            ("recB", "chunk_c", 0, "BAWW", None, 0.7)]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS rdb LOCATION '{tmp_path}/rdb'")
    with pytest.raises(RuntimeError, match="detections"):
        verify_report_database(spark, "rdb")
    with pytest.raises(FileNotFoundError):
        verify_report_database(spark, "nowhere")
    build_report_database(make(spark, rows), "rdb", 30)
    views = load_views(spark, "rdb", limit_labels=1)
    assert [tuple(r) for r in views.label_summary.select("label", "label_name", "detections").collect()] == [
        ("WTSP", "W", 2)]
    assert views.recording_summary.first().recording_id == "recA"
    assert [r.bucket_index for r in views.timeline_summary.collect()] == [0]
    assert views.timeline_summary.columns == ["bucket_index", "bucket_start_ms", "detections", "avg_confidence"]
    spark.sql("DROP VIEW rdb.timeline_summary")
    with pytest.raises(RuntimeError, match="timeline_summary"):
        verify_report_database(spark, "rdb")


def test_folder_rollup(spark, tmp_path):
    folder = tmp_path / "agg"
    folder.mkdir()
    assert read_detection_folder(spark, str(folder)) is None
    with pytest.raises(ValueError):
        read_detection_folder(spark, str(tmp_path / "missing"))
    write_detections(make(spark, BASIC), f"{folder}/plain.parquet")
    assert read_detection_folder(spark, str(folder)).count() == 3
    write_detections(make(spark, BASIC), f"{folder}/a_detections.parquet")
    write_detections(make(spark, BASIC[:1]), f"{folder}/b_detections.parquet")
    df = read_detection_folder(spark, str(folder))
    labels, recordings, totals = R.folder_rollup(df)
    assert tuple(totals.first()) == (4, 1)
    assert labels.columns == ["label_name", "label", "detections", "avg_confidence"]
    with pytest.raises(ValueError):
        R.folder_rollup(df, 0)


def test_bundle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bundle_db LOCATION '{tmp_path}/wh'")
    out = write_bundle(make(spark, BASIC), str(tmp_path), "run1", database="bundle_db")
    assert set(out) == {"quicklook", "table", "database", "database_exports"}
    for name in ("run1_quicklook/labels.csv", "run1_quicklook/chunks.csv", "run1_parquet_report/timeline.csv",
                 "run1_parquet_report/summary.json", "run1_database_exports/label_summary.csv"):
        assert (tmp_path / name / "_SUCCESS").exists()
    summary = spark.read.json(f"{tmp_path}/run1_parquet_report/summary.json").first()
    assert (summary.detections, summary.bucket_minutes) == (3, 60)
    none = write_bundle(make(spark, BASIC), str(tmp_path), "run2",
                        BundleOptions(quicklook=False, table=False, database=False))
    assert none == {}
