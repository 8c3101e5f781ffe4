import json

import pytest

from sonoledger.plans.chunk_plan import build_chunk_plan, list_manifests, runnable_plans
from sonoledger.plans.infer_plan import (
    build_infer_plan,
    incomplete_plans,
    output_locations,
    require_complete,
)
from sonoledger.plans.resume import orphan_counts, pending_jobs, resume_entries, unmatched_entries
from sonoledger.sources.manifests import read_plan_manifests
from sonoledger.sources.status import append_status, latest_status, read_status
from sonoledger.sources.tables import write_plan

STATUS = "recording_id string, updated_at string, status string"


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def test_resume(spark):
    jobs = frame(spark, "recording_id string, chunk_id string",
                 ("rec1", "chunk_a"), ("rec1", "chunk_b"), ("rec2", "chunk_a"), ("rec2", "chunk_c"))
    results = frame(spark, "recording_id string, chunk_id string, status string",
                    ("rec1", "chunk_a", "success"), (None, "chunk_c", "success"), ("rec1", "chunk_b", "failure"),
                    ("rec9", "gone", "success"), (None, "gone2", "success"))
    entries = resume_entries(results)
    assert {tuple(r) for r in pending_jobs(jobs, entries).select("recording_id", "chunk_id").collect()} == {
        ("rec1", "chunk_b"), ("rec2", "chunk_a")}
    assert tuple(orphan_counts(jobs, entries).first()) == (4, 2, 2)
    assert {tuple(r) for r in unmatched_entries(jobs, entries).collect()} == {("rec9", "gone"), (None, "gone2")}


def test_no_entries_keep_all_jobs(spark):
    jobs = frame(spark, "recording_id string, chunk_id string", ("r", "a"), ("r", "a"))
    none = frame(spark, "recording_id string, chunk_id string")
    assert pending_jobs(jobs, none).count() == 2


def plan(spark, status=(), have=("rec1",), **options):
    recs = frame(spark, "recording_id string, audio_path string",
                 ("rec1", "/d/audio/rec1.wav"), ("rec2", "/d/audio/b/rec2.wav"), ("rec3", "/d/audio/a/rec3.wav"))
    manifests = frame(spark, "recording_id string", *[(h,) for h in have])
    return build_chunk_plan(recs, manifests, frame(spark, STATUS, *status), "/d", **options)


def ids(df):
    return sorted(r.recording_id for r in df.collect())


def test_chunk_plan(spark):
    assert ids(plan(spark)) == ["rec2", "rec3"]
    row = plan(spark, chunk_duration=30).filter("recording_id = 'rec2'").first()
    assert (row.manifest_path, row.chunk_output_dir, row.chunk_duration) == (
        "/d/manifests/rec2.csv", "/d/artifacts/chunks/rec2", 30.0)
    assert ids(plan(spark, include_existing=True)) == ["rec1", "rec2", "rec3"]
    # The newest state decides, not any earlier one.
    again = [("rec1", "2", "failed"), ("rec1", "1", "completed")]
    assert ids(plan(spark, again)) == ["rec1", "rec2", "rec3"]
    assert ids(plan(spark, [("rec1", "1", "failed"), ("rec1", "2", "completed")])) == ["rec2", "rec3"]
    assert [r.recording_id for r in plan(spark, limit=1).collect()] == ["rec3"]
    done = [("rec1", "2", "completed"), ("rec2", "1", "completed")]
    full = plan(spark, done, include_existing=True)
    assert ids(runnable_plans(full)) == ["rec2", "rec3"]
    assert ids(runnable_plans(full, include_existing=True)) == ["rec1", "rec2", "rec3"]


def test_infer_plan(spark):
    manifests = frame(spark, "recording_id string, manifest_path string",
                      ("rec1", "/m/rec1.csv"), ("rec2", "/m/rec2.csv"), ("rec3", "/m/rec3.csv"))
    outputs = frame(spark, "recording_id string", ("rec1",))
    status = frame(spark, STATUS, ("rec2", "1", "completed"))
    got = build_infer_plan(manifests, outputs, status, output_dir="/o/", detector_args=["--x"])
    assert ids(got) == ["rec2", "rec3"]
    row = got.filter("recording_id = 'rec2'").first()
    assert (row.chunk_status, row.recording_output_dir, row.detector_args) == ("completed", "/o/rec2", ["--x"])
    assert [tuple(r) for r in incomplete_plans(got).collect()] == [("rec3", "missing")]
    with pytest.raises(RuntimeError):
        require_complete(got)
    assert require_complete(got, allow_partial=True) == 1
    saved = frame(spark, "manifest_path string, plan_order int", ("/m/rec3.csv", 1), ("/m/rec1.csv", 2), ("/m/no.csv", 0))
    both = build_infer_plan(manifests, outputs, status, saved, include_existing=True)
    assert ids(both) == ["rec1", "rec3"]
    assert ids(build_infer_plan(manifests, outputs, status, saved, include_existing=True, limit=1)) == ["rec3"]
    assert [r.output_dir for r in output_locations(got).collect()] == ["/o"]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_plans_are_saved_and_read_back(spark, tmp_path, fmt):
    cut = write_plan(plan(spark), f"{tmp_path}/cut.{fmt}", fmt)
    saved = read_plan_manifests(spark, cut, lines=True)
    assert sorted(r.manifest_path for r in saved.collect()) == ["/d/manifests/rec2.csv", "/d/manifests/rec3.csv"]
    assert ids(saved) == ["rec2", "rec3"]
    manifests = frame(spark, "recording_id string, manifest_path string", ("rec1", "/m/rec1.csv"))
    infer = build_infer_plan(manifests, frame(spark, "recording_id string"), frame(spark, STATUS),
                             detector_args=["--a", "1"])
    path = write_plan(infer, f"{tmp_path}/infer.{fmt}", fmt)
    assert [r.manifest_path for r in read_plan_manifests(spark, path, lines=True).collect()] == ["/m/rec1.csv"]
    if fmt == "csv":
        assert spark.read.csv(path, header=True, escape='"').first().detector_args == '["--a","1"]'


def test_saved_plans(spark, tmp_path):
    (tmp_path / "p.csv").write_text("recording_id,manifest_path\nx,foo.csv\ny,\n")
    (tmp_path / "p.json").write_text(json.dumps([{"manifest": "bar.csv"}, {"manifest": None}], indent=1))
    assert [r.manifest_path for r in read_plan_manifests(spark, f"{tmp_path}/p.csv").collect()] == ["foo.csv"]
    assert [r.manifest_path for r in read_plan_manifests(spark, f"{tmp_path}/p.json").collect()] == ["bar.csv"]


def test_status_table(spark, tmp_path):
    path = f"{tmp_path}/status"
    assert read_status(spark, path).count() == 0
    append_status(frame(spark, STATUS, ("r", "2025-01-01", "in_progress")), path)
    append_status(frame(spark, STATUS, ("r", "2025-01-01", "failed"), ("q", "2025", "completed")), path)
    assert {(r.recording_id, r.status) for r in latest_status(read_status(spark, path)).collect()} == {
        ("r", "failed"), ("q", "completed")}


def test_hot_recording_in_status_and_resume(spark):
    """A third of all rows under one key, against brute force."""

    rows = [("hot" if i % 3 == 0 else f"r{i % 50}", f"{i:05d}", ["failed", "completed", "in_progress"][i % 7 % 3])
            for i in range(3000)]
    want = {}
    for rec, at, state in rows:
        want[rec] = max(want.get(rec, ("", "")), (at, state))
    got = {r.recording_id: (r.updated_at, r.status) for r in latest_status(frame(spark, STATUS, *rows)).collect()}
    assert got == want
    jobs = [("hot" if i % 3 == 0 else f"r{i % 50}", f"c{i % 900}") for i in range(3000)]
    entries = {(None if i % 5 == 0 else "hot", f"c{i}") for i in range(0, 900, 2)}
    left = sorted(j for j in jobs if j not in entries and (None, j[1]) not in entries)
    ddl = "recording_id string, chunk_id string"
    pending = pending_jobs(frame(spark, ddl, *jobs), frame(spark, ddl, *entries))
    assert sorted(tuple(r) for r in pending.select("recording_id", "chunk_id").collect()) == left


def test_list_manifests(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "rec7.csv").write_text("x")
    (tmp_path / "rec8.txt").write_text("x")
    rows = list_manifests(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("rec7", f"{tmp_path}/sub/rec7.csv")]
