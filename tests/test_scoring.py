import json
import stat
import sys
import wave
from dataclasses import replace

import pytest
from pyarrow import fs
from pyspark import cloudpickle

from sonoledger.operators import score as S
from sonoledger.operators.ingest import enrich_payloads, explode_detections
from sonoledger.operators.telemetry import worker_totals
from sonoledger.plans.dataset_run import Layout, cut_dataset, dataset_manifest, run_dataset, score_dataset
from sonoledger.schemas import MANIFEST
from sonoledger.sources import _files
from sonoledger.sources.runs import read_job_results
from sonoledger.sources.status import latest_status, read_status
from sonoledger.sources.telemetry import read_telemetry

# Detectors defined here run in workers that cannot import the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def manifest(spark, n=6):
    return spark.createDataFrame(
        [("hot" if i % 3 else f"r{i}", f"c{i}", f"/a/c{i}.wav", i * 1000, i * 1000 + 1000, 0, None, None)
         for i in range(n)], MANIFEST)


def detect(job):
    if job["chunk_id"] == "c4":
        raise RuntimeError("no signal")
    return [{"label": "L", "timestamp_ms": 10, "end_ms": 20, "confidence": 0.5}] if job["chunk_id"] == "c1" else []


def test_scoring_outcomes(spark, tmp_path):
    options = S.ScoreOptions(detector=detect, max_retries=0, partitions=3, model_version="m1")
    S.score_windows(manifest(spark), options).write.parquet(f"{tmp_path}/s")
    scored = spark.read.parquet(f"{tmp_path}/s")
    results = {r.chunk_id: r for r in S.result_rows(scored).collect()}
    assert len(results) == 6
    assert (results["c4"].status, results["c4"].last_error, results["c4"].attempts) == ("failure", "no signal", 1)
    assert results["c4"].error == "failed after 1 attempt(s)" and results["c1"].retries == 0
    found = explode_detections(enrich_payloads(S.payload_rows(scored)))
    rows = {r.chunk_id: r for r in found.collect()}
    assert set(rows) == {"c0", "c1", "c2", "c3", "c5"}
    assert (rows["c1"].absolute_time_ms, rows["c1"].runner, rows["c1"].model_version) == (1010, "custom", "m1")
    assert (rows["c2"].label, rows["c2"].status) == ("none", "ok")
    events = S.event_rows(scored)
    assert {(r.status, r["count"]) for r in events.groupBy("status").count().collect()} == {
        ("start", 6), ("success", 5), ("failure", 1)}
    path = S.write_payload_json(scored, f"{tmp_path}/json")
    again = explode_detections(enrich_payloads(S.read_payload_lines(spark, path)))
    assert again.count() == 5 and again.filter("label = 'L'").first().recording_id == "hot"


def test_payload_files_follow_rows_not_recordings(spark, tmp_path):
    many = spark.range(3000).selectExpr(
        "concat('r', id) AS recording_id", "concat('c', id) AS chunk_id", "'/a.wav' AS source_path", "id AS start_ms",
        "id + 1 AS end_ms", "0L AS overlap_ms", "cast(NULL AS string) AS sha256", "cast(NULL AS string) AS notes")
    path = S.write_payload_json(S.score_windows(many, S.ScoreOptions(partitions=2)), f"{tmp_path}/json", per_file=1000)
    files = [f for f in (tmp_path / "json").rglob("*.json")]
    assert 3 <= len(files) <= 20 and all(len(f.read_text().splitlines()) <= 1000 for f in files)
    rows = explode_detections(enrich_payloads(S.read_payload_lines(spark, path)))
    assert rows.filter("substr(recording_id, 2) = substr(chunk_id, 2)").count() == 3000


def test_retries_then_success(spark, tmp_path, monkeypatch):
    marks = str(tmp_path)

    def flaky(job):
        import os

        tries = len([f for f in os.listdir(marks) if f.startswith(job["chunk_id"])])
        open(f"{marks}/{job['chunk_id']}_{tries}", "w").close()
        if tries < 1:
            raise ValueError("first try")
        return []

    scored = S.score_windows(manifest(spark, 1), S.ScoreOptions(detector=flaky, partitions=1)).collect()[0]
    assert (scored.status, scored.attempts, scored.retries, scored.last_backoff_s) == ("success", 2, 1, 2.0)
    assert [e.status for e in scored.events] == ["start", "failure", "start", "success"]
    assert scored.worker.startswith("cpu-")


def test_fail_fast(spark):
    with pytest.raises(Exception, match="no signal"):
        S.score_windows(manifest(spark), S.ScoreOptions(detector=detect, max_retries=0, fail_fast=True)).collect()


def test_stub_and_options(spark):
    rows = S.payload_rows(S.score_windows(manifest(spark, 2)))
    assert {(r.status, r.runner) for r in rows.collect()} == {("stub", "stub")}
    with pytest.raises(ValueError):
        S.ScoreOptions(detector=detect, command="x", output_dir="/o")
    with pytest.raises(ValueError):
        S.ScoreOptions(command="x")
    path, options = S.ScoreOptions.from_mapping(
        {"runner": {"manifest": "m.csv", "max_retries": 1}, "hawkears": {"extra_args": ["--a", "1"]},
         "other": {"extra_args": ["no"]}, "paths": {}})
    assert (path, options.max_retries, options.extra_args) == ("m.csv", 1, ("--a", "1"))
    for bad in ({}, {"runner": {}}, {"runner": {"manifest": "m"}, "hawkears": {"extra_args": [1]}}):
        with pytest.raises(ValueError):
            S.ScoreOptions.from_mapping(bad)


def test_command_detector(spark, tmp_path):
    tool = tmp_path / "tool.sh"
    tool.write_text('#!/bin/sh\n[ "$2" = /a/c1.wav ] && { echo broken >&2; exit 3; }\n'
                    'echo \'{"detections": [{"label": "Z"}]}\' > "$4"\n')
    tool.chmod(tool.stat().st_mode | stat.S_IXUSR)
    options = S.ScoreOptions(command=str(tool), output_dir=f"{tmp_path}/out", max_retries=0, partitions=2)
    rows = {r.chunk_id: r for r in S.score_windows(manifest(spark, 3), options).collect()}
    assert rows["c0"].detections[0].label == "Z" and rows["c1"].last_error.strip() == "broken"


def test_batch_detector(spark):
    def many(jobs):
        if any(j["chunk_id"] == "c5" for j in jobs):
            raise RuntimeError("long " * 300 + "end")
        return [S.Found([{"label": j["chunk_id"]}], "kept") for j in jobs]

    options = S.ScoreOptions(batch_detector=many, batch_size=4, max_retries=0, partitions=1)
    rows = {r.chunk_id: r for r in S.score_windows(manifest(spark, 12).coalesce(1), options).collect()}
    failed = [c for c, r in rows.items() if r.status == "failure"]
    assert failed == ["c5"] and rows["c5"].last_error.endswith("end")
    assert len(rows["c5"].last_error) > 1000
    good = next(r for r in rows.values() if r.status == "success")
    assert good.detections[0].label == good.chunk_id and good.payload_status == "kept"
    with pytest.raises(ValueError):
        S.ScoreOptions(detector=detect, batch_detector=many)


def test_one_bad_window_of_a_batch(spark):
    """The bad one is tried again alone; the others succeed at once, in few calls."""

    calls = spark.sparkContext.accumulator(0)

    def many(jobs):
        calls.add(1)
        if any(j["chunk_id"] == "c37" for j in jobs):
            raise RuntimeError("poison")
        return [[] for _ in jobs]

    options = S.ScoreOptions(batch_detector=many, batch_size=64, max_retries=2, backoff_limit_s=0, partitions=1)
    rows = {r.chunk_id: r for r in S.score_windows(manifest(spark, 64), options).collect()}
    assert len(rows) == 64 and sum(r.status == "success" for r in rows.values()) == 63
    assert (rows["c37"].status, rows["c37"].attempts, rows["c37"].last_error) == ("failure", 3, "poison")
    assert [e.status for e in rows["c37"].events] == ["start", "failure"] * 3
    assert all((r.attempts, r.last_error, [e.status for e in r.events]) == (1, None, ["start", "success"])
               for c, r in rows.items() if c != "c37")
    assert calls.value == 13 + 2  # the whole, two halves at each of six sizes, two more tries
    with pytest.raises(Exception, match="poison"):
        S.score_windows(manifest(spark, 64), replace(options, fail_fast=True)).collect()


def test_wrong_number_of_results(spark):
    options = S.ScoreOptions(batch_detector=lambda jobs: [[]] * (len(jobs) - 1), max_retries=0, partitions=1)
    assert {r.last_error for r in S.score_windows(manifest(spark, 4), options).collect()} == {"0 results for 1 windows"}


def test_devices_are_measured_around_attempts(spark, tmp_path):
    from sonoledger.operators.telemetry import device_summary
    from sonoledger.sources.telemetry import append_telemetry

    def sampler(gpu):
        return {"index": 3, "name": "Unit X", "utilization": 41, "memory_used_mb": 100.5, "memory_total_mb": 800}

    options = S.ScoreOptions(detector=detect, sampler=sampler, max_retries=1, backoff_limit_s=0, partitions=1)
    S.score_windows(manifest(spark), options).write.parquet(f"{tmp_path}/s")
    append_telemetry(S.event_rows(spark.read.schema(S.SCORED).parquet(f"{tmp_path}/s")), f"{tmp_path}/log")
    rows = {r.device: r for r in device_summary(read_telemetry(spark, f"{tmp_path}/log")).collect()}
    one = rows["GPU 3"]
    assert (one.name, one.success, one.failures, one.util_avg, one.max_memory, one.memory_total) == ("Unit X", 5, 2, 41.0, 100.5, 800)
    assert one.util_history == [41.0] * 7

    def broken(gpu):
        raise OSError("no driver")

    rows = S.event_rows(S.score_windows(manifest(spark, 2), S.ScoreOptions(sampler=broken, partitions=1))).collect()
    assert {r.details.gpu_metrics for r in rows} == {None} and {r.gpu_name for r in rows} == {None}


def test_detector_that_leaves_a_label_file(spark, tmp_path):
    tool = tmp_path / "tool.sh"
    tool.write_text('#!/bin/sh\necho working\ncase "$2" in *c0.wav) exit 0;; *c3.wav) echo no >&2; exit 4;; esac\n'
                    'echo "filename,start_time,end_time,class_name,class_code,score" > "$4/HawkEars_labels.csv"\n'
                    'case "$2" in *c2.wav) exit 0;; esac\n'
                    'echo "c1.wav,0.5,1.5,Grouse,RUGR,0.87" >> "$4/HawkEars_labels.csv"\n'
                    'echo "other.wav,0,1,N,C,0.1" >> "$4/HawkEars_labels.csv"\n')
    tool.chmod(tool.stat().st_mode | stat.S_IXUSR)
    options = S.ScoreOptions(command=str(tool), label_files=True, output_dir=f"{tmp_path}/out", max_retries=0, partitions=2)
    scored = S.score_windows(manifest(spark, 4), options).collect()
    rows = {r.chunk_id: r for r in scored}
    assert {c: r.payload_status for c, r in rows.items()} == {"c0": "no_output", "c1": "ok", "c2": "no_detections", "c3": None}
    assert [tuple(d) for d in rows["c1"].detections] == [(500, 1500, "RUGR", "RUGR", "Grouse", 0.87)]
    events = {(r.chunk_id, r.status): r.details for r in S.event_rows(spark.createDataFrame(scored, S.SCORED)).collect()}
    assert events["c3", "failure"].returncode == 4 and events["c3", "failure"].stdout == "working\n"
    done = events["c1", "success"]
    assert done.runner == "hawkears" and done.output.endswith("c1_hawkears") and done.stdout == "working\n"


@pytest.fixture
def store(tmp_path, monkeypatch):
    """A filesystem that is reached by a URI scheme only."""

    (tmp_path / "store").mkdir()
    system = fs.SubTreeFileSystem(str(tmp_path / "store"), fs.LocalFileSystem())
    monkeypatch.setattr(_files, "filesystem_of", lambda path: (system, path.removeprefix("store://")))
    return tmp_path / "store"


def tool_of(tmp_path, text):
    tool = tmp_path / "tool.sh"
    tool.write_text("#!/bin/sh\n" + text)
    tool.chmod(tool.stat().st_mode | stat.S_IXUSR)
    return str(tool)


def test_command_output_on_another_filesystem(store, tmp_path):
    tool = tool_of(tmp_path, 'case "$2" in *bad*) echo half > "$4"; exit 2;; *none*) exit 0;; esac\n'
                             'echo \'{"detections": [{"label": "Z"}]}\' > "$4"\n')
    detect = S.command_detector(tool, "store://out/")
    job = {"recording_id": "r 1", "chunk_id": "c1", "source_path": "/a/c1.wav"}
    found = detect(job)
    assert found.output == "store://out/r 1/c1.json" and found.detections == [{"label": "Z"}]
    assert json.loads((store / "out/r 1/c1.json").read_text()) == {"detections": [{"label": "Z"}]}
    # A failed attempt leaves what was there; one without output takes the old file away.
    with pytest.raises(S.DetectorFailed):
        detect({**job, "source_path": "/a/bad.wav"})
    assert [f.name for f in store.rglob("*") if f.is_file()] == ["c1.json"] and "Z" in (store / "out/r 1/c1.json").read_text()
    assert detect({**job, "source_path": "/a/none.wav"}).detections == []
    assert not [f for f in store.rglob("*") if f.is_file()]


def test_label_files_on_another_filesystem(store, tmp_path):
    tool = tool_of(tmp_path, 'case "$2" in *none*) exit 0;; esac\nmkdir "$4/more"; echo x > "$4/more/log.txt"\n'
                             'printf "filename,class_code,score\\n,RUGR,0.5\\n" > "$4/HawkEars_labels.csv"\n')
    detect = S.label_file_detector(tool, "store://out")
    job = {"recording_id": "r1", "chunk_id": "c1", "source_path": "/a/c1.wav"}
    found = detect(job)
    assert (found.status, found.output, found.detections[0]["label"]) == ("ok", "store://out/r1/c1_hawkears", "RUGR")
    folder = store / "out/r1/c1_hawkears"
    assert sorted(f.name for f in folder.rglob("*") if f.is_file()) == ["HawkEars_labels.csv", "log.txt"]
    assert detect({**job, "source_path": "/a/none.wav"}).status == "no_output"
    assert not (folder / "HawkEars_labels.csv").exists()


def test_attempts_in_a_mounted_folder_leave_nothing_behind(tmp_path):
    tool = tool_of(tmp_path, 'echo "{}" > "$4"; [ "$2" != bad ]\n')
    detect = S.command_detector(tool, f"file://{tmp_path}/out")
    with pytest.raises(S.DetectorFailed):
        detect({"recording_id": "r1", "chunk_id": "c1", "source_path": "bad"})
    detect({"recording_id": "r1", "chunk_id": "c2", "source_path": "good"})
    assert [str(f.relative_to(tmp_path)) for f in (tmp_path / "out").rglob("*") if f.is_file()] == ["out/r1/c2.json"]
    assert [f.name for f in (tmp_path / "out").iterdir()] == ["r1"]


def put_wav(path, seconds, rate=100):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as out:
        out.setnchannels(1)
        out.setsampwidth(1)
        out.setframerate(rate)
        out.writeframes(bytes(int(seconds * rate)))


def test_dataset_from_audio_to_reports(spark, tmp_path):
    root = str(tmp_path / "set")
    put_wav(tmp_path / "set" / "audio" / "rec1.wav", 3.5)
    put_wav(tmp_path / "set" / "audio" / "x" / "rec2.wav", 1.0)
    (tmp_path / "set" / "audio" / "bad.wav").write_bytes(b"RIFFxxxx")
    at = Layout.below(root)
    status = {r.recording_id: r for r in cut_dataset(spark, root, 1.0, partitions=2).collect()}
    assert {k: (r.status, r.manifest_rows) for k, r in status.items()} == {
        "rec1": ("completed", 4), "rec2": ("completed", 1), "bad": ("failed", 0)}
    assert status["bad"].error
    cut = [r.source_path for r in dataset_manifest(spark, root).collect()]
    assert len(cut) == 5 and all(wave.open(p).getnframes() for p in cut)

    def noisy(job):
        if job["chunk_id"].endswith("_0_1000") and job["recording_id"] == "rec1":
            raise RuntimeError("later")
        return [{"label": "L", "confidence": 0.5, "timestamp_ms": 1}]

    with pytest.raises(RuntimeError):
        spark.createDataFrame([("rec1", "9", "failed")], "recording_id string, updated_at string, status string")
        from sonoledger.sources.status import append_status

        append_status(spark.createDataFrame([("rec2", "9999", "in_progress")],
                                            "recording_id string, updated_at string, status string"), at.status)
        score_dataset(spark, root, S.ScoreOptions(detector=noisy, max_retries=0))
    first = score_dataset(spark, root, S.ScoreOptions(detector=noisy, max_retries=0), allow_partial=True)
    assert {(r.status, r["count"]) for r in first.groupBy("status").count().collect()} == {
        ("success", 4), ("failure", 1)}
    # Only the failed window is left over; the second run finishes it.
    second = score_dataset(spark, root, S.ScoreOptions(), allow_partial=True)
    assert second.count() == 1 and second.first().status == "success"
    assert score_dataset(spark, root, S.ScoreOptions(), allow_partial=True) is None
    assert read_telemetry(spark, at.telemetry).count() == 12
    assert read_job_results(spark, at.results).count() == 6
    # Finished recordings are not cut again, the failed and the unfinished one are.
    todo = cut_dataset(spark, root, 1.0, partitions=2)
    assert {r.recording_id for r in todo.collect()} == {"bad", "rec2"}


def test_run_dataset(spark, tmp_path):
    root = str(tmp_path / "set")
    put_wav(tmp_path / "set" / "audio" / "rec1.wav", 2.0)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS e2e LOCATION '{tmp_path}/e2e'")
    out = run_dataset(spark, root, 1.0, run_name="e2e")
    labels = spark.read.csv(f"{out['rollup']}/label_summary.csv", header=True).collect()
    assert [(r.label, r.detections) for r in labels] == [("none", "2")]
    assert spark.table("e2e.recording_summary").first().detections == 2
    per = spark.read.parquet(f"{out['recordings']}/labels.parquet").first()
    assert (per.recording_id, per.label, per.detections, per["rank"]) == ("rec1", "none", 2, 1)
    states = latest_status(read_status(spark, Layout.below(root).status)).collect()
    assert [(r.recording_id, r.status) for r in states] == [("rec1", "completed")]


def test_a_further_run_adds_its_own_sums(spark, tmp_path):
    """The rollup of runs equals that of all detections; scores of earlier runs are not read again."""

    import shutil

    from sonoledger.operators import reports as R
    from sonoledger.plans import dataset_run as D

    root = str(tmp_path / "set")
    at = Layout.below(root)

    def shown(df):
        return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)

    def score(windows, confidence, bad=()):
        def judge(job):
            if job["chunk_id"] in bad:
                raise RuntimeError("no")
            return [{"label": label, "confidence": confidence} for label in ("A", "B", "A")]

        options = S.ScoreOptions(detector=judge, max_retries=1, backoff_limit_s=0, partitions=2)
        run = f"{len(D._finished_runs(at.scored)):03d}"
        S.score_windows(manifest(spark, windows), options).write.parquet(f"{at.scored}/run={run}")
        return f"run={run}"

    assert D.dataset_rollup(spark, root).collect() == []
    first = score(6, 0.5, bad=("c4",))
    assert D.add_up_runs(spark, root) == [first]
    assert shown(D.dataset_rollup(spark, root)) == shown(R.rollup(D.dataset_detections(spark, root)))
    second = score(3, 0.25)  # three windows scored anew
    kept = shown(R.rollup(D.dataset_detections(spark, root)))
    totals = shown(worker_totals(S.result_rows(D.dataset_scores(spark, root))))
    shutil.move(f"{at.scored}/{first}", f"{tmp_path}/away")
    assert D.add_up_runs(spark, root) == [second] and D.add_up_runs(spark, root) == []
    assert shown(D.dataset_rollup(spark, root)) == kept
    assert shown(D.dataset_worker_totals(spark, root)) == totals
    # A reduction that was cut short is done again.
    (tmp_path / "set" / "tables" / "rollup" / second / "_SUCCESS").unlink()
    assert D.add_up_runs(spark, root) == [second] and shown(D.dataset_rollup(spark, root)) == kept
