import hashlib
import io
import itertools
import math
import wave

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sonoledger.operators.audio import cut_windows, export_wav_files, manifest_from_blobs
from sonoledger.operators.probe import probe_attempts, probe_windows
from sonoledger.operators.windows import (
    detections_per_chunk,
    plan_windows,
    plan_windows_seconds,
    preview_windows,
    rows_per_recording,
)
from sonoledger.sources.manifests import read_manifest, write_manifest
from sonoledger.sources.recordings import discover_recordings, read_wav_headers

DDL = "recording_id string, audio_path string, sample_rate int, n_frames bigint, duration_s double"


def recordings(spark, *rows):
    return spark.createDataFrame(
        [(name, f"/a/{name}.wav", rate, n, n / rate if rate else 0.0) for name, rate, n in rows], DDL)


def wav_bytes(frames: bytes, rate=8000, channels=1, width=2) -> bytes:
    buf = io.BytesIO()
    with wave.open(buf, "wb") as out:
        out.setnchannels(channels)
        out.setsampwidth(width)
        out.setframerate(rate)
        out.writeframes(frames)
    return buf.getvalue()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 48), st.integers(0, 30_000), st.floats(0.01, 40), st.floats(0, 60))
def test_windows_cover_recording(spark, rate, frames, length, lap):
    got = plan_windows(recordings(spark, ("r", rate, frames)), length, lap).orderBy("start_frame").collect()
    size, over = max(int(length * rate), 1), max(int(lap * rate), 0)
    step = size if size <= over else size - over
    assert [r.start_frame for r in got] == list(range(0, frames, step))
    assert [r.end_frame for r in got] == [min(s + size, frames) for s in range(0, frames, step)]
    for r in got:
        assert r.start_ms == int(r.start_frame / rate * 1000)
        assert r.end_ms == int(r.end_frame / rate * 1000)
        assert r.chunk_id == f"r_chunk_{r.start_ms}_{r.end_ms}"
        assert r.overlap_ms == int(over / rate * 1000)


def test_one_long_recording_beside_short_ones(spark):
    """Windows of a recording far beyond one block, also redistributed."""

    recs = recordings(spark, ("long", 10, 100_001), ("short", 10, 25), ("none", 10, 0), ("odd", 0, 5))
    for spread in (None, 4):
        counts = {r.recording_id: r.manifest_rows for r in rows_per_recording(
            plan_windows(recs, 1.0, spread=spread)).collect()}
        assert counts == {"long": 10_001, "short": 3}


def test_bad_arguments(spark):
    recs = recordings(spark, ("r", 10, 10))
    with pytest.raises(ValueError):
        plan_windows(recs, 0)
    with pytest.raises(ValueError):
        plan_windows(recs, 1, -1)
    with pytest.raises(ValueError):
        plan_windows_seconds(recs, 0)


def by_addition(duration, length):
    """Starts are a running sum; each window ends where the next begins."""

    starts = list(itertools.takewhile(
        lambda s: s < duration, itertools.accumulate(itertools.repeat(length), initial=0.0)))
    return list(zip(starts, [*starts[1:], duration]))


@pytest.mark.parametrize("length", [0.1, 0.7, 7.3, 30.0, 0.25])
def test_seconds_follow_running_addition(spark, length):
    recs = recordings(spark, ("a", 10, 8), ("b", 10, 4321), ("c", 10, 7), ("d", 1000, 700), ("e", 10, 73))
    got = {}
    for r in plan_windows_seconds(recs, length).orderBy("recording_id", "start_s").collect():
        got.setdefault(r.recording_id, []).append((r.start_s, r.end_s))
        assert r.chunk_id == f"{r.recording_id}_{int(r.start_s * 1000)}_{int(r.end_s * 1000)}"
        assert (r.sha256, r.overlap_ms, r.source_path) == ("TODO_HASH", 0, f"/a/{r.recording_id}.wav")
    durations = {"a": 0.8, "b": 432.1, "c": 0.7, "d": 0.7, "e": 7.3}
    assert got == {k: by_addition(v, length) for k, v in durations.items()}


def test_folding_can_be_forced(spark):
    recs = recordings(spark, ("b", 10, 70_000))
    exact = plan_windows_seconds(recs, 30.0).orderBy("start_s").collect()
    assert exact == plan_windows_seconds(recs, 30.0, exact_fold=True).orderBy("start_s").collect()


def test_dry_run_and_preview(spark):
    recs = recordings(spark, ("r", 10, 700))
    rows = plan_windows_seconds(recs, 60.0, 2000, "/out", dry_run=True).orderBy("start_ms").collect()
    assert [(r.chunk_id, r.sha256, r.overlap_ms, r.source_path) for r in rows] == [
        ("r_chunk_0_60000", "DRY_RUN", 2000, "/out/r/r_chunk_0_60000.wav"),
        ("r_chunk_60000_70000", "DRY_RUN", 2000, "/out/r/r_chunk_60000_70000.wav")]
    ids = sorted(r.chunk_id for r in preview_windows(recs, 30.5).collect())
    assert ids == ["r_0_30", "r_30_61", "r_61_91"]


def test_manifest_round_trip(spark, tmp_path):
    windows = plan_windows(recordings(spark, ("r", 10, 700)), 60.0)
    path = write_manifest(windows, f"{tmp_path}/m", fmt="csv")
    rows = read_manifest(spark, path).orderBy("start_ms").collect()
    assert [(r.chunk_id, r.sha256, r.notes) for r in rows] == [
        ("r_chunk_0_60000", "TODO_HASH", None), ("r_chunk_60000_70000", "TODO_HASH", None)]


def test_detections_per_chunk(spark):
    names = spark.createDataFrame([("a_detected",), ("a_detected",), ("b_detected_detected",)], "detection string")
    assert {tuple(r) for r in detections_per_chunk(names).collect()} == {("a", 2), ("b", 1)}


def test_headers_and_cutting(spark, tmp_path):
    audio = tmp_path / "audio" / "site"
    audio.mkdir(parents=True)
    frames = bytes(i % 251 for i in range(16_000))
    (audio / "one.wav").write_bytes(wav_bytes(frames))
    (audio / "two.wav").write_bytes(wav_bytes(frames[:1200], rate=100, channels=3, width=1))
    (audio / "junk.wav").write_bytes(b"not audio at all")
    (audio / "note.txt").write_text("x")
    # An extra block before the format block must be stepped over.
    plain = wav_bytes(frames[:200])
    (audio / "list.wav").write_bytes(plain[:12] + b"LIST\x05\x00\x00\x00abcde\x00" + plain[12:])
    found = discover_recordings(spark, str(tmp_path))
    assert found.count() == 4
    facts = read_wav_headers(found)
    by_name = {r.recording_id: r for r in facts.collect()}
    assert (by_name["one"].n_frames, by_name["one"].duration_s, by_name["one"].error) == (8000, 1.0, None)
    assert (by_name["two"].channels, by_name["two"].n_frames, by_name["two"].duration_s) == (3, 400, 4.0)
    assert by_name["list"].n_frames == 100 and by_name["list"].data_offset == 44 + 14
    assert "RIFF" in by_name["junk"].error and by_name["junk"].n_frames is None

    windows = plan_windows(facts.filter("error is null"), 0.25, chunks_dir=f"{tmp_path}/chunks")
    blobs = cut_windows(windows, 3)
    one = blobs.filter("recording_id = 'one'").orderBy("start_ms").collect()
    assert [(r.start_ms, r.end_ms) for r in one] == [(0, 250), (250, 500), (500, 750), (750, 1000)]
    for i, r in enumerate(one):
        want = wav_bytes(frames[i * 4000:(i + 1) * 4000])
        assert bytes(r.content) == want and r.sha256 == hashlib.sha256(want).hexdigest()
    assert manifest_from_blobs(blobs).count() == blobs.count()
    paths = export_wav_files(blobs).collect()
    with wave.open(next(p.source_path for p in paths if "one_chunk_250" in p.source_path)) as fh:
        assert fh.getnframes() == 2000


def test_cutting_reports_missing_files(spark):
    recs = recordings(spark, ("gone", 10, 40)).selectExpr(
        "*", "44L AS data_offset", "1 AS channels", "1 AS sample_width_bytes")
    rows = cut_windows(plan_windows(recs, 2.0)).collect()
    assert len(rows) == 2 and all(r.content is None and "FileNotFound" in r.error for r in rows)


def check_search(attempts, best, longest, limit, mb_per_s, initial, tol):
    """Every attempt follows from what the ones before it showed."""

    for n, now in enumerate(attempts):
        before = attempts[:n]
        good = [a.duration_s for a in before if a.fits]
        bad = [a.duration_s for a in before if not a.fits]
        if not before:
            expected = min(initial, longest)
        elif not good and bad[-1] > tol:
            expected = max(tol, bad[-1] / 2)
        else:
            expected = (max(good, default=tol) + min(bad, default=longest)) / 2
        assert now.duration_s == expected and now.attempt == n + 1
        assert now.fits == (now.estimated_vram_mb <= limit)
        assert math.isclose(now.estimated_vram_mb, mb_per_s * now.duration_s, rel_tol=1e-12)
    good = [a.duration_s for a in attempts if a.fits]
    bad = [a.duration_s for a in attempts if not a.fits]
    assert best == round(max(good, default=tol), 2)
    # The search is over: something fits up to the tolerance, or nothing at all does.
    assert min(bad, default=longest) - max(good, default=tol) <= tol
    assert good or min(bad) <= tol


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(0.5, 9000), st.integers(1, 96_000)), min_size=20, max_size=20),
       st.floats(1, 100), st.floats(0.5, 20), st.one_of(st.none(), st.floats(1, 4000)))
def test_probe_search(spark, recs, initial, tol, top):
    df = spark.createDataFrame(
        [(f"r{i}", "/p", d, rate, i % 4) for i, (d, rate) in enumerate(recs)],
        "recording_id string, audio_path string, duration_s double, sample_rate int, gpu_index int"
    ).selectExpr("*", "2 AS channels", "2 AS sample_width_bytes")
    devices = spark.createDataFrame([(1, "B", 900.0), (0, "A", 300.0), (2, "C", 0.5)],
                                    "gpu_index bigint, gpu_name string, memory_total_mb double")
    limits = {0: 240.0, 1: 720.0, 2: 1.0, 3: 240.0}
    probes = probe_windows(df, devices, initial, top, tol)
    got = {r.recording_id: r for r in probes.collect()}
    for i, (d, rate) in enumerate(recs):
        row, longest = got[f"r{i}"], max(tol, d if top is None else min(top, d))
        mb_per_s = rate * 4 * 4 * 1.35 / 2**20
        check_search(row.attempts, row.max_duration_s, longest, limits[i % 4], mb_per_s, initial, tol)
    assert probe_attempts(probes).filter("attempt = 1").count() == len(recs)


def test_probe_without_devices(spark):
    df = spark.createDataFrame([("r", "/p", 420.0, 32000, 1, 2), ("z", "/q", 0.0, 32000, 1, 2)],
                               "recording_id string, audio_path string, duration_s double, sample_rate int,"
                               " channels int, sample_width_bytes int")
    row = probe_windows(df).collect()
    assert len(row) == 1 and row[0].memory_limit_mb == 4096.0 and "no GPUs" in row[0].notes
    with pytest.raises(ValueError):
        probe_windows(df, initial_s=0)
    assert math.isclose(row[0].bound_s, 420.0)
